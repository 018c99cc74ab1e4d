"""Toxicity scores from the nearest labelled examples (operator 4).

Examples are a sample of the labelled texts, at most EXAMPLES of each label, chosen by a hash of their
id. Their words and word beginnings whose share differs between the labels (likelihood ratio) are
the terms, the TERMS strongest if there are more. Examples and texts are TF-IDF vectors over the terms; the exact cosine finds
the nearest NEIGHBOURS examples. The examples stand in an inverted index in blocks of similar ones
with, for each term and block, the largest weight: a text opens the blocks with the highest bounds, then those whose bound
reaches its last neighbour, so the neighbours are exact. Terms are frequent (a text has a hundred, an example holds a quarter of them), so the
postings of a block are a dense matrix, multiplied with all the texts of a batch that open it.

Each neighbour votes with its label, weighted by its cosine and by how much the sampling thinned out its
label. A text without terms gets the share of the label among such examples. Scores lie in 0 to 1.

A null or empty text has no terms and gets the score of one. Labels that are null or neither 0 nor 1 teach
nothing, nor do rows with a null id; a document labelled twice counts with the larger label. Without
examples every score is 0. Ties go to the earlier example in the index's order, which depends on the sample alone. Repeated
rows and further columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import arrays, table, trim, unused
from roadlake.session import materialize

EXAMPLES = 4000
TERMS = 4096
NEIGHBOURS = 15
BLOCK = 64
#: Blocks that are opened before a bound is compared with the k-th cosine, and texts that are worked on together.
EAGER, TOGETHER = 8, 256
#: Far more than the error of a cosine in single precision.
SLACK = 1e-4
#: Words whose terms a worker remembers.
REMEMBERED = 200_000
#: Least likelihood ratio of a term, and the least texts with it: chosen with BEGINNINGS by cross-validation (README).
RATIO, SUPPORT = 4.0, 4
#: Lengths of word beginnings; a word must be longer.
BEGINNINGS = (3, 5)
THRESHOLD = 0.3

WORDS = re.compile(r"\w+").findall


def terms_of(text: str | None, known=None) -> Counter:
    """Counts of the words and of their beginnings (marked with a bar); only ``known`` ones if given."""
    counts = Counter(WORDS((text or "").lower()))
    if known is None:
        out = Counter(counts)
        for word, n in counts.items():
            for size in BEGINNINGS:
                if len(word) > size:
                    out[word[:size] + "|"] += n
        return out
    whole, starts = known
    out = Counter()
    for word, n in counts.items():
        if word in whole:
            out[word] = n
        for size, some in starts.items():
            if len(word) > size and word[:size] in some:
                out[word[:size] + "|"] += n
    return out


@dataclass
class Model:
    """What the examples teach. ``index``: term -> (blocks, block maxima, examples, weights)."""

    idf: dict[str, float] = field(default_factory=dict)
    index: dict[str, tuple] = field(default_factory=dict)
    votes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    without: float = 0.0
    _blocks: tuple | None = None
    _words: dict[str, tuple] = field(default_factory=dict)

    def known(self) -> tuple[frozenset, dict[int, frozenset]]:
        starts = [t[:-1] for t in self.idf if t[-1] == "|"]
        return frozenset(t for t in self.idf if t[-1] != "|"), {k: frozenset(t for t in starts if len(t) == k) for k in BEGINNINGS}

    def blocks(self) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
        """The index by block: number of each term, its IDF, the weights of its examples (a row of terms each) and block maxima."""
        if self._blocks is None:
            numbers = {t: i for i, t in enumerate(sorted(self.idf))}
            weights = np.zeros((len(self.votes), len(numbers)), np.float32)
            maxima = np.zeros((-(-len(self.votes) // BLOCK), len(numbers)), np.float32)
            for term, (own, most, examples, values) in self.index.items():
                weights[examples, numbers[term]] = values
                maxima[own, numbers[term]] = most
            self._blocks = (numbers, np.array([self.idf[t] for t in numbers]), weights, maxima)
        return self._blocks

    def vector(self, counts: Counter) -> dict[str, float]:
        raw = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(counts.items()) if t in self.idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / norm for t, v in raw.items()} if norm else {}

    def profile(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of a text's terms; what a word counts for is looked up once while it is remembered."""
        numbers, idf, *_ = self.blocks()
        counts: dict[int, int] = {}
        if len(self._words) > REMEMBERED:
            self._words.clear()
        for word, n in Counter(WORDS((text or "").lower())).items():
            own = self._words.get(word)
            if own is None:
                names = [word, *(word[:size] + "|" for size in BEGINNINGS if len(word) > size)]
                own = self._words[word] = tuple(numbers[t] for t in names if t in numbers)
            for term in own:
                counts[term] = counts.get(term, 0) + n
        terms = np.array(sorted(counts), np.int64)
        weights = (1 + np.log(np.array([counts[t] for t in terms.tolist()], float))) * idf[terms]
        return terms, weights / np.sqrt((weights * weights).sum()) if len(terms) else weights

    def search(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """(examples, cosines) of the k nearest of each vector, by falling cosine, then by place; zero cosines do not count.

        A vector opens the EAGER blocks of the highest bounds, then those whose bound reaches its k-th cosine; a block is worked on for
        all vectors that open it. Single precision only chooses: SLACK is far above its error, and the chosen are computed again.
        """
        *_, weights, maxima = self.blocks()
        size = len(self.votes)
        query = np.zeros((len(vectors), weights.shape[1]), np.float32)
        for row, (terms, own) in enumerate(vectors):
            query[row, terms] = own
        bounds = query @ maxima.T
        cosines = np.zeros((len(vectors), size), np.float32)
        opened = np.zeros(bounds.shape, bool)
        np.put_along_axis(opened, np.argsort(-bounds, axis=1, kind="stable")[:, :EAGER], True, axis=1)
        opened &= bounds > 0
        done = np.zeros(bounds.shape, bool)
        limit = np.zeros((len(vectors), 1), np.float32)
        for _ in range(2):
            for block in np.flatnonzero(opened.any(0)).tolist():
                rows = np.flatnonzero(opened[:, block])
                part = slice(block * BLOCK, (block + 1) * BLOCK)
                cosines[rows, part] = query[rows] @ weights[part].T
            if size >= k:
                limit = np.partition(cosines, size - k, axis=1)[:, size - k, None]
            done |= opened
            opened = (bounds >= limit - SLACK) & (bounds > 0) & ~done
        out = []
        for (terms, own), row, least in zip(vectors, cosines, limit[:, 0].tolist()):
            near = np.flatnonzero((row > 0) & (row >= least - SLACK))
            exact = weights[near][:, terms].astype(float) @ own
            best = np.lexsort((near, -exact))[:k]
            out.append((near[best], exact[best]))
        return out

    def nearest(self, vector: dict[str, float], k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        numbers, *_ = self.blocks()
        terms = sorted(t for t in vector if t in numbers)
        return self.search([(np.array([numbers[t] for t in terms], np.int64), np.array([vector[t] for t in terms]))], k)[0]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        if not len(places):
            return self.without
        weights = self.weights[places] * np.maximum(cosines, 0) ** 2
        return float(min(1.0, max(0.0, (weights * self.votes[places]).sum() / weights.sum())))

    def score(self, counts: Counter) -> float:
        return self.vote(*self.nearest(self.vector(counts)))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Each different text is scored once."""
        found = dict.fromkeys(texts, self.without)
        different = list(found)
        for first in range(0, len(different), TOGETHER) if len(self.votes) else ():
            some = different[first : first + TOGETHER]
            for text, near in zip(some, self.search([self.profile(t) for t in some])):
                found[text] = self.vote(*near)
        return [found[t] for t in texts]


def halves(places: np.ndarray, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, terms: int) -> np.ndarray:
    """The places in an order in which similar examples share a block: cut in two along the direction of the largest spread, again and
    again. Their vectors are given by cells; a row is a number of ``places``."""
    n = len(places)
    if n <= BLOCK:
        return places
    mean = np.bincount(columns, values, terms) / n
    along = np.cos(np.arange(1, n + 1))  # any fixed beginning
    for _ in range(6):
        axis = np.bincount(columns, values * along[rows], terms) - along.sum() * mean
        along = np.bincount(rows, values * axis[columns], n) - mean @ axis
        along /= np.linalg.norm(along) + 1e-30
    order = np.argsort(along, kind="stable")
    middle = max(n // 2 // BLOCK, 1) * BLOCK
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    at = rank[rows]
    low, high = at < middle, at >= middle
    return np.concatenate([
        halves(places[order[:middle]], at[low], columns[low], values[low], terms),
        halves(places[order[middle:]], at[high] - middle, columns[high], values[high], terms),
    ])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """Learn from labelled documents. The sample is bounded by EXAMPLES, its vectors by TERMS."""
    spark = docs.sparkSession
    labelled = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(key).agg(F.max(label).cast("int").alias("_y"))
    )
    sizes = dict(labelled.groupBy("_y").count().collect())
    chosen = [
        labelled.filter(F.col("_y") == y).orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(EXAMPLES) for y in (0, 1)
    ]
    sample = chosen[0].unionByName(chosen[1]).withColumnRenamed(key, "_key")

    @F.arrow_udf("array<struct<term:string,n:int>>")
    def counted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int32())]))
        for batch in texts:
            yield pa.chunked_array(
                [pa.array([[{"term": t, "n": n} for t, n in terms_of(x).items()] for x in part.to_pylist()], kind) for part in arrays(batch)],
                kind,
            ).combine_chunks()

    # at most 2 * EXAMPLES ids go to all tasks
    rows = docs.join(F.broadcast(sample), docs[key] == F.col("_key")).select(
        "_key", "_y", counted(F.col(text)).alias("_terms")
    )
    rows = materialize(rows, "examples")
    totals = dict(rows.groupBy("_y").count().collect())
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 + n1:
        return Model()
    seen = rows.select("_y", F.explode("_terms.term").alias("term")).groupBy("term").agg(
        F.sum("_y").alias("a"), F.sum(1 - F.col("_y")).alias("b")
    )
    n, whole = F.col("a") + F.col("b"), n0 + n1

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    statistic = 2 * (
        part(F.col("a"), n * n1 / whole) + part(F.col("b"), n * n0 / whole)
        + part(n1 - F.col("a"), (whole - n) * n1 / whole) + part(n0 - F.col("b"), (whole - n) * n0 / whole)
    )
    kept = (
        seen.filter(n >= SUPPORT).withColumn("g", F.round(statistic, 6)).filter(F.col("g") >= RATIO)
        .orderBy(F.desc("g"), "term").limit(TERMS)
    )
    terms = {r.term: r.n for r in kept.select("term", n.alias("n")).collect()}
    known = spark.createDataFrame([(t,) for t in sorted(terms)], "term string") if terms else None
    numbers = {t: i for i, t in enumerate(sorted(terms))}
    keys: dict[tuple, int] = {}
    owners, columns, counts = [], [], []
    if terms:
        held = rows.select("_key", "_y", F.inline("_terms")).join(F.broadcast(known), "term")
        for batch in held.select("_key", "_y", "term", "n").toArrow().to_batches(max_chunksize=100_000):
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            owners.append(np.array([keys.setdefault(pair, len(keys)) for pair in pairs], np.int32))
            columns.append(np.array([numbers[t] for t in batch.column(2).to_pylist()], np.int32))
            counts.append(batch.column(3).to_numpy())
    parts = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in (owners, columns, counts)]
    return assemble(terms, list(keys), *parts, (n0, n1), sizes)


def build(terms: dict[str, int], vectors: dict, totals: tuple[int, int], sizes: dict[int, int]) -> Model:
    """``terms``: texts with each; ``vectors``: (key, label) -> counts of the examples that have any."""
    numbers = {t: i for i, t in enumerate(sorted(terms))}
    cells = [(i, numbers[t], n) for i, counts in enumerate(vectors.values()) for t, n in counts.items()]
    return assemble(terms, list(vectors), *np.array(cells, np.int64).reshape(-1, 3).T, totals, sizes)


def assemble(
    terms: dict[str, int], keys: list[tuple], owner: np.ndarray, column: np.ndarray, n: np.ndarray, totals: tuple[int, int], sizes: dict[int, int]
) -> Model:
    """The model from (example, term, count): ``keys`` names the examples (key, label), terms count in sorted order."""
    n0, n1 = totals
    model = Model({t: math.log((1 + n0 + n1) / (1 + n)) + 1 for t, n in terms.items()})
    # how many labelled texts an example stands for
    each = [sizes.get(0, 0) / max(n0, 1), sizes.get(1, 0) / max(n1, 1)]
    bare = [n0 - sum(y == 0 for _, y in keys), n1 - sum(y == 1 for _, y in keys)]
    mass = [bare[0] * each[0], bare[1] * each[1]]
    if sum(mass):
        model.without = mass[1] / sum(mass)
    else:
        model.without = n1 * each[1] / max(n0 * each[0] + n1 * each[1], 1e-300)
    names = sorted(terms)
    place = np.empty(len(keys), np.int64)  # examples in the order of their ids, whatever the order of the rows
    place[sorted(range(len(keys)), key=lambda i: (str(keys[i][0]), keys[i][1]))] = np.arange(len(keys))
    rows = place[owner]
    values = (1 + np.log(n.astype(float))) * np.array([model.idf[t] for t in names])[column]
    values = (values / np.sqrt(np.bincount(rows, values * values, len(keys)))[rows]).astype(np.float32)
    order = halves(np.arange(len(keys)), rows, column, values, len(names))
    labels = np.empty(len(keys), np.int64)
    labels[place] = [y for _, y in keys]
    model.votes = labels[order].astype(float)
    model.weights = np.array(each)[labels[order]]
    final = np.empty(len(keys), np.int32)
    final[order] = np.arange(len(keys))
    sorted_ = np.lexsort((final[rows], column))
    examples, values = final[rows][sorted_], values[sorted_]
    edges = np.searchsorted(column[sorted_], np.arange(len(names) + 1)).tolist()
    for term, low, high in zip(names, edges, edges[1:]):
        if low < high:
            own, first = np.unique(examples[low:high] // BLOCK, return_index=True)
            model.index[term] = (own, np.maximum.reduceat(values[low:high], first), examples[low:high], values[low:high])
    trim()
    return model


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with the score of every whole text. The model's size is bounded by EXAMPLES and TERMS."""
    shared = df.sparkSession.sparkContext.broadcast((model.idf, model.index, model.votes, model.weights, model.without))

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*shared.value)
        for batch in texts:
            yield pa.chunked_array([pa.array(model.scores(part.to_pylist()), pa.float64()) for part in arrays(batch)], pa.float64()).combine_chunks()

    return df.withColumn(into, scored(F.col(text)))


def evidence(model: Model, text: str, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
    """(cosine, label) of a text's neighbours: why it has its score."""
    places, cosines = model.nearest(model.vector(terms_of(text, model.known())), k)
    return list(zip(cosines.tolist(), model.votes[places].astype(int).tolist()))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "toxic")
    return fit(docs.select("doc_id", "text"), labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = score(docs, learned(spark, docs, sf_dir))
    return judged.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a score of THRESHOLD or more go."""
    into = unused(docs, "_toxicity")
    judged = score(docs, learned(spark, docs, sf_dir), into=into)
    return judged.filter(F.col(into) < THRESHOLD).select(docs.columns)
