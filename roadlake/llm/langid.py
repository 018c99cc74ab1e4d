"""Language identification with hyperdimensional profiles (operator 9).

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram vector binds
three of them: the product of the first one rotated by two places, the second rotated by one and the
third as it is. A text's vector bundles (adds) the vectors of all its trigrams; a language's prototype
bundles the texts labelled with it. A text gets the language whose prototype has the largest cosine;
ties go to the smaller name. Letters are lower-cased; everything else counts as one blank.

All sums are of whole numbers, so results do not depend on how the rows are dealt out.

A null text and one without letters get ``und`` and score 0, as does every text if nothing was
learned. Rows with a null text or language teach nothing. Repeated rows and further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import table, unused
from roadlake.session import materialize

DIM = 512
#: Prototypes are sent to all tasks; more languages than this are an error in the labels.
MAX_LANGUAGES = 4096
#: Characters that are worked on at once.
CHUNK = 1 << 17
#: Distinct trigrams, and counts of texts by trigrams, that are bundled at once.
BLOCK, CELLS = 1 << 13, 1 << 22
UNKNOWN = "und"


class Letters:
    """Code points to small numbers (0: no letter), and the vectors of the numbers."""

    def __init__(self, dim: int):
        self.dim = dim
        self.number = np.full(0x110000, -1, np.int32)
        self.number[32] = 0
        self.vectors = [self.draw(32)]

    def draw(self, point: int) -> np.ndarray:
        return np.random.RandomState(point).randint(0, 2, self.dim).astype(np.int8) * 2 - 1

    def numbers(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self.number[points]
        if len(out) and out.min() < 0:
            for point in np.unique(points[out < 0]).tolist():
                letter = chr(point).isalpha()
                self.number[point] = len(self.vectors) if letter else 0
                if letter:
                    self.vectors.append(self.draw(point))
            out = self.number[points]
        return out

    def trigrams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts: each trigram's text, its place among the distinct ones, and these as three numbers."""
        joined = self.numbers(" " + "  ".join(texts) + " ")
        lengths = np.array([len(t) + 2 for t in texts])
        owner = np.repeat(np.arange(len(texts)), lengths)
        keep = joined > 0
        keep[1:] |= joined[:-1] > 0  # one blank after each word
        keep[np.cumsum(lengths) - lengths] = True  # and one before each text
        letters, owner = joined[keep].astype(np.int64), owner[keep]
        size = len(self.vectors)
        code = (letters[:-2] * size + letters[1:-1]) * size + letters[2:]
        inside = (owner[:-2] == owner[2:]) & (letters[1:-1] + letters[2:] > 0)
        code, owner = code[inside], owner[:-2][inside]
        if size <= 128:
            seen = np.zeros(size**3, bool)
            seen[code] = True
            distinct = np.flatnonzero(seen)
            place = np.empty(size**3, np.int32)
            place[distinct] = np.arange(len(distinct), dtype=np.int32)
            index = place[code]
        else:
            distinct, index = np.unique(code, return_inverse=True)
        return owner, index, np.stack([distinct // size**2, distinct // size % size, distinct % size])

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """The vectors of the trigrams."""
        numbers, at = np.unique(grams, return_inverse=True)
        vectors, at = np.stack([self.vectors[n] for n in numbers.tolist()]), at.reshape(grams.shape)
        out = np.roll(vectors, 2, 1)[at[0]]
        out *= np.roll(vectors, 1, 1)[at[1]]
        out *= vectors[at[2]]
        return out

    def bundled(self, owner: np.ndarray, index: np.ndarray, grams: np.ndarray, rows: int) -> np.ndarray:
        """The sums of the trigram vectors of each of ``rows`` owners, in blocks of at most CELLS counts."""
        width = grams.shape[1]
        block = min(BLOCK, max(64, CELLS // max(rows, 1)))
        if width > block:
            order = np.argsort(index, kind="stable")
            owner, index = owner[order], index[order]
        most = np.bincount(owner, minlength=1).max()
        kind = np.float32 if most < 1 << 24 else np.float64  # exact sums of whole numbers
        out = np.zeros((rows, self.dim))
        for first in range(0, width, block):
            size = min(block, width - first)
            own = slice(*np.searchsorted(index, [first, first + size])) if width > block else slice(None)
            counts = np.bincount(owner[own] * size + index[own] - first, minlength=rows * size).reshape(rows, size)
            out += counts.astype(kind) @ self.bound(grams[:, first : first + size]).astype(kind)
        return out


def prepared(text: str | None) -> str:
    text = (text or "").lower()
    return text if any(c.isalpha() for c in text[:64]) or any(map(str.isalpha, text)) else ""


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded length. A longer text is a run of its own."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > CHUNK:
            yield first, texts[first:i]
            first, held = i, 0
        held += len(text)
    if texts:
        yield first, texts[first:]


def learn(df: DataFrame, text: str = "text", label: str = "lang", dim: int = DIM) -> DataFrame:
    """Prototypes: (lang, place, value), a row for each place of each language's vector."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(dim), {}
        for batch in batches:
            texts, langs = [prepared(t) for t in batch.column(0).to_pylist()], batch.column(1).to_pylist()
            for first, run in chunks(texts):
                owner, index, grams = letters.trigrams(run)
                names = langs[first : first + len(run)]
                known = sorted(set(names))
                of = np.array([known.index(n) for n in names])
                if not grams.shape[1]:
                    continue
                for name, row in zip(known, letters.bundled(of[owner], index, grams, len(known))):
                    sums[name] = sums.get(name, 0) + row.astype(np.int64)
        for name, row in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(row)], ["lang", "place", "value"]
            )

    rows = df.select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang")).na.drop()
    parts = rows.mapInArrow(bundle, "lang string, place int, value long")
    return materialize(parts.groupBy("lang", "place").agg(F.sum("value").alias("value")), "prototypes")


def predict(df: DataFrame, prototypes: DataFrame, text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the language of each text and its cosine, cut at 0."""
    learned: dict[str, dict[int, int]] = {}
    if prototypes.filter("place = 0").count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    for name, place, value in prototypes.collect():
        learned.setdefault(name, {})[place] = value
    names = sorted(n for n, v in learned.items() if any(v.values()))
    dim = len(learned[names[0]]) if names else DIM
    matrix = np.array([[learned[n][i] for i in range(dim)] for n in names], np.float64).reshape(len(names), dim)
    matrix = (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)).T

    @F.arrow_udf("struct<lang:string,score:double>")
    def best(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = Letters(dim)
        for column in columns:
            texts = [prepared(t) for t in column.to_pylist()]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first, run in chunks(texts if names else []):
                owner, index, grams = letters.trigrams(run)
                if not grams.shape[1]:
                    continue
                vectors = letters.bundled(owner, index, grams, len(run))
                norms = np.linalg.norm(vectors, axis=1)
                cosines = (vectors @ matrix) / np.maximum(norms, 1e-300)[:, None]
                for i in np.unique(owner).tolist():
                    winner = int(cosines[i].argmax())
                    langs[first + i], scores[first + i] = names[winner], min(1.0, max(0.0, cosines[i, winner]))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], ["lang", "score"])

    found = unused(df, "_best")
    judged = df.withColumn(found, best(F.col(text)))
    return judged.withColumns({into: F.col(f"{found}.lang"), score: F.col(f"{found}.score")}).drop(found)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    prototypes = learn(docs.filter(~held_out).select("text", "lang"))
    judged = predict(docs.select("doc_id", "text"), prototypes)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
