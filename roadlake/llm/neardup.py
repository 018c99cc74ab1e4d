"""N-gram Jaccard join by MinHash LSH (operator 1).

Texts are sets of five-word shingles (words as they are, split at white space; a text with fewer words
is one shingle). Texts with equal sets form a class; only classes are compared. Each class has
TREES * DEPTH minimum hashes, DEPTH for each tree, and a label in each tree: its hashes in order, so that sorted labels
are a prefix trie and the classes under a node are those whose labels begin alike. The forest is searched from the longest
matches on. At each length of LEVELS, classes that share a node and differ in at most FAR hashes get a representative, which
takes over their labels; the others have their prefixes shortened to the next length. Adaptive is thus who is shortened: a class
that a long prefix has matched leaves the tries, one that none has matched goes down to the last length. That one is
set by the target recall: ``depth`` gives the longest prefix with which pairs at the threshold share a node in some tree often
enough. A label without company at that length can match at no other and is left out from the start.

Within a node of the last length, canopies of all hashes keep the pairs that can be similar: around each class in
turn, all classes within reach are linked, and only those close by are done with, so that by the triangle inequality every
similar pair, or its representatives, meets in some canopy. Connected canopies and represented classes form clusters; in
each cluster the exact Jaccard similarity of all pairs of classes decides.

Nodes and clusters of more than NODE_ROWS or CLUSTER_ROWS classes are split into chunks, and every pair
of chunks is a group of its own. Pairs are counted within the groups, never written.

A null text and one without words have no similar texts. Null ids are allowed; a class id is the least
id that is not null. Repeated rows are copies of each other. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import per_group, slices, table, unused
from roadlake.llm.components import components
from roadlake.llm.hashing import Powers, U, mix, runs_of, words
from roadlake.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
TREES, DEPTH = 16, 8
NODE_ROWS = 4096
CLUSTER_ROWS = 2048
#: Lengths of prefixes, longest first, at which classes get representatives before the last length.
LEVELS = (8, 6, 4)
#: Bytes of a hash in a label. Equal bytes of different hashes only make more candidates.
PLACE = 2
#: Hashes in which a class and its representative may differ, over all levels together.
FAR = 3
#: Share of equal hashes from which classes are linked, and from which a linked one is done with. Hashes of a pair at 0.8
#: agree on 0.62 of 128 places or less once in 10^6: 1 - LINKED >= (1 - 0.62) + (1 - DONE) + 2 * FAR / 128.
LINKED, DONE = 0.45, 0.88
#: Stands for a null id, which comes last.
LAST = (1 << 63) - 1


def depth(threshold: float, recall: float, trees: int = TREES, longest: int = DEPTH) -> int:
    """The longest prefix with which similar pairs meet in one of the trees often enough."""
    fits = (k for k in range(longest, 1, -1) if 1 - (1 - threshold**k) ** trees >= recall)
    return next(fits, 1)


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, id, hash, key, labels, signature) of the texts that have words, key: the set of shingles.

    A label is the number of its tree and PLACE bytes of each hash; the signature has one byte of every hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, random = Powers(), np.random.RandomState(11)
        count = TREES * DEPTH
        factors = random.randint(0, 1 << 63, count, dtype=np.uint64) * U(2) + U(1)
        shifts = random.randint(0, 1 << 64, count, dtype=np.uint64)
        for batch in batches:
            for first, end, data, offsets in slices(batch.column("text")):
                hashes, _, _, firsts = words(powers, data, offsets)
                shingles, owner = runs_of(powers, hashes, firsts, k)
                if not len(shingles):
                    continue
                has, at = np.unique(owner, return_index=True)
                least = np.stack([np.minimum.reduceat(shingles * a + b, at) for a, b in zip(factors, shifts)], 1)
                mixed = mix(least)
                labels = np.empty((len(has), TREES, 1 + PLACE * DEPTH), np.uint8)
                labels[:, :, 0] = np.arange(TREES)
                labels[:, :, 1:] = mixed.view(np.uint8).reshape(len(has), TREES, DEPTH, 8)[..., :PLACE].reshape(len(has), TREES, -1)
                signature = mixed.astype(np.uint8)
                keys = [
                    hashlib.blake2b(np.unique(part).tobytes(), digest_size=16).digest() for part in np.split(shingles, at[1:])
                ]
                own = pa.array(has + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(own) for c in ("doc_id", "id", "hash")), pa.array(keys, pa.binary()),
                        pa.array([[label.tobytes() for label in row] for row in labels], pa.list_(pa.binary())),
                        pa.array([row.tobytes() for row in signature], pa.binary()),
                    ],
                    ["doc_id", "id", "hash", "key", "labels", "signature"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, id long, hash long, key binary, labels array<binary>, signature binary")


def split(rows: DataFrame, sizes: DataFrame, group: str, most: int) -> DataFrame:
    """Rows with a ``side`` (0 or 1) and a ``part``; groups over ``most`` are cut into chunks, a part for each pair of them."""
    chunks = F.ceil(F.col("_n") / most).cast("long")
    own = F.pmod(F.xxhash64("key", F.lit(3)), F.col("_c"))
    joined = rows.join(sizes.withColumnRenamed("n", "_n"), group).withColumn("_c", chunks).withColumn("_own", own)
    # part low * c + high; a row of the diagonal part stands on side 0
    parts = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_c") - 1),
        lambda o: F.struct(
            (F.least(o, F.col("_own")) * F.col("_c") + F.greatest(o, F.col("_own"))).alias("part"),
            (F.col("_own") > o).cast("int").alias("side"),
        ),
    )
    return joined.select(*rows.columns, F.inline(parts)).drop("_n", "_c", "_own")


def canopies(signatures: np.ndarray) -> list[tuple[int, int]]:
    """Links (a, b) among rows: stars around one row after the other, as the module says. Links between rows that are
    connected already are left out, so there are fewer links than rows."""
    links, open_rows = [], np.arange(len(signatures))
    group = np.arange(len(signatures))
    while len(open_rows) > 1:
        pivot, rest = open_rows[0], open_rows[1:]
        same = (signatures[rest] == signatures[pivot]).mean(1)
        near = rest[same >= LINKED]
        others, first = np.unique(group[near], return_index=True)
        foreign = others != group[pivot]
        links += [(pivot, b) for b in near[first[foreign]].tolist()]
        if foreign.any():
            group[np.isin(group, others)] = group[pivot]
        open_rows = rest[same < DONE]
    return links


def represented(nodes: DataFrame) -> DataFrame:
    """(key, to, far): classes and others of their node that may stand for them; far bounds the hashes in which ``to``
    differs from the class and all it stands for. Nodes are worked on in parts; a part need not see the others."""

    def work(group: pa.Table) -> pa.Table | None:
        keys = np.array(group["key"].to_pylist(), object)
        order = np.argsort(keys)  # least first, so that two nodes don't turn the same pair round
        signatures = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(len(keys), -1)
        radius = group["radius"].to_numpy()
        found: list[tuple[bytes, bytes, int]] = []
        while len(order) > 1:
            pivot, order = order[0], order[1:]
            far = (signatures[order] != signatures[pivot]).sum(1) + radius[order]
            near = (far <= FAR) & (keys[order] != keys[pivot])
            found += [(keys[row], keys[pivot], int(f)) for row, f in zip(order[near], far[near])]
            order = order[~near]
        if not found:
            return None
        own, to, far = zip(*found)
        return pa.table({"key": pa.array(own, pa.binary()), "to": pa.array(to, pa.binary()), "far": pa.array(far, pa.int32())})

    return per_group(nodes.select("node", "part", "key", "signature", "radius"), ["node", "part"], work, "key binary, to binary, far int")


def node(level: int) -> Column:
    """The node of a label at a length."""
    return F.substring("label", 1, 1 + PLACE * level)


def company(tries: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(node, key) at a length, and (node, n) of the nodes that several classes share, which is stored."""
    named = tries.select(node(level).alias("node"), "key").distinct()
    sizes = named.groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return named, materialize(sizes, "sizes")


def forest(sketches: DataFrame, classes: DataFrame, last: int) -> tuple[DataFrame, DataFrame]:
    """(key, label) of the classes that remain at the last length, and (a, b) of classes with their representatives."""
    labels = sketches.select("key", F.explode("labels").alias("label")).distinct()
    shared = labels.groupBy(node(last).alias("node")).agg(F.count_distinct("key").alias("n")).filter(F.col("n") > 1)
    shared = materialize(shared.select("node"), "shared")
    tries = materialize(labels.withColumn("node", node(last)).join(shared, "node").select("key", "label"), "tries")
    moved = sketches.sparkSession.createDataFrame([], "key binary, to binary, far int")
    for level in [at for at in LEVELS if at > last]:
        named, sizes = company(tries, level)
        parts = F.ceil(F.col("n") / NODE_ROWS)
        met = named.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("key", F.lit(5)), parts)).drop("n")
        radii = moved.groupBy(F.col("to").alias("key")).agg(F.max("far").alias("radius"))
        members = met.join(classes.hint("merge"), "key").join(radii, "key", "left").fillna(0, ["radius"])
        found = materialize(represented(members), "represented")
        # a class that may be represented itself represents nobody at this length
        free = found.join(found.select(F.col("key").alias("to")).distinct(), "to", "left_anti")
        chosen = free.groupBy("key").agg(F.min(F.struct("far", "to")).alias("best"))
        moves = materialize(chosen.select("key", "best.to", "best.far"), "moves")
        short = tries.join(moves, "key", "left").select(F.coalesce("to", "key").alias("key"), node(level).alias("label"))
        tries = materialize(short.distinct(), "tries")
        moved = moved.unionByName(moves)
    return tries, moved.select(F.col("key").alias("a"), F.col("to").alias("b"))


def candidate_links(nodes: DataFrame) -> DataFrame:
    """(a, b) links within the parts of nodes. Parts that come as one only make further candidates."""

    def work(group: pa.Table) -> pa.Table | None:
        keys = group["key"].to_pylist()
        signatures = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(len(keys), -1)
        links = canopies(signatures)
        if not links:
            return None
        return pa.table({"a": pa.array([keys[a] for a, _ in links], pa.binary()), "b": pa.array([keys[b] for _, b in links], pa.binary())})

    return per_group(nodes.select("node", "part", "key", "signature"), ["node", "part"], work, "a binary, b binary")


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections."""
    m = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    found = np.diff(np.append(first, len(values)))
    out = np.zeros((m, m))
    # shingles of few texts: their pairs are counted one by one; of many: as a product of matrices
    for size in np.unique(found[(found > 1) & (found <= 16)]).tolist():
        own = owner[first[found == size][:, None] + np.arange(size)]
        low, high = np.triu_indices(size, 1)
        for i, j in zip(low.tolist(), high.tolist()):
            out += np.bincount(own[:, i] * m + own[:, j], minlength=m * m).reshape(m, m)
    out += out.T
    often = np.flatnonzero(found > 16)
    for start in range(0, len(often), 4096):
        chosen = often[start : start + 4096]
        dense = np.zeros((m, len(chosen)), np.float32)
        for column, shingle in enumerate(chosen.tolist()):
            dense[owner[first[shingle] : first[shingle] + found[shingle]], column] = 1
        out += dense @ dense.T
    return out


def verified(groups: DataFrame, threshold: float) -> DataFrame:
    """(key, links, to): by part of a cluster, how many documents are similar to the class, and a class it is connected with."""

    def work(group: pa.Table) -> pa.Table | None:
        keys, at = np.unique(np.array(group["key"].to_pylist(), object), return_index=True)
        if len(keys) < 2:
            return None
        group = group.take(pa.array(at))
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets], np.float64)
        copies, side = group["copies"].to_numpy(), group["side"].to_numpy()
        both = shared(sets)
        similar = both / (sizes[:, None] + sizes[None, :] - both) >= threshold
        np.fill_diagonal(similar, False)
        if side.any():  # two chunks: pairs within one are counted elsewhere
            similar &= side[:, None] != side[None, :]
        label, moved = np.arange(len(keys)), True
        while moved:
            lower = np.where(similar, label[None, :], len(keys)).min(1)
            new = np.minimum(label, lower)
            new = new[new]
            moved = bool((new != label).any())
            label = new
        links = (similar * copies[None, :]).sum(1).astype(np.int64)
        return pa.table({"key": pa.array(list(keys), pa.binary()), "links": links, "to": pa.array([keys[i] for i in label], pa.binary())})

    rows = groups.select("root", "part", "side", "key", "copies", "shingles")
    return per_group(rows, ["root", "part"], work, "key binary, links long, to binary")


def shingle_sets(rows: DataFrame, k: int) -> DataFrame:
    """(key, root, copies, shingles): the sorted distinct shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for first, end, data, offsets in slices(batch.column("text")):
                hashes, _, _, firsts = words(powers, data, offsets)
                shingles, owner = runs_of(powers, hashes, firsts, k)
                ends = np.searchsorted(owner, np.arange(end - first + 1))
                sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("root"), part.column("copies"), pa.array(sets, pa.binary())],
                    ["key", "root", "copies", "shingles"],
                )

    return rows.select("key", "root", "copies", "text").mapInArrow(run, "key binary, root binary, copies long, shingles binary")


def join(
    docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """(doc_id, class_id, n_links, hash, stays) for each row: the least id of its group of directly or indirectly similar
    texts, how many other rows are similar to it, the hash of its text, and whether the text stands for its group."""
    plain = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("hash"),
    )
    sketches = materialize(sketch(plain, k), "sketches")
    counts = materialize(
        sketches.groupBy("key").agg(F.count("*").alias("copies"), F.min(F.struct("id", "hash")).alias("example")), "classes"
    )
    classes = materialize(sketches.select("key", "signature").dropDuplicates(["key"]), "signatures")
    last = depth(threshold, recall)
    tries, standing = forest(sketches, classes, last)
    met = split(*company(tries, last), "node", NODE_ROWS)
    links = candidate_links(met.join(classes.hint("merge"), "key")).unionByName(standing)
    clusters = components(links).withColumnRenamed("node", "key")
    members = materialize(clusters.join(counts, "key"), "clusters")
    sizes = members.groupBy("root").agg(F.count("*").alias("n"))
    # always shuffled: which side is small depends on the corpus, and members grow with it
    texts = plain.select("id", "hash", "text").join(members.select("key", "root", "copies", "example.*").hint("merge"), ["id", "hash"])
    groups = split(shingle_sets(texts, k), sizes, "root", CLUSTER_ROWS)
    checked = materialize(verified(groups, threshold), "checked")
    linked = checked.groupBy("key").agg(F.sum("links").alias("links"))
    whole = components(checked.select(F.col("key").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "key")
    grouped = (
        counts.join(whole, "key", "left").join(linked, "key", "left")
        .withColumns({"root": F.coalesce("root", "key"), "links": F.coalesce("links", F.lit(0)) + F.col("copies") - 1})
    )
    heads = grouped.groupBy("root").agg(F.min("example").alias("head"))
    named = materialize(grouped.join(heads, "root").select("key", "head", "links"), "groups")
    found = sketches.select("doc_id", "id", "hash", "key").join(named, "key").select(
        "doc_id", F.when(F.col("head.id") < LAST, F.col("head.id")).alias("class_id"), F.col("links").alias("n_links"), "hash",
        (F.struct("id", "hash") == F.col("head")).alias("stays"),
    )
    bare = plain.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return found.unionByName(
        bare.select(
            "doc_id", F.col("doc_id").cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "hash", F.lit(True).alias("stays")
        )
    )


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of similar documents the one with the least id stays, and of its repeated rows one."""
    key, hashed, mark = (unused(docs, c) for c in ("_id", "_hash", "_own"))
    stay = join(docs.select("doc_id", "text")).filter("stays").select(F.col("doc_id").alias(key), F.col("hash").alias(hashed))
    own = docs.withColumn(mark, F.xxhash64("text"))
    kept = own.join(stay.distinct(), own["doc_id"].eqNullSafe(F.col(key)) & (own[mark] == F.col(hashed)), "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).select(docs.columns)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p : p + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS p FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE common / CAST(x.n + y.n - common AS DOUBLE) >= 0.8),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.node = l.a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links
FROM (SELECT doc_id, min(node) AS class_id FROM reach GROUP BY doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) USING (doc_id)"""
