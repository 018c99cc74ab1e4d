"""Exact top-k inner products with a KD-tree per shard (operator 8).

Candidates are dealt to shards by a hash of their id and vector. A shard's tree splits at the
median of the widest component down to small leaves with tight bounding boxes. For a query, the
largest inner product that a box can hold bounds its leaf; leaves are visited best first until the
bound falls below the query's k-th score. Each query first visits one shard; the k-th score found
there goes along to all other shards, which return only what can still matter. A task reads the candidates of a
shard, makes their tree once and lets the shard's queries stream through it, batch by batch: candidates are shuffled
twice whatever the number of queries, and a task holds one tree. The work is a query set against all rows.

Vectors are whole numbers. Only vectors of equal length are compared. A vector that is null or holds
null or non-finite components takes no part, nor does one with a null id. The rows with a query's own
id are no candidates of it; a repeated query row is one query, repeated candidate rows count each.
Scores are exact below 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake.llm.common import table
from roadlake.session import materialize

K = 20
SHARD_ROWS = 8192
LEAF_ROWS = 128
RESULT = "query_id long, vec_id long, score long"


def whole(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null if any is missing or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class Tree:
    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.leaves: list[np.ndarray] = []
        self.split(np.arange(len(ids)))
        self.low = np.stack([rows[leaf].min(0) for leaf in self.leaves])
        self.high = np.stack([rows[leaf].max(0) for leaf in self.leaves])

    @cached_property
    def doubles(self) -> Tree:
        """The same tree over doubles, whose products are faster."""
        tree = copy(self)
        tree.rows, tree.low, tree.high = (a.astype(np.float64) for a in (self.rows, self.low, self.high))
        return tree

    def split(self, members: np.ndarray) -> None:
        if len(members) <= LEAF_ROWS or not self.rows.shape[1]:
            self.leaves.append(members)
            return
        rows = self.rows[members]
        widest = int((rows.max(0) - rows.min(0)).argmax())
        half = len(members) // 2  # by place, so that equal values part too
        order = np.argpartition(rows[:, widest], half)
        self.split(members[order[:half]])
        self.split(members[order[half:]])

    def search(self, names: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int):
        """(query row, id, score) of at most k rows a query with a score of at least ``least``."""
        positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
        bounds = positive @ self.high.T + negative @ self.low.T
        visits = np.argsort(-bounds, axis=1, kind="stable")
        empty = np.iinfo(np.int64).min + 1  # its negative exists, too
        scores = np.full((len(queries), k), empty)
        ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        least = least.copy()
        active = np.arange(len(queries))
        for turn in range(len(self.leaves)):
            leaf_of = visits[active, turn]
            live = bounds[active, leaf_of] >= least[active]
            active, leaf_of = active[live], leaf_of[live]
            for leaf in np.unique(leaf_of):
                own, members = active[leaf_of == leaf], self.leaves[leaf]
                got = (queries[own] @ self.rows[members].T).astype(np.int64)
                got[names[own][:, None] == self.ids[members][None, :]] = empty
                better = got.max(1) >= least[own]
                own, got = own[better], got[better]
                if not len(own):
                    continue
                all_scores = np.concatenate([scores[own], got], 1)
                all_ids = np.concatenate([ids[own], np.broadcast_to(self.ids[members], got.shape)], 1)
                top = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                scores[own] = np.take_along_axis(all_scores, top, 1)
                ids[own] = np.take_along_axis(all_ids, top, 1)
                least[own] = np.maximum(least[own], scores[own, -1])
        row, place = np.nonzero(scores > empty)
        keep = scores[row, place] >= least[row]
        return row[keep], ids[row[keep], place[keep]], scores[row[keep], place[keep]]


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as 64-bit integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all inner products are exact in doubles."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    return most * max(a.shape[1], 1) < 2.0**52


def searcher(k: int):
    """Rows come sorted by shard, length and ``asks``: candidates of a shard before its queries."""

    def found(tree: Tree, queries: pa.RecordBatch) -> pa.RecordBatch:
        wanted, fit = matrix(queries.column("vector")), tree
        if exact(tree.rows, wanted):
            wanted, fit = wanted.astype(np.float64), tree.doubles
        names = queries.column("id").to_numpy()
        row, ids, scores = fit.search(names, wanted, queries.column("least").to_numpy(), k)
        return pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, tree = None, None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            place = np.stack([batch.column(c).to_numpy() for c in ("shard", "length", "asks")])
            cuts = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1).tolist(), len(batch)]
            for a, b in pairwise(cuts):
                here, part = tuple(place[:2, a].tolist()), batch.slice(a, b - a)
                if here != spot:
                    spot, tree, held = here, None, []
                if not place[2, a]:
                    held.append(part)
                    continue
                if held:
                    own = pa.Table.from_batches(held).combine_chunks()
                    tree, held = Tree(own["id"].to_numpy(), matrix(own["vector"])), []
                if tree is not None:
                    yield found(tree, part)

    return walk


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for (vec_id, vector) tables of whole-number vectors."""
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    columns = [F.col("vec_id").alias("id"), "vector", F.size("vector").alias("length")]
    asked = queries.filter(usable).select(columns).distinct()
    rows = vectors.filter(usable).select(columns)
    shards = -(-rows.count() // SHARD_ROWS) or 1
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)))
    start = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards))
    lowest = F.lit(-(1 << 63)).cast("long")
    order = ["shard", "length", "asks"]

    def meet(asked: DataFrame) -> DataFrame:
        """The queries, which name a shard each time, with its candidates."""
        sides = rows.withColumns({"asks": F.lit(0), "least": lowest}).unionByName(asked.withColumn("asks", F.lit(1)))
        return sides.repartition("shard").sortWithinPartitions(*order).mapInArrow(searcher(k), RESULT)

    first = materialize(meet(asked.withColumns({"shard": start, "least": lowest})), "topk")
    known = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    bound = F.when(F.col("n") >= k, F.col("kth")).otherwise(lowest)
    bounded = asked.join(known, asked["id"] == known["query_id"], "left").withColumn("least", bound)
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != start)
    rest = bounded.select("id", "vector", "length", F.explode(others).alias("shard"), "least")
    found = first.unionByName(meet(rest))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", whole(F.col("embedding")).alias("vector"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""
