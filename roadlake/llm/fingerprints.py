"""Document fingerprints as a homomorphic multiset hash (operator 13).

A paragraph is a line. Its vector has EXACT lanes from the SHA-256 of the line, and WIDE lanes that add up, for each of
its sentences, small odd numbers hashed from the sentence times the root of its length. A text's fingerprint is the
sum of its paragraphs' vectors, each lane modulo 2^32. So the order of the paragraphs does not matter, ``insert`` and ``delete`` change a
fingerprint without the text, and the fingerprints of two texts add up to that of both. The wide lanes of two texts have
a dot product that estimates how much of their sentences they share: ``likeness``, 1 for equal fingerprints.

A null text is empty; the empty text is one empty paragraph, whose wide lanes are zero, so it is like no other text.
Successors (``with_next``) follow falling ids, null ids last; rows with one id follow the falling hashes of their texts, and
equal rows follow each other. The last row's successor is the first; a single row follows itself. Further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import arrays, table, trim

EXACT, WIDE = 8, 128
LANES = EXACT + WIDE
#: Sentences whose lanes are worked out at once.
LOT = 4096
#: Characters of rows whose fingerprints are worked out at once; a longer text is alone.
CHARS = 1 << 18
SENTENCE_END = re.compile(r"([.!?]) ")
ORDER = ("known", "id", "tie")


def paragraphs(text: str) -> list[str]:
    return text.split("\n")


def sentences(paragraph: str) -> list[str]:
    return SENTENCE_END.sub("\\1\n", paragraph).split("\n")


def wide(parts: list[str]) -> np.ndarray:
    """A row of WIDE numbers for each sentence: odd ones from -15 to 15 times the root of its length."""
    digests = b"".join(sha256(prefix + p.encode()).digest() for p in parts for prefix in (b"0", b"1"))
    data = np.frombuffer(digests, np.uint8).reshape(len(parts), WIDE // 2)
    digits = np.empty((len(parts), WIDE), np.int32)
    digits[:, ::2], digits[:, 1::2] = data >> 4, data & 15
    return (2 * digits - 15) * np.array([isqrt(len(p)) for p in parts], np.int32)[:, None]


def sums(texts: list[list[str]]) -> np.ndarray:
    """The fingerprint of each list of paragraphs, a row of LANES unsigned 32-bit numbers."""
    out = np.zeros((len(texts), LANES), np.uint32)
    whole = [(i, p) for i, parts in enumerate(texts) for p in parts]
    for first in range(0, len(whole), LOT):
        lot = whole[first : first + LOT]
        lanes = np.frombuffer(b"".join(sha256(p.encode()).digest() for _, p in lot), ">u4").reshape(-1, EXACT)
        np.add.at(out[:, :EXACT], [i for i, _ in lot], lanes.astype(np.uint32))
    pieces = [(i, s) for i, p in whole for s in sentences(p) if s]
    for first in range(0, len(pieces), LOT):
        lot = pieces[first : first + LOT]
        owner = np.array([i for i, _ in lot])
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[heads], EXACT:] += np.add.reduceat(wide([s for _, s in lot]), heads, axis=0, dtype=np.int64).astype(np.uint32)
    return out


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def insert(fingerprint: str, added: list[str]) -> str:
    """The fingerprint with further paragraphs."""
    return as_text(from_text(fingerprint) + sums([added])[0])


def delete(fingerprint: str, gone: list[str]) -> str:
    """The fingerprint without some of its paragraphs."""
    return as_text(from_text(fingerprint) - sums([gone])[0])


def likenesses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of rows: twice the dot product over the sum of squares, in six places; 1 for equal rows."""
    x, y = (m[:, EXACT:].astype(np.uint32).view(np.int32).astype(float) for m in (a, b))
    squares = (x * x).sum(1) + (y * y).sum(1)
    shared = np.divide(2 * (x * y).sum(1), squares, out=np.zeros(len(a)), where=squares > 0)
    return np.where((a == b).all(1), 1.0, np.round(np.clip(shared, 0, 1), 6))


def likeness(a: str, b: str) -> float:
    return float(likenesses(from_text(a)[None], from_text(b)[None])[0])


def fingerprint(df: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of every whole text, as hexadecimal text."""

    @F.arrow_udf("string")
    def hashed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = [pa.array([as_text(f) for f in sums([paragraphs(t or "") for t in part.to_pylist()])], pa.string()) for part in arrays(batch)]
            yield pa.chunked_array(parts, pa.string()).combine_chunks()

    return df.withColumn(into, hashed(F.col(text)))


def with_next(docs: DataFrame, work, schema: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``work`` on lists of (id, text, text of the next row) that cover all rows.

    The order is cut into blocks, one for each shuffle partition, at rows that the range partitioner finds from ids and hashes alone. The texts are
    shuffled once; each block also gets a copy of the first row of the next one. Blocks are read as streams.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"known": F.col("id").isNotNull(), "tie": F.xxhash64("text")})
    falling = [F.col(c).desc() for c in ORDER]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = rows.select(*ORDER).repartitionByRange(n, *falling).groupBy(F.spark_partition_id()).agg(F.max(F.struct(*ORDER)).alias("head"))
    # at most one for each partition
    cuts = sorted((tuple(r["head"]) for r in heads.collect()), key=lambda c: (c[0], c[1] or 0, c[2]), reverse=True)
    shared = [(not known, -(key or 0), -tie) for known, key, tie in cuts]

    @F.arrow_udf("int")
    def block_of(known: pa.Array, ids: pa.Array, ties: pa.Array) -> pa.Array:
        places = zip(known.to_pylist(), ids.to_pylist(), ties.to_pylist())
        return pa.array([bisect_right(shared, (not k, -(i or 0), -t)) - 1 for k, i, t in places], pa.int32())

    blocked = rows.withColumn("block", block_of("known", "id", "tie"))
    if not cuts:
        return spark.createDataFrame([], schema)
    kind = f"known boolean, id {dict(rows.dtypes)['id']}, tie long, block int"
    at = spark.createDataFrame([(*c, b) for b, c in enumerate(cuts)], kind)
    here = [rows[c].eqNullSafe(at[c]) for c in ORDER]
    first = rows.join(F.broadcast(at), here[0] & here[1] & here[2]).groupBy("block").agg(F.max(F.struct(rows["known"], rows["id"], rows["tie"], "text")).alias("row"))
    guests = first.select("row.*", F.pmod(F.col("block") - 1, F.lit(len(cuts))).cast("int").alias("block"), F.lit(True).alias("guest"))
    dealt = blocked.withColumn("guest", F.lit(False)).unionByName(guests).repartition("block")
    ordered = dealt.sortWithinPartitions("block", "guest", *falling, F.col("text").desc()).select("id", "text", "block", "guest")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        before = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if before is not None and before[2] == row[2]:
                    held.append((before[0], before[1], row[1]))
                    size += len(before[1])
                before = None if row[3] else row
                if size > CHARS:
                    yield work(held)
                    held, size = [], 0
        if held:
            yield work(held)
        trim()

    return ordered.mapInArrow(walk, schema)


def edit(text: str, other: str) -> str:
    """The text with its later half replaced by as much of another's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def edited_lanes(lanes: np.ndarray, before: list[list[str]], after: list[list[str]]) -> np.ndarray:
    """Fingerprints after an edit: the paragraphs that changed are deleted and inserted, the others are not hashed again."""
    gone, new = [], []
    for old, now in zip(before, after):
        same = next((i for i, (a, b) in enumerate(zip(old, now)) if a != b), min(len(old), len(now)))
        gone.append(old[same:])
        new.append(now[same:])
    return lanes - sums(gone) + sums(new)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def judged(rows: list[tuple]) -> pa.RecordBatch:
        ids, texts, nexts = ([r[i] for r in rows] for i in range(3))
        edited = [edit(t, o) for t, o in zip(texts, nexts)]
        parts = [paragraphs(t) for t in texts]
        # a row's successor is the next row, but for gaps between blocks
        lanes = sums(parts)
        following = np.roll(lanes, -1, axis=0)
        other = [i for i, o in enumerate(nexts) if i + 1 == len(texts) or o != texts[i + 1]]
        following[other] = sums([paragraphs(nexts[i]) for i in other])
        changed = edited_lanes(lanes, parts, [paragraphs(t) for t in edited])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([sha256(t.encode()).hexdigest() for t in edited]), pa.array([as_text(f) for f in lanes]),
                pa.array([as_text(f) for f in changed]), pa.array(likenesses(lanes, changed)), pa.array(likenesses(lanes, following)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return with_next(
        docs, judged, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


#: Lanes of all texts and edited texts, as sums over the distinct paragraphs and sentences of both.
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS k FROM documents),
e AS (SELECT d.doc_id, d.k, d.t, length(d.t) AS n, o.k AS next_k, left(d.t, length(d.t) - length(d.t) // 2) || left(o.t, length(d.t) // 2) AS u
  FROM d JOIN d o ON o.k = d.k % (SELECT max(k) FROM d) + 1),
texts AS (SELECT k, 0 AS side, t AS x FROM e UNION ALL SELECT k, 1, u FROM e),
lines AS (SELECT k, side, unnest(string_split(x, chr(10))) AS p FROM texts),
parts AS (SELECT k, side, unnest(string_split(regexp_replace(p, '([.!?]) ', '\\1' || chr(10), 'g'), chr(10))) AS s FROM lines),
heads AS (SELECT DISTINCT p, sha256(p) AS h FROM lines),
hashes AS (SELECT DISTINCT s, CAST(floor(sqrt(length(s))) AS BIGINT) AS w, sha256('0' || s) || sha256('1' || s) AS h FROM parts),
lanes AS (
  SELECT k, side, lane, sum(('0x' || substr(h, lane * 8 + 1, 8))::BIGINT) AS v FROM lines JOIN heads USING (p), range({EXACT}) l(lane) GROUP BY ALL
  UNION ALL
  SELECT k, side, lane + {EXACT}, sum(w * (2 * instr('0123456789abcdef', substr(h, lane + 1, 1)) - 17)) FROM parts JOIN hashes USING (s), range({WIDE}) l(lane) GROUP BY ALL),
wrapped AS (SELECT k, side, lane, CAST(((v % 4294967296) + 4294967296) % 4294967296 AS BIGINT) AS v FROM lanes),
prints AS (SELECT k, side, string_agg(printf('%08x', v), '' ORDER BY lane) AS f,
  list(CASE WHEN v >= 2147483648 THEN v - 4294967296 ELSE v END::DOUBLE ORDER BY lane) FILTER (lane >= {EXACT}) AS x FROM wrapped GROUP BY ALL),
pairs AS (SELECT e.doc_id, e.n, e.u, a.f AS fa, b.f AS fb, c.f AS fc,
    list_dot_product(a.x, a.x) AS aa, list_dot_product(b.x, b.x) AS bb, list_dot_product(c.x, c.x) AS cc,
    list_dot_product(a.x, b.x) AS ab, list_dot_product(a.x, c.x) AS ac
  FROM e JOIN prints a ON a.k = e.k AND a.side = 0 JOIN prints b ON b.k = e.k AND b.side = 1 JOIN prints c ON c.k = e.next_k AND c.side = 0)
SELECT doc_id, n AS n_chars, sha256(u) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
  CASE WHEN fa = fb THEN 1.0 WHEN aa + bb = 0 THEN 0.0 ELSE round(greatest(0.0, least(1.0, 2 * ab / (aa + bb))), 6) END::DOUBLE AS near_edited,
  CASE WHEN fa = fc THEN 1.0 WHEN aa + cc = 0 THEN 0.0 ELSE round(greatest(0.0, least(1.0, 2 * ac / (aa + cc))), 6) END::DOUBLE AS near_next
FROM pairs
"""
