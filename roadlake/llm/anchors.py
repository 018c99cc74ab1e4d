"""Repeated stretches of exactly known length, found through shared anchors.

A window is ``width`` consecutive tokens (words or bytes) of one text. The anchor of a window is the least of its
``gram``-token hashes: windows with equal tokens have the same anchor at the same place. The windows
of a text that share one anchor are neighbours and form a record: (anchor hash, hash of all tokens of these
windows). Records are counted by anchor and tokens, folded before they are shuffled:

- records with equal tokens hold equal windows throughout; nothing else has to be known of them;
- an anchor whose records differ needs a closer look at one record of each kind. Their tokens are
  fetched from the texts and compared exactly by the caller.

Texts are known by a 64-bit hash and their size. Equal texts of one batch send their records once; what happens to
further copies of a text is decided by its count and least id, not by records. Only counts, positions
and hashes are shuffled by anchor; no task collects an anchor's records. Anchors with more than CROWD different
records are not looked at in one task: their windows are hashed (128 bits) and counted one by one.

Columns: id (the least id of the text in the batch; null ids come last), hash, size, start and end
(first and last window of the record), place (anchor), tokens (hash of the record).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import slices
from roadlake.llm.hashing import BYTE, Powers, U, words
from roadlake.session import discard, materialize

LAST = (1 << 63) - 1
#: Bits of a place within a slice, below the bits of a gram's hash.
PLACE = 28
#: Records of an anchor that are compared in one task; the windows of larger groups are compared one by one.
CROWD = 10_000
RECORD = "place long, tokens long, id long, hash long, size int, start int, end int"


def plain(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc_id, text, id, hash, size)"""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumns({
        "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "hash": F.xxhash64("text"), "size": F.octet_length("text"),
    })


def word_tokens(powers: Powers, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, _, firsts = words(powers, data, offsets)
    return hashes, firsts


def byte_tokens(powers: Powers, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE[data], offsets


def records_of(powers: Powers, values: np.ndarray, firsts: np.ndarray, width: int, gram: int):
    """(place, tokens, text, start, end) of all records; start and end count from the beginning of their text."""
    n = len(values)
    counts = np.diff(firsts)
    if n < width or counts.max(initial=0) < width:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    sums = powers.sums(values)
    at = np.arange(n - gram + 1)
    grams = powers.stretches(sums, at, at + gram)
    least = (grams >> U(PLACE) << U(PLACE)) | at.astype(np.uint64)
    reach, wanted = 1, width - gram + 1
    while 2 * reach <= wanted:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < wanted:
        least = np.minimum(least[: len(least) - (wanted - reach)], least[wanted - reach :])
    anchors = (least & U((1 << PLACE) - 1)).astype(np.int64)
    inside = np.zeros(n + 1, np.int8)  # the windows that lie in one text
    long_enough = counts >= width
    np.add.at(inside, firsts[:-1][long_enough], 1)
    np.add.at(inside, firsts[1:][long_enough] - width + 1, -1)
    inside = np.cumsum(inside[: len(anchors)], dtype=np.int8) > 0
    # two texts never share an anchor: a gram that crosses their border is in no window of either
    new = np.ones(len(anchors), bool)
    new[1:] = anchors[1:] != anchors[:-1]
    new[1:] |= inside[1:] != inside[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(anchors)) - 1
    keep = inside[starts]
    starts, ends = starts[keep], ends[keep]
    text = np.searchsorted(firsts, starts, "right") - 1
    places = grams[anchors[starts]].view(np.int64)
    tokens = powers.stretches(sums, starts, ends + width).view(np.int64)
    return places, tokens, text, starts - firsts[text], ends - firsts[text]


def records(rows: DataFrame, tokenize: Callable, width: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("hash").to_numpy()
            order = np.lexsort((ids, hashes))
            first = order[np.append(True, hashes[order][1:] != hashes[order][:-1])] if len(order) else order
            batch = batch.take(pa.array(np.sort(first)))  # one row for each distinct text, that of the least id
            for a, b, data, offsets in slices(batch.column("text")):
                places, tokens, text, starts, ends = records_of(powers, *tokenize(powers, data, offsets), width, gram)
                own = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(places), pa.array(tokens), *(batch.column(c).take(own) for c in ("id", "hash", "size")),
                        pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32)),
                    ],
                    ["place", "tokens", "id", "hash", "size", "start", "end"],
                )

    return rows.select("id", "hash", "size", "text").mapInArrow(run, RECORD)


def sifted(found: DataFrame, everywhere: bool) -> DataFrame:
    """(place, id, hash, size, start, end, closer): records whose windows are all repeated, and those to look at closer.

    Repeated means: before, in the order of id, hash and start; or, if ``everywhere``, at any other place. A kind (equal
    place and tokens) is folded to its first record and count before it is shuffled; what is joined are stored tables, so a
    place that a third of all records share is split among tasks. The result is stored, the tables on the way are deleted.
    """
    found = materialize(found, "found")
    first = F.min(F.struct("id", "hash", "start", "size", "end")).alias("first")
    kinds = materialize(found.groupBy("place", "tokens").agg(first, F.count("*").alias("n")), "kinds")
    several = materialize(kinds.groupBy("place").agg(F.count("*").alias("n")).filter("n > 1").select("place"), "places")
    again = materialize(kinds.filter("n > 1").select("place", "tokens", F.struct("first.hash", "first.start").alias("head")), "again")
    closer = kinds.join(several, "place", "left_semi").select("place", "first.*", F.lit(True).alias("closer"))
    whole = found.join(again, ["place", "tokens"])
    if not everywhere:
        whole = whole.filter(F.struct("hash", "start") != F.col("head"))
    columns = ["place", "id", "hash", "size", "start", "end", "closer"]
    result = materialize(whole.withColumn("closer", F.lit(False)).select(columns).unionByName(closer.select(columns)), "records")
    for used in (found, kinds, several, again):
        discard(used)
    return result


def contents(rows: DataFrame, closer: DataFrame, cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]]) -> DataFrame:
    """(place, id, hash, size, start, crowded, content) of records, their tokens taken from the texts by ``cut``.
    Crowded are the records of an anchor that has more than CROWD of them. Their places are stored before they are joined,
    so the records of one place are split among tasks."""
    crowds = materialize(closer.groupBy("place").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD), "crowds")
    flagged = closer.join(crowds, "place", "left").withColumn("crowded", F.col("n").isNotNull())
    wanted = flagged.groupBy("id", "hash", "size").agg(F.collect_list(F.struct("place", "start", "end", "crowded")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "id", "hash", "size", "start", "crowded", "content"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row in batch.to_pylist():
                parts = cut(row["text"].encode(), [(r["start"], r["end"]) for r in row["own"]])
                for record, part in zip(row["own"], parts):
                    for column, value in zip(out, (record["place"], row["id"], row["hash"], row["size"], record["start"], record["crowded"], part)):
                        column.append(value)
                if len(out[0]) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    texts = rows.select("id", "hash", "size", "text").join(wanted, ["id", "hash", "size"])
    return texts.mapInArrow(run, "place long, id long, hash long, size int, start int, crowded boolean, content binary")


def window_by_window(records: DataFrame, windows: Callable[[bytes], list[bytes]], everywhere: bool) -> DataFrame:
    """(hash, size, start, end): repeated windows of crowded records, each window on its own.

    Equal windows are folded before they are shuffled, so an anchor that a third of all texts share stays spread.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["window", "id", "hash", "size", "start"]
        for batch in batches:
            parts = [windows(content) for content in batch.column("content").to_pylist()]
            counts = np.array([len(p) for p in parts])
            own = np.repeat(np.arange(len(parts)), counts)
            starts = batch.column("start").to_numpy()[own] + np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
            keys = pa.array([blake2b(w, digest_size=16).digest() for p in parts for w in p], pa.binary())
            taken = [batch.column(c).take(pa.array(own)) for c in ("id", "hash", "size")]
            yield pa.RecordBatch.from_arrays([keys, *taken, pa.array(starts.astype(np.int32))], names)

    found = records.mapInArrow(run, "window binary, id long, hash long, size int, start int").distinct()
    place = F.struct("id", "hash", "start")
    firsts = found.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter(F.col("n") > 1)
    met = found.join(firsts, "window")
    return (met if everywhere else met.filter(place != F.col("first"))).select("hash", "size", "start", F.col("start").alias("end"))


def with_spans(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows with ``spans`` (first and last window of each repeated run), ``least`` (id of the text) and ``copies``."""
    texts = rows.groupBy("hash", "size").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # every batch with a copy of a text tells its spans again: once each, so a list is bounded by its text
    spans = repeated.select("hash", "size", "start", "end").distinct().groupBy("hash", "size").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return rows.join(texts.join(spans, ["hash", "size"], "left"), ["hash", "size"])
