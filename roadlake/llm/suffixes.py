"""Suffix-array dedup with longest-previous-factor arrays (operator 6).

A byte is repeated if it lies in a string of WIDTH bytes that also starts elsewhere, in any text, the same one included.
Records of texts that may repeat meet by their anchors (see anchors.py) and are set one after the other,
in the order of their positions. Their suffixes are sorted by prefix doubling up to WIDTH bytes. In suffix
order, the nearest smaller position before and after a suffix gives its longest previous factor; the nearest larger
ones give the longest following factor. Where the former reaches WIDTH a later copy starts; where
either does, a repeated string starts. ``keep_first`` removes later copies only and keeps the first
(smaller doc_id, null last, or earlier start); otherwise all copies go.

A null text is empty. Each row is a text of its own, repeated rows too, but with ``keep_first`` rows with equal
ids and equal texts are one document. Cuts may fall inside a character, so what stays is binary. Further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import anchors
from roadlake.llm.common import runs, table
from roadlake.session import materialize

WIDTH, GRAM = 400, 32
#: Bytes of records whose suffixes are sorted together; an anchor with more is sorted alone.
LOT = 1 << 20
UNIQUE = -1


def ranks(data: np.ndarray, width: int) -> np.ndarray:
    """For each place a number that equal strings of ``width`` bytes share, growing in suffix order; UNIQUE if
    the string is the only one of its kind or does not fit."""
    n = len(data)
    length = 1
    rank = data.astype(np.int64)
    while length < width:
        step = min(length, width - length)
        reach = n - step
        first, second = rank[:reach], rank[step:]
        active = np.flatnonzero((first != UNIQUE) & (second != UNIQUE))
        pairs = (first[active] << 32) | second[active]
        rank = np.full(n, UNIQUE, np.int64)
        if len(active):
            order = np.argsort(pairs, kind="stable")
            ordered = pairs[order]
            new = np.append(True, ordered[1:] != ordered[:-1])
            number = np.cumsum(new) - 1
            alone = new & np.append(new[1:], True)
            number[alone] = UNIQUE
            rank[active[order]] = number
        length += step
    return rank


def factors(rank: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous and the longest following factor at each start reach the width.

    Among suffixes that agree on the width, the previous smaller (larger) position is the one before (after) in a
    stable suffix order.
    """
    chosen = np.flatnonzero(rank[starts] != UNIQUE)
    order = chosen[np.argsort(rank[starts[chosen]], kind="stable")]
    same = rank[starts[order]][1:] == rank[starts[order]][:-1]
    previous, following = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    previous[order[1:]] = same
    following[order[:-1]] = same
    return previous, following


def repeated(records: DataFrame, width: int, keep_first: bool) -> DataFrame:
    """(hash, size, start, end): runs of windows in records that other (earlier) records hold."""

    def search(lot: list[tuple]) -> pa.RecordBatch | None:
        lengths = np.array([len(r[4]) for r in lot])
        data = np.frombuffer(b"".join(r[4] for r in lot), np.uint8)
        begins = np.cumsum(lengths) - lengths
        own = lengths - width + 1  # windows of each record
        owner = np.repeat(np.arange(len(lot)), own)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(own) - own, own)
        previous, following = factors(ranks(data, width), begins[owner] + offset)
        hit = previous if keep_first else previous | following
        edge = hit & np.append(True, ~hit[:-1] | (owner[1:] != owner[:-1]))
        stop = hit & np.append(~hit[1:] | (owner[1:] != owner[:-1]), True)
        first, last = np.flatnonzero(edge), np.flatnonzero(stop)
        if not len(first):
            return None
        text, size, start = (np.array([r[i] for r in lot]) for i in (1, 3, 2))
        of = owner[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(text[of]), pa.array(size[of].astype(np.int32)), pa.array((start[of] + offset[first]).astype(np.int32)),
             pa.array((start[of] + offset[last]).astype(np.int32))],
            ["hash", "size", "start", "end"],
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, held = [], 0
        for group in runs(batches, "place"):
            rows = sorted({(r["id"], r["hash"], r["start"], r["size"], r["content"]) for r in group.to_pylist()})
            if len(rows) < 2:
                continue
            lot += rows
            held += sum(len(r[4]) for r in rows)
            if held >= LOT:
                if (out := search(lot)) is not None:
                    yield out
                lot, held = [], 0
        if lot and (out := search(lot)) is not None:
            yield out

    return records.repartition("place").sortWithinPartitions("place").mapInArrow(walk, "hash long, size int, start int, end int")


def cut(width: int):
    def parts(text: bytes, wanted: list[tuple[int, int]]) -> list[bytes]:
        return [text[start : end + width] for start, end in wanted]

    return parts


def windows(width: int):
    def parts(content: bytes) -> list[bytes]:
        return [content[i : i + width] for i in range(len(content) - width + 1)]

    return parts


def removed(rows: DataFrame, width: int, keep_first: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data = row["text"].encode()
                n = len(data)
                spans = [(s["start"], s["end"] + width) for s in row["spans"] or ()]
                if n >= width and (row["id"] != row["least"] if keep_first else row["copies"] > 1):
                    spans = [(0, n)]
                merged: list[list[int]] = []
                for start, end in sorted(spans):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                borders = [0, *(x for span in merged for x in span), n]
                stay = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2]))
                out.append((row["doc_id"], n, n - len(stay), len(merged), stay))
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    kind = dict(rows.dtypes)["doc_id"]
    columns = ("doc_id", "id", "least", "copies", "text", "spans")
    return rows.select(*columns).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, gram: int = GRAM, keep_first: bool = True
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): for each row the bytes that stay."""
    rows = anchors.plain(docs, text, key)
    found = anchors.records(rows, anchors.byte_tokens, width, gram)
    sifted = anchors.sifted(found, everywhere=not keep_first)
    closer = materialize(anchors.contents(rows, sifted.filter("closer"), cut(width)), "contents")
    whole = sifted.filter("not closer").select("hash", "size", "start", "end")
    spans = whole.unionByName(repeated(closer.filter("not crowded"), width, keep_first))
    spans = spans.unionByName(anchors.window_by_window(closer.filter("crowded"), windows(width), everywhere=not keep_first))
    return removed(anchors.with_spans(rows, spans), width, keep_first)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of a repeated string go, the first one too."""
    kept = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_first=False)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
