"""Benchmark decontamination by pigeonhole edit matching (operator 7).

A text holds a test item if some stretch of it lies within ``rate`` times the item's length in edits
(insertions, deletions, substitutions). The item is cut into one piece more than the edits allowed, so
at least one piece stays whole in any such stretch. An Aho-Corasick pass over each text finds the
pieces; around each hit Myers' bit-parallel distance decides, unless so many of the item's runs of GRAM characters are
missing there that the edits can't account for it: each edit changes at most GRAM of them. Texts and items are compared
in lower case with white space collapsed to single blanks.

Items are sent to all tasks in lots of at most LOT_BYTES of text, one pass over the texts for each lot;
the table is stored between two passes.

A null or blank item, and a null text, match nothing. Items shorter than 1 / rate characters must occur
exactly. Equal items are reported each. Repeated rows and further columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import arrays, table, unused
from roadlake.session import materialize

RATE = 0.08
GRAM = 4
LOT_BYTES = 16 << 20
LEAKS = "array<struct<item_id:bigint,start:int,end:int,distance:int>>"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, rate: float) -> int:
    return int(rate * len(item))


def cut(item: str, parts: int) -> list[tuple[int, str]]:
    """(offset, piece): consecutive pieces of nearly equal length."""
    ends = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def grams(text: str) -> list[str]:
    return [text[i : i + GRAM] for i in range(len(text) - GRAM + 1)]


def missing(item: str, window: str) -> int:
    """How many runs of GRAM characters of the item the window lacks."""
    seen = set(grams(window))
    return sum(run not in seen for run in grams(item))


def best_end(item: str, text: str) -> tuple[int, int]:
    """(distance, end) of the stretch of ``text`` closest to ``item``; the first of equals. Myers 1999, one word."""
    places: dict[str, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    full, last = (1 << len(item)) - 1, 1 << len(item) - 1
    up, down, score = full, 0, len(item)
    best = (score, 0)
    for j, c in enumerate(text, 1):
        same = places.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right = down | ~(diagonal | up) & full
        left = diagonal & up
        if right & last:
            score += 1
        elif left & last:
            score -= 1
        if score < best[0]:
            best = (score, j)
        right = right << 1 & full
        left = left << 1 & full
        up = left | ~((diagonal | down) | right) & full
        down = right & (diagonal | down)
    return best


class Items:
    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.items = [(name, normal(text)) for name, text in items]
        self.rate = rate
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(self.items):
            if item:
                for offset, piece in cut(item, budget(item, rate) + 1):
                    where.setdefault(piece, []).append((n, offset))
        self.pieces = ahocorasick.Automaton()
        for piece, owners in where.items():
            self.pieces.add_word(piece, (len(piece), owners))
        self.empty = not where
        if where:
            self.pieces.make_automaton()

    def leaks(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, distance) of the closest stretch for each item that the text holds."""
        if self.empty or not text:
            return []
        starts: dict[int, list[int]] = {}  # where an item would begin, by its hits
        for end, (length, owners) in self.pieces.iter(text):
            for n, offset in owners:
                starts.setdefault(n, []).append(end + 1 - length - offset)
        found = []
        for n, places in sorted(starts.items()):
            item, best = self.items[n][1], None
            most, done = budget(item, self.rate), -1
            for first, last in stretches(sorted(set(places)), most):
                done = max(first - most, 0)
                window = text[done : last + len(item) + most]
                if (at := window.find(item)) >= 0:
                    hit = (0, done + at, done + at + len(item))
                elif missing(item, window) > GRAM * most:
                    continue
                else:
                    distance, end = best_end(item, window)
                    if distance > most:
                        continue
                    _, back = best_end(item[::-1], window[:end][::-1])
                    hit = (distance, done + end - back, done + end)
                if best is None or hit < best:
                    best = hit
            if best:
                found.append((n, best[1], best[2], best[0]))
        return found


def stretches(places: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """Runs of places, each at most ``reach`` after the one before it."""
    first = last = None
    for place in places:
        if first is None:
            first = place
        elif place > last + reach:
            yield first, last
            first = place
        last = place
    if first is not None:
        yield first, last


def words_around(text: str, start: int, end: int) -> tuple[int, int]:
    """The words of the original text that hold a stretch of its normal form."""
    at, first, last = 0, None, 0
    for word in re.finditer(r"\S+", text):
        length = len(word[0].lower())
        if at + length > start and first is None:
            first = word.start()
        if at < end:
            last = word.end()
        else:
            break
        at += length + 1
    return first or 0, last


def search(df: DataFrame, items: list[tuple[int | None, str]], text: str, into: str, rate: float) -> DataFrame:
    lot = df.sparkSession.sparkContext.broadcast(items)
    fields = [("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("distance", pa.int32())]
    kind = pa.list_(pa.struct(fields))

    @F.arrow_udf(LEAKS)
    def leaks(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Items(lot.value, rate)

        def row(text: str | None) -> list[dict]:
            found = known.leaks(normal(text))
            return [
                dict(zip(("item_id", "start", "end", "distance"), (known.items[n][0], *words_around(text, a, b), d)))
                for n, a, b, d in found
            ]

        for column in columns:
            yield pa.chunked_array([pa.array([row(t) for t in part.to_pylist()], kind) for part in arrays(column)], kind).combine_chunks()

    return df.withColumn(into, leaks(F.col(text)))


def lots(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items in lots of bounded size; the driver holds one of them at a time."""
    rows = benchmark.select(F.col(item_id).cast("long"), F.col(text)).na.drop(subset=[text]).orderBy(item_id, text)
    lot, held = [], 0
    for name, item in rows.toLocalIterator():
        size = len(item.encode())
        if lot and held + size > LOT_BYTES:
            yield lot
            lot, held = [], 0
        lot.append((name, item))
        held += size
    yield lot


def find(
    df: DataFrame, benchmark: DataFrame, text: str = "text", into: str = "leaks", item_id: str = "item_id",
    item_text: str = "text", rate: float = RATE,
) -> DataFrame:
    """``df`` with an array of (item_id, start, end, distance): the items that each text holds.

    ``start`` and ``end`` are code points of the text as it is, widened to whole words.
    """
    found, lot_leaks = df, unused(df, f"_{into}")
    for number, lot in enumerate(lots(benchmark, item_id, item_text)):
        if number:  # so that the plan, and what its tasks hold, is that of one lot
            found = materialize(found, "leaks")
        found = search(found, lot, text, lot_leaks, rate)
        leaks = F.concat(into, lot_leaks) if number else F.col(lot_leaks)
        found = found.withColumn(into, leaks).drop(lot_leaks)
    return found


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("leaks")).select(
        "doc_id", "item_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "distance"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a test item go."""
    leaks = unused(docs, "_leaks")
    found = find(docs, table(spark, sf_dir, "benchmark"), into=leaks)
    return found.filter(F.size(leaks) == 0).select(docs.columns)
