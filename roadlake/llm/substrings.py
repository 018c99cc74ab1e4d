"""Substring dedup by relative Lempel-Ziv parsing (operator 5).

Of every repeated run of WIDTH words, all but the first occurrence are removed; first is the smaller doc_id
(null last), or the earlier start in one text. Words are split at ASCII white space and compared as they are.

Records of texts that may repeat meet by their anchors (see anchors.py): the reference blocks. A record
is factored greedily against every block before it: at each place the longest match in any block is taken from a sorted
list of the blocks' suffixes. A factor of WIDTH words or more is a duplicate span. Windows that cross the end
of a factor are checked by factoring again from the first of them, so that spans joined from several sources
are found, too. Blocks double in size like the levels of a log-structured index: each suffix is merged a logarithmic
number of times.

A null text has no words. Rows with equal ids and equal texts are one document and get the same result;
rows with equal ids and different texts come in the order of a hash of the text. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import anchors
from roadlake.llm.common import per_group, table
from roadlake.session import materialize

WIDTH, GRAM = 20, 5


class Blocks:
    """Sorted suffixes of the records so far, in blocks of doubling size."""

    def __init__(self):
        self.blocks: list[list[tuple]] = []

    def longest(self, words: tuple) -> int:
        """Of the longest beginning of ``words`` that a block holds, the length."""
        best = 0
        for block in self.blocks:
            at = bisect_left(block, words)
            for other in block[max(at - 1, 0) : at + 1]:
                n = 0
                for a, b in zip(words, other):
                    if a != b:
                        break
                    n += 1
                best = max(best, n)
        return best

    def add(self, suffixes: list[tuple]) -> None:
        self.blocks.append(sorted(suffixes))
        while len(self.blocks) > 1 and len(self.blocks[-2]) <= 2 * len(self.blocks[-1]):
            last = self.blocks.pop()
            self.blocks[-1] = sorted(self.blocks[-1] + last)


def factored(blocks: Blocks, words: tuple, width: int) -> list[tuple[int, int]]:
    """(first, last) window of each run of windows that the blocks hold."""
    found, at = [], 0
    while at + width <= len(words):
        length = blocks.longest(words[at:])
        if length < width:
            at += 1
            continue
        last = at + length - width
        if found and found[-1][1] == at - 1:
            found[-1] = (found[-1][0], last)
        else:
            found.append((at, last))
        at = last + 1  # the first window over the factor's end
    return found


def cut(width: int):
    def parts(text: bytes, wanted: list[tuple[int, int]]) -> list[bytes]:
        words = text.split()
        return [b" ".join(words[start : end + width]) for start, end in wanted]

    return parts


def windows(width: int):
    def parts(content: bytes) -> list[bytes]:
        words = content.split(b" ")
        return [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]

    return parts


def parsed(records: DataFrame, width: int) -> DataFrame:
    """(hash, size, start, end): runs of windows in records that earlier records with the same anchor hold."""

    def work(group: pa.Table) -> pa.Table | None:
        rows = sorted({(r["id"], r["hash"], r["start"], r["size"], r["content"]) for r in group.to_pylist()})
        if len(rows) < 2:
            return None
        numbers: dict[bytes, int] = {}
        blocks, out = Blocks(), []
        for _, text, start, size, content in rows:
            words = tuple(numbers.setdefault(w, len(numbers)) for w in content.split(b" "))
            out += [(text, size, start + a, start + b) for a, b in factored(blocks, words, width)]
            blocks.add([words[i:] for i in range(len(words) - width + 1)])
        if not out:
            return None
        return pa.table({n: pa.array(c, k) for n, c, k in zip(
            ("hash", "size", "start", "end"), zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int32()))})

    return per_group(records, ["place"], work, "hash long, size int, start int, end int")


def removed(rows: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = row["text"].encode().split()
                n = len(words)
                gone = np.zeros(n + 1, np.int64)
                if row["id"] != row["least"] and n >= width:
                    gone[0] += 1
                for span in row["spans"] or ():
                    gone[span["start"]] += 1
                    gone[min(span["end"] + width, n)] -= 1
                stay = np.cumsum(gone[:n]) <= 0
                left = int(stay.sum())
                out.append((row["doc_id"], n, n - left, b" ".join(words if left == n else compress(words, stay.tolist())).decode()))
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.string())
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_words", "n_removed", "kept"])

    kind = dict(rows.dtypes)["doc_id"]
    columns = ("doc_id", "id", "least", "text", "spans")
    return rows.select(*columns).mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): for each row the words that stay, joined by single blanks."""
    rows = anchors.plain(docs, text, key)
    sifted = anchors.sifted(anchors.records(rows, anchors.word_tokens, width, gram), everywhere=False)
    closer = materialize(anchors.contents(rows, sifted.filter("closer"), cut(width)), "contents")
    whole = sifted.filter("not closer").select("hash", "size", "start", "end")
    repeated = whole.unionByName(parsed(closer.filter("not crowded"), width))
    repeated = repeated.unionByName(anchors.window_by_window(closer.filter("crowded"), windows(width), everywhere=False))
    return removed(anchors.with_spans(rows, repeated), width)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
windows AS (SELECT doc_id, p, array_to_string(ws[p : p + 19], ' ') AS words FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM w)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY words ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM later),
placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
