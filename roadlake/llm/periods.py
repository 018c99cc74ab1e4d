"""Periodic run detection with suffix trees (operator 12).

A run is a stretch of words with smallest period q and at least max(LEAST, 2 q) words that no neighbouring word continues.
Every run has a Lyndon root: at some place of it the longest Lyndon word, by the order of suffixes or by the
reverse order, has q words. So each place gives two candidates, the way to the next smaller and to the next
larger suffix. Ukkonen trees of the words and of their reversal answer how far a candidate's period
holds to the right and to the left: the depth of the lowest common ancestor of two leaves is the least
depth between them on the Euler tour, looked up in a sparse table in constant time.

Each word of a run lies in a stretch of (LEAST + 1) // 2 words that its text holds twice. Other words are left out first, by
hashes that can only keep too much; the stretches that stay stand in one pair of trees, parted by marks that occur once.

A null text has no words. Each row is a text of its own, repeated rows too. A text is worked on by one task, whose memory grows with the
words of it that may be in runs (about 1 kB each). Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import arrays, table

LEAST = 12
BASE = np.uint64(0x9E3779B97F4A7C15)
Run = tuple[int, int, int]


def tree(word: list[int], kinds: int) -> tuple[list[int], list[int], list[int]]:
    """Ukkonen's suffix tree of numbers below ``kinds``, of which the last occurs once: for each node the parent, and the
    place and the end of the label on the edge to it. Node 0 is the root; a leaf's label ends with the text."""
    size = len(word)
    child: dict[int, int] = {}
    parent, begin, end, link = [0], [0], [0], [0]
    node = edge = length = pending = 0
    for i, letter in enumerate(word):
        waiting = 0
        pending += 1
        while pending:
            if not length:
                edge = i
            key = node * kinds + word[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(begin)
                parent.append(node)
                begin.append(i)
                end.append(size)
                link.append(0)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                start = begin[below]
                span = min(end[below], i + 1) - start
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if word[start + length] == letter:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                middle = len(begin)
                child[key] = middle
                parent += (node, middle)
                begin += (start, i)
                end += (start + length, size)
                link += (0, 0)
                begin[below] = start + length
                parent[below] = middle
                child[middle * kinds + word[start + length]] = below
                child[middle * kinds + letter] = middle + 1
                if waiting:
                    link[waiting] = middle
                waiting = middle
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return parent, begin, end


def tour(word: list[int], kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depths along the Euler tour of the suffix tree, the place of each suffix's leaf on it, and the rank of each suffix."""
    parent, begin, end = (np.array(x, np.int64) for x in tree(word, kinds))
    nodes, size = len(parent), len(word)
    first = np.array(word, np.int64)[begin]
    order = np.lexsort((first[1:], parent[1:])) + 1  # children of a node in the order of their letters
    offsets = np.searchsorted(parent[order], np.arange(nodes + 1)).tolist()
    children, lengths = order.tolist(), (end - begin).tolist()
    depth = [0] * nodes
    depths: list[int] = []
    leaves: list[int] = []
    stack = [0]
    while stack:
        node = stack.pop()
        if node < 0:  # back from a child
            depths.append(depth[~node])
            continue
        here = depth[node]
        if offsets[node] == offsets[node + 1]:
            leaves.append(len(depths))
        depths.append(here)
        for below in reversed(children[offsets[node] : offsets[node + 1]]):
            depth[below] = here + lengths[below]
            stack += (~node, below)
    line, spots = np.array(depths, np.int32), np.array(leaves, np.int64)
    suffix = size - line[spots]
    place, rank = np.empty(size, np.int64), np.empty(size, np.int64)
    place[suffix], rank[suffix] = spots, np.arange(size)
    return line, place, rank


def common(line: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes a and b (never the same): least depths on the tour.

    The sparse table is made level by level; each pair is looked up at the level of its distance.
    """
    left, right = np.minimum(place[a], place[b]), np.maximum(place[a], place[b])
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.zeros(len(a), np.int64)
    step = 1
    for k in range(int(level.max(initial=-1)) + 1):
        here = np.flatnonzero(level == k)
        out[here] = np.minimum(line[left[here]], line[right[here] - step + 1])
        line = np.minimum(line[:-step], line[step:])
        step *= 2
    return out


def following(rank: list[int]) -> np.ndarray:
    """For each place the next one with a smaller rank, else the end."""
    out = [len(rank)] * len(rank)
    stack: list[int] = []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out)


def candidates(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches whose words all lie in a string of (least + 1) // 2 words that occurs twice."""
    n, width = len(ids), (least + 1) // 2
    if n < least:
        return []
    hashes = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        hashes = hashes * BASE + ids[k : n - width + 1 + k].astype(np.uint64)
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    if not equal.any():
        return []
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.flatnonzero(twice), 1)
    np.add.at(change, np.flatnonzero(twice) + width, -1)
    inside = np.concatenate([[False], np.cumsum(change[:n]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).tolist()
    return [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b - a >= least]


def runs(ids: list[int], least: int = LEAST) -> list[Run]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    numbers = np.array(ids, np.int64)
    parts = candidates(numbers, least)
    if not parts:
        return []
    # marks, smaller than all words, part the stretches; the last one ends the text and is the smallest
    marks = len(parts)
    used, letters = np.unique(np.concatenate([numbers[a:b] for a, b in parts]), return_inverse=True)
    kinds = marks + len(used)
    word: list[int] = []
    origin: list[int] = []
    done = 0
    for number, (a, b) in enumerate(parts, start=1):
        word += (letters[done : done + b - a] + marks).tolist()
        word.append(number % marks)
        origin += range(a, b + 1)
        done += b - a
    size = len(word)
    line, place, rank = tour(word, kinds)
    ranks = rank.tolist()
    nexts = np.concatenate([following(ranks), following([-r for r in ranks])])
    heads = np.tile(np.arange(size), 2)
    real = nexts < size
    heads, nexts = heads[real], nexts[real]
    right = common(line, place, heads, nexts)
    # the reversal keeps the end mark at its end: place i stands at size - 2 - i
    line, place, _ = tour([*word[-2::-1], 0], kinds)
    left = np.zeros(len(heads), np.int64)
    inner = heads > 0
    left[inner] = common(line, place, size - 1 - heads[inner], size - 1 - nexts[inner])
    periods = nexts - heads
    starts, lengths = heads - left, left + periods + right
    kept = lengths >= np.maximum(least, 2 * periods)
    found = set(zip(starts[kept].tolist(), lengths[kept].tolist(), periods[kept].tolist()))
    return sorted(((origin[s], n, p) for s, n, p in found), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words that no run repeats: of each run the first period stays."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, keep in zip(words, kept.tolist()) if keep]


def detect(df: DataFrame, text: str = "text", least: int = LEAST, into: str = "periods") -> DataFrame:
    """``df`` with a struct ``into``: all runs of the whole text (array of start, length, period, counted in words) and the text
    without what they repeat, its words joined by one blank."""
    runs_kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    @F.arrow_udf("struct<runs:array<struct<start:long,length:long,period:long>>,collapsed:string>")
    def detected(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for part in arrays(batch):
                lists, left = [], []
                for text in part.to_pylist():
                    words = (text or "").encode().split()  # bytes: only the six ASCII blanks part words
                    known: dict[bytes, int] = {}
                    found = runs([known.setdefault(w, len(known)) for w in words], least) if len(words) >= least else []
                    lists.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    left.append(b" ".join(collapsed(words, found) if found else words).decode())
                out.append(pa.StructArray.from_arrays([pa.array(lists, runs_kind), pa.array(left, pa.string())], ["runs", "collapsed"]))
            kind = pa.struct([("runs", runs_kind), ("collapsed", pa.string())])
            yield pa.chunked_array(out, kind).combine_chunks()

    return df.withColumn(into, detected(F.col(text)))


def tampered(docs: DataFrame) -> DataFrame:
    """One document of ten repeats some of its words up to its end, told by its id; one without an id stays as it is."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.withColumns({"g": F.floor(crc / 10), "words": F.when(crc % 10 == 0, words)})  # null for the other nine
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = F.col("a")
    edited = F.transform("words", lambda w, i: F.when(i < source, w).otherwise(F.get("words", (source + (i - source) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tampered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = detect(docs).select("doc_id", "periods.*")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.s")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"), F.floor(1000 * F.col("longest.length") / -F.col("longest.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Words that equal the word q further on, in maximal stretches: pairs of equal strings of six words give the distances q.
ORACLE = """
WITH crc AS (SELECT range AS i, list_reduce(list_prepend(range::BIGINT, [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c FROM range(256)),
crcs AS (SELECT list(c ORDER BY i) AS table_ FROM crc),
docs AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT)),
    lambda x, b: xor(x // 256, table_[xor(x % 256, b) + 1])), 4294967295::BIGINT) AS h FROM documents, crcs),
shaped AS (SELECT k, doc_id, ws, h, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, h // 10 AS g FROM docs),
d AS (SELECT k, doc_id, CASE WHEN h % 10 = 0 AND n > 0
  THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE ws END AS ws FROM shaped),
w AS (SELECT k, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
grams AS (SELECT k, i, hash(w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o, lead(w, 5) OVER o) AS gram, lead(i, 5) OVER o IS NOT NULL AS full_
  FROM w WINDOW o AS (PARTITION BY k ORDER BY i)),
hits AS (SELECT a.k, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.k = b.k AND a.gram = b.gram AND a.i < b.i WHERE a.full_ AND b.full_),
islands AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM hits),
stretches AS (SELECT k, q, min(i) AS s, max(i) + 6 + q - min(i) AS len FROM islands GROUP BY k, q, island),
runs AS (SELECT k, s, len, min(q) AS q FROM stretches WHERE len >= greatest(12, 2 * q) GROUP BY k, s, len),
told AS (SELECT k, count(*) AS n_runs, arg_max({'s': s, 'len': len, 'q': q}, [len, -s, -q]) AS best,
  sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q)) AS digest FROM runs GROUP BY k),
gone AS (SELECT DISTINCT k, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT k, string_agg(w, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s AS start, best.len AS length, best.q AS period,
  1000 * best.len // best.q AS exponent_milli, coalesce(digest, sha256('')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (k) LEFT JOIN kept USING (k)
"""
