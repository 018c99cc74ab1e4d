"""Word windows that started before and byte strings that start elsewhere, against every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import anchors, substrings, suffixes
from roadlake.session import materialize
from tests.conftest import values
from tests.test_scale import final_plan, small_partitions  # noqa: F401


def brute_words(rows, width):
    seen, out = set(), []
    for name, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        out.append((name, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


def brute_bytes(rows, width, keep_first=False):
    texts = [(name, (text or "").encode()) for name, text in sorted(rows, key=lambda r: (r[0] is None, r[0]))]
    counts = Counter(t[i : i + width] for _, t in texts for i in range(len(t) - width + 1))
    seen, out = set(), []
    for name, text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - width + 1):
            window = text[i : i + width]
            if (window in seen) if keep_first else counts[window] > 1:
                gone[i : i + width] = True
            seen.add(window)
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(text) else 0
        out.append((name, len(text), int(gone.sum()), runs, bytes(np.frombuffer(text, np.uint8)[~gone])))
    return out


def corpus(seed, letters, sizes):
    """Texts with copies, shared passages, edits and repeats within one text."""
    rng = random.Random(seed)
    passages = [" ".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(6)]
    rows = []
    for n in range(80):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(letters) for _ in range(rng.choice(sizes)))
            words = part.split(" ")
            a = rng.randrange(len(words))
            if rng.random() < 0.5:
                words = words[a:] + ["new"] + words[:a]
            parts.append(rng.choice((" ", "\n")).join(words))
        rows.append((n, " ".join(parts)))
    rows += [(80 + i, rows[5][1]) for i in range(10)] + [(200, None), (201, ""), (202, " \n "), (203, "é" * 50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, crowd", [(1, 10_000), (2, 10_000), (3, 2)])
def test_words_that_started_before_go(frame, monkeypatch, seed, crowd):
    monkeypatch.setattr(anchors, "CROWD", crowd)  # 2: window by window
    rows = corpus(seed, [f"w{i}" for i in range(40)], (3, 10, 25, 60))
    found = substrings.dedup(frame("doc_id long, text string", *rows))
    assert sorted(values(found)) == sorted(brute_words(rows, 20))


@pytest.mark.parametrize("seed, keep_first, crowd", [(4, False, 10_000), (5, False, 2), (6, True, 10_000), (7, True, 2)])
def test_bytes_that_start_elsewhere_go(frame, monkeypatch, seed, keep_first, crowd):
    monkeypatch.setattr(anchors, "CROWD", crowd)
    monkeypatch.setattr(suffixes, "LOT", 1 << 12)
    rows = corpus(seed, ["a", "bé", "c", "dd"], (5, 20, 50))
    found = suffixes.dedup(frame("doc_id long, text string", *rows), width=40, gram=8, keep_first=keep_first)
    assert sorted((a, b, c, d, bytes(e)) for a, b, c, d, e in values(found)) == sorted(brute_bytes(rows, 40, keep_first))


def test_periodic_texts(frame):
    rows = [(1, "ab" * 300), (2, "ba" * 20), (3, "a" * 41), (4, "a" * 40), (5, "x" + "a" * 39)]
    found = suffixes.dedup(frame("doc_id long, text string", *rows), width=40, gram=8, keep_first=False)
    assert sorted((a, b, c, d, bytes(e)) for a, b, c, d, e in values(found)) == sorted(brute_bytes(rows, 40))
    rows = [(1, "x y " * 100), (2, "x " * 21), (3, "x " * 20), (4, "y x " * 10)]
    assert sorted(values(substrings.dedup(frame("doc_id long, text string", *rows)))) == sorted(brute_words(rows, 20))


def test_repeated_rows_null_ids_and_further_columns(frame):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 5), (1, text, 6), (None, text, 7), (2, None, 8)]
    df = frame("doc_id long, text string, hash int", *rows)
    # equal rows are one document; the null id comes last
    assert sorted(values(substrings.dedup(df)), key=str) == [(1, 30, 0, text), (1, 30, 0, text), (2, 0, 0, ""), (None, 30, 30, "")]
    found = suffixes.dedup(df, width=40, gram=8, keep_first=False).select("doc_id", "n_removed", "n_spans")
    assert sorted(values(found), key=str) == [(1, len(text), 1), (1, len(text), 1), (2, 0, 0), (None, len(text), 1)]


def test_empty_tables(frame):
    empty = frame("doc_id long, text string")
    assert values(substrings.dedup(empty)) == [] and values(suffixes.dedup(empty)) == []


def test_a_long_text_over_many_batches(spark, frame):
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(60_000))
    rows = [(1, long), (2, long[1000:200_000]), (3, "z " + long[5000:9000])]
    assert sorted(values(substrings.dedup(frame("doc_id long, text string", *rows)))) == sorted(brute_words(rows, 20))


def test_records_are_one_for_every_window(frame):
    """Each window of width words lies in exactly one record."""
    rows = [(1, " ".join(f"w{i % 7}" for i in range(200))), (2, "a b c")]
    found = anchors.records(anchors.plain(frame("doc_id long, text string", *rows), "text", "doc_id"), anchors.word_tokens, 20, 5)
    spans = sorted(values(found, "start", "end"))
    assert spans[0][0] == 0 and spans[-1][1] == 180 and all(b + 1 == c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_digest_is_of_the_kept_words(frame):
    row = substrings.dedup(frame("doc_id long, text string", (1, "a  b\nc"))).select(F.sha2(F.encode("kept", "UTF-8"), 256)).first()
    assert row[0] == hashlib.sha256(b"a b c").hexdigest()


def test_spans_that_many_batches_tell_are_kept_once(frame):
    rows = anchors.plain(frame("doc_id long, text string", (1, "a b"), (2, "a b"), (3, "c")), "text", "doc_id")
    own = rows.filter("doc_id = 1").select("hash", "size", F.lit(0).alias("start"), F.lit(1).alias("end"))
    told = own.unionByName(own).unionByName(own).unionByName(own.withColumn("end", F.lit(2)))
    found = {r.doc_id: r for r in anchors.with_spans(rows, told).collect()}
    assert [sorted(map(tuple, found[i].spans)) for i in (1, 2)] == [[(0, 1), (0, 2)]] * 2
    assert found[3].spans is None and found[1].copies == 2


def test_records_of_a_hot_place_are_split_before_their_contents_are_cut(spark, monkeypatch, small_partitions):  # noqa: F811
    monkeypatch.setattr(anchors, "CROWD", 10_000)
    texts = spark.range(2000).select("id", F.concat(F.lit("text number "), "id").alias("text"))
    rows = texts.withColumns({"hash": F.xxhash64("text"), "size": F.octet_length("text")})
    place = F.when(F.col("n") % 3 == 0, 7).otherwise(F.col("n") % 50 + 100)
    own = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("n"), (F.col("id") % 2000).alias("id"))
    closer = own.join(rows, "id").select(place.alias("place"), "id", "hash", "size", F.lit(0).alias("start"), F.lit(3).alias("end"))
    found = anchors.contents(rows, materialize(closer, "closer"), suffixes.cut(1))
    assert "skew=true" in final_plan(found)
    counted = found.groupBy("crowded", F.col("place") == 7, F.col("content").cast("string")).count()
    assert sorted(values(counted)) == [(False, False, "text", 40_000), (True, True, "text", 20_000)]
