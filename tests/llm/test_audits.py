"""Divergence of sources, periodic runs and fingerprints, against plain counting, every period and own sums."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadlake.llm import divergence, fingerprints, periods
from tests.conftest import values

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(folder, df):
    """A folder whose documents are ``df``, for a query."""
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# --- divergence of sources


def plain_audit(rows, support, top=divergence.TOP):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for lang, source, text in rows]
    seen, counts = Counter(), defaultdict(Counter)
    for lang, source, words in docs:
        seen.update((lang, w) for w in set(words))
        counts[lang, source].update(words)
    out = set()
    for lang in {d[0] for d in docs}:
        kept = sorted(w for (x, w), n in seen.items() if x == lang and n >= support)
        sources = sorted({d[1] for d in docs if d[0] == lang}, key=lambda s: s.encode())

        def shares(count):
            total = sum(count[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 1_000_000_000 * (count[w] + 2) // total for w in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][w] - p[t][w]) ** 2 // (p[s][w] + p[t][w]) for w in kept), t) for t in sources if t != s]
            terms = [((p[s][w] - q[w]) ** 2 // (p[s][w] + q[w]), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), start=1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def corpus():
    random.seed(11)
    words = ["a", "ab", "abc", "Abc", "b", "ba", "É", "é", "straße", "x1y", "日本", "日", "zz", "\U0001f642", "common", "B-C"]
    rows = [
        (random.choice(["en", "de", None]), random.choice(["s1", "s2", "s3", "é", "ｚ", "\U0001f642", None]), " ".join(random.choices(words, k=random.randint(0, 9))))
        for _ in range(150)
    ]
    rows += [("en", "s1", None), ("en", "bare", "12 34"), ("fr", "lonely", "un"), ("xx", "p", ""), ("xx", "q", "one"), ("en\x00", "s", "a b")]
    return rows + rows[:20] + [("en", "s1", "common " * 30_000)]


@pytest.mark.parametrize("support", [1, 3, 10])
def test_audit_equals_plain_counting(frame, monkeypatch, support):
    monkeypatch.setattr(divergence, "HELD", 50)  # tasks pass on what they hold many times
    monkeypatch.setattr(divergence, "LOT", 40)
    monkeypatch.setattr(divergence, "WIDTH", 3)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    rows = corpus()
    df = frame("lang string, source string, text string, n int, row int", *((*r, 1, 2) for r in rows)).repartition(7)
    got = values(divergence.audit(df, support=support), "lang", "source", "part", "item", "value", "rank")
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows, support)
    if support == 3:
        assert {r[2] for r in got} == {"pair", "term"}


def test_audit_of_nothing(frame):
    assert values(divergence.audit(frame("lang string, source string, text string"))) == []


def test_transducer_gives_ordinals_and_words():
    random.seed(2)
    words = sorted({bytes(random.choices(b"abc\xff\x00", k=random.randint(1, 7))) for _ in range(500)})
    builder = divergence.Builder()
    for word in words:
        builder.add(word)
    machine = divergence.Transducer.load(builder.finish().dump())
    assert machine.ordinals(pa.array(words)).tolist() == list(range(len(words)))
    assert machine.ordinals(pa.array(words).slice(7, 20)).tolist() == list(range(7, 27))
    assert [machine.word(i) for i in range(len(words))] == words
    others = [w + b"a" for w in words if w + b"a" not in words] + [b"", b"d", b"\x01"]
    assert set(machine.ordinals(pa.array(others)).tolist()) == {-1}
    # minimal: states with equal futures are one
    def future(prefix):
        return frozenset(w[len(prefix):] for w in words if w.startswith(prefix))

    assert len(machine.final) == len({future(w[:i]) for w in words for i in range(len(w) + 1)})


def test_shares_are_exact_beyond_64_bits(frame):
    df = frame("n long, total long", (10**14, 10**14 + 7), (0, 4))
    got = values(df.select(divergence.share(F.col("n"), F.col("total")).alias("p")))
    assert got == [(1 + 10**9 * (10**14 + 2) // (10**14 + 7),), (500_000_001,)]


# --- periodic runs


def every_period(words, least=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_all_periods(least):
    random.seed(least)
    for _ in range(1500):
        kinds, n = random.choice([1, 2, 3, 5, 50]), random.randint(0, 60)
        words = [random.randrange(kinds) for _ in range(n)]
        if n > 5 and random.random() < 0.6:
            a, p = random.randrange(n), random.randint(1, n)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert periods.runs(words, least) == every_period(words, least)


def test_trees_hold_all_suffixes():
    word = [1, 2, 1, 2, 3, 1, 2, 1, 0]
    line, place, rank = periods.tour(word, 4)
    assert rank.tolist() == [sorted(word[k:] for k in range(9)).index(word[i:]) for i in range(9)]
    pairs = [(i, j) for i in range(9) for j in range(9) if i != j]
    got = periods.common(line, place, *(np.array(x) for x in zip(*pairs)))
    for (i, j), n in zip(pairs, got.tolist()):
        assert word[i : i + n] == word[j : j + n] and word[i + n] != word[j + n]


def test_periodic_runs_query(spark, frame, tmp_path):
    random.seed(3)
    rows = [(i, " ".join(random.choices("abcdefgh", k=random.randint(0, 80)))) for i in range(160)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "a\xa0b " * 9), (904, "x\x00y z　 " * 20), (None, "q w " * 10), (5, "dup " * 13), (5, "dup " * 13), (905, "long " * 60_000)]
    folder = stored(tmp_path, frame("doc_id long, text string, periods int, n int", *((*r, 1, 2) for r in rows)))
    want = []
    for name, text in rows:
        words = (text or "").encode().split()
        h = None if name is None else zlib.crc32(str(name).encode())
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        # one word many times has one run; the plain search would take long
        found = [(0, len(words), 1)] if len(words) > 5000 else every_period(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((name, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()))
    got = values(periods.op12_periodic_runs(spark, folder))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 10


def test_periods_of_nothing(frame):
    assert values(periods.detect(frame("text string")), "periods") == []


# --- fingerprints


def lanes(text):
    """A second way to the same numbers, one paragraph after the other."""
    out = [0] * fingerprints.LANES
    for line in text.split("\n"):
        digest = hashlib.sha256(line.encode()).hexdigest()
        for i in range(8):
            out[i] += int(digest[8 * i : 8 * i + 8], 16)
        for part in re.split(r"(?<=[.!?]) ", line):
            digits = "".join(hashlib.sha256((k + part).encode()).hexdigest() for k in "01")
            for i, digit in enumerate(digits):
                out[8 + i] += int(len(part) ** 0.5) * (2 * int(digit, 16) - 15)
    return "".join(f"{v % (1 << 32):08x}" for v in out)


LINES = ["One two three. Four five! Six?", "", "a", "Ünïcode 日本 \U0001f642. x", "a. b. ", "the same", "x\x00y", "long " * 50, "!! ?? ..  "]


def some_text(n):
    return "\n".join(random.choices(LINES, k=n)) if n else ""


def test_paragraphs_in_any_order_added_and_taken_away(frame):
    random.seed(4)
    df = frame("text string, fingerprint int", *((t, 0) for t in ["b\na\n\na", "a\nb\na\n", "a\nb", None, "", "x " * 200_000, "a\nb"]))
    got = [r[0] for r in values(fingerprints.fingerprint(df), "fingerprint")]
    assert got[0] == got[1] != got[2] == got[6] and got[3] == got[4] and len(got[0]) == 8 * fingerprints.LANES
    assert fingerprints.insert(got[2], ["a", ""]) == got[0] and fingerprints.delete(got[0], ["", "a"]) == got[2]
    assert fingerprints.likeness(got[0], got[0]) == 1 == fingerprints.likeness(got[3], got[4])
    assert fingerprints.likeness(got[3], got[0]) == 0
    one, two = ("\n".join(random.sample(LINES, 9) + [f"own {k} {i} line of some words" for i in range(9)]) for k in "ab")
    assert 0.4 < fingerprints.likeness(*(fingerprints.as_text(f) for f in fingerprints.sums([one.split("\n"), two.split("\n")]))) < 0.95


def test_fingerprints_query(spark, frame, tmp_path, monkeypatch):
    random.seed(5)
    monkeypatch.setattr(fingerprints, "CHARS", 300)
    monkeypatch.setattr(fingerprints, "LOT", 7)
    rows = [(i * 3, some_text(random.randint(0, 6))) for i in range(120)]
    rows += [(-4, "neg ative"), (1000, None), (1001, "y. " * 30_000), (None, "no id")]
    folder = stored(tmp_path, frame("doc_id long, text string, block int, tie int", *((*r, 1, 2) for r in rows)).repartition(5))
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (name, text), (_, other) in zip(ordered, ordered[1:] + ordered[:1]):
        text, other = text or "", other or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        prints = [lanes(t) for t in (text, edited, other)]
        near = [fingerprints.likeness(prints[0], p) for p in prints[1:]]
        want.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints[:2], *near))
    got = values(fingerprints.op13_fingerprints(spark, folder))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)


def test_successors_of_repeated_rows(frame, tmp_path, spark):
    """Rows with equal ids follow each other in a fixed order: as a whole they form one ring."""
    rows = [(1, "b"), (1, "a"), (1, "a"), (2, "c"), (None, "n"), (None, None)]
    kind = pa.schema([("id", "int64"), ("text", "string"), ("other", "string")])

    def listed(held):
        return pa.RecordBatch.from_pylist([dict(zip(kind.names, row)) for row in held], kind)

    got = values(fingerprints.with_next(frame("doc_id long, text string", *rows), listed, "id long, text string, other string"))
    assert sorted(r[1] for r in got) == sorted(r[2] for r in got) == sorted(t or "" for _, t in rows)
    assert [r[2] in "ab" for r in got if r[1] == "c"] == [True] and [r[0] for r in got if r[2] == "c"] == [None]
    one = stored(tmp_path, frame("doc_id long, text string", (7, "alone. here")))
    assert values(fingerprints.op13_fingerprints(spark, one), "doc_id", "near_next") == [(7, 1.0)]


def test_fingerprints_of_nothing(spark, frame, tmp_path):
    assert values(fingerprints.op13_fingerprints(spark, stored(tmp_path, frame("doc_id long, text string")))) == []
