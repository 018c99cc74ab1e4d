"""The n-gram Jaccard join against all pairs."""

import random
from collections import Counter
from itertools import combinations

import pytest

from roadlake.llm import neardup
from roadlake.llm.components import components
from tests.conftest import values

WORDS = [a + b for a in ("ka", "mo", "ti", "su", "re") for b in ("la", "n", "sk", "do", "vi", "p")]


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return sorted((str(rows[i][0]), str(least.get(find(i))), links[i]) for i in range(len(rows)))


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for n in range(60):
        words = [rng.choice(WORDS) for _ in range(rng.choice((3, 5, 30, 120)))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.choice((0, 0, 1, 4))):
            other = list(words)
            for _ in range(rng.randrange(0, 4)):
                other[rng.randrange(len(other))] = rng.choice(WORDS)
            rows.append((len(rows), rng.choice((" ", "\n", "  ")).join(other)))
    hot = [rng.choice(WORDS) for _ in range(200)]
    for _ in range(40):
        other = list(hot)
        for _ in range(rng.randrange(0, 6)):
            other[rng.randrange(200)] = rng.choice(WORDS)
        rows.append((len(rows), " ".join(other)))
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, None), (2, 3)])
def test_all_links_and_classes(frame, monkeypatch, seed, chunk):
    if chunk:  # nodes and clusters in many parts
        monkeypatch.setattr(neardup, "NODE_ROWS", chunk)
        monkeypatch.setattr(neardup, "CLUSTER_ROWS", chunk)
    rows = corpus(seed)
    found = neardup.join(frame("doc_id long, text string", *rows))
    assert sorted((str(a), str(b), n) for a, b, n in values(found, "doc_id", "class_id", "n_links")) == brute(rows)


def test_odd_rows(frame):
    text = " ".join(WORDS)
    rows = [(7, text), (7, text), (None, text), (9, None), (10, ""), (11, " \n\t"), (None, None), (12, "one two"), (13, "one  two"), (14, "two one")]
    found = neardup.join(frame("doc_id long, text string", *rows))
    assert sorted((str(a), str(b), n) for a, b, n in values(found, "doc_id", "class_id", "n_links")) == brute(rows)


def test_empty_table_and_stage(spark, frame):
    empty = frame("doc_id long, text string")
    assert values(neardup.join(empty)) == []
    text = " ".join(WORDS)
    rows = [(3, text, "a"), (2, text, "b"), (2, text, "b"), (None, text, "c"), (5, None, "d"), (6, "x", "e"), (None, "other words here now", "f")]
    kept = neardup.stage(spark, frame("doc_id long, text string, key string", *rows), "")
    assert sorted(values(kept, "key")) == [("b",), ("d",), ("e",), ("f",)]


def test_prefixes_are_shortened_until_the_recall_is_met():
    assert neardup.depth(0.8, 0.9999) == 3 and neardup.depth(0.8, 0.99) > 3 and neardup.depth(0.5, 0.999999) == 1


def test_close_classes_leave_the_tries(frame):
    """What long prefixes match is represented, directly or by steps, within FAR hashes; the rest keeps its labels."""
    rng = random.Random(5)
    base = [rng.choice(WORDS) + str(n) for n in range(3000)]
    rows = [(0, " ".join(base))]
    for n in range(1, 40):  # one word of 3,000 differs: most hashes stay
        rows.append((n, " ".join([*base[: 70 * n], "other", *base[70 * n + 1 :]])))
    rows += [(100 + n, " ".join(rng.choice(WORDS) for _ in range(80))) for n in range(20)]
    df = frame("doc_id long, id long, text string, hash long", *((n, n, t, n) for n, t in rows))
    sketches = neardup.sketch(df, 5)
    classes = sketches.select("key", "signature")
    signatures = dict(values(classes))
    tries, moved = neardup.forest(sketches, classes, 3)
    left, moved = {k for k, _ in values(tries)}, values(moved)
    assert moved and len({a for a, _ in moved}) == len(moved)  # each is represented once
    assert not left & {a for a, _ in moved}
    to = dict(moved)
    for a in to:
        end = a
        while end in to:
            end = to[end]
        assert sum(x != y for x, y in zip(signatures[a], signatures[end])) <= neardup.FAR and end in left
    assert len(left) + len(moved) == 40  # the twenty others share no prefix


def test_bounds_of_canopies_hold():
    assert 1 - neardup.LINKED >= (1 - 0.62) + (1 - neardup.DONE) + 2 * neardup.FAR / (neardup.TREES * neardup.DEPTH)


def test_components_of_a_long_path(frame):
    edges = [(i, i + 1) for i in range(60) if i != 30] + [(5, 5), (1, 0)]
    assert sorted(values(components(frame("a long, b long", *edges)))) == [(i, 0 if i <= 30 else 31) for i in range(61)]
    assert values(components(frame("a long, b long"))) == []
