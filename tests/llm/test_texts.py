"""SentencePiece, language ID, personal data, toxicity and benchmark items, against the library or plain methods."""

import hashlib
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from roadlake.llm import decontam, langid, pieces, pii, toxicity
from roadlake.llm.queries import QUERIES
from tests.conftest import values

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
ODD = [None, "", " ", "a", " a", "  a b\n c ", "▁x ▁", "a▁▁b", "x\x00y", "　a\xa0b", "ﬁ Ǻ", "🙂\r\n", "<s> </s>", "a" * 500, " " * 70, "ß" * 3]


def texts(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# --- SentencePiece


@needs_tables
def test_ids_and_decoded_texts_are_the_librarys(spark, frame):
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    odd = frame("doc_id long, text string", *((1000 + i, t) for i, t in enumerate(ODD)))
    df = texts(spark).select("doc_id", "text").unionByName(odd)
    own = {r.doc_id: r for r in pieces.decode(pieces.encode(df)).collect()}
    assert len(own) == df.count()
    for name, text in df.collect():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(own[name].ids, np.uint32).tolist() == ids
        assert own[name].decoded == library.decode(ids)


def test_decoding_any_ids(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    decode, rng = pieces.decoder(pieces.model_bytes()), random.Random(1)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randrange(32000), rng.randrange(3, 259), 28705]) for _ in range(rng.randrange(6))]
        assert decode(np.array(ids, np.uint32).tobytes()) == library.decode(ids)


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ROWS", 3)
    encode = pieces.encoder(pieces.model_bytes(), False, False)
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    for text in ("a b c d e f  ", "f e d c", "a  b"):
        assert np.frombuffer(encode(text), np.uint32).tolist() == library.encode(text)


# --- language ID


def test_languages(spark, frame):
    rows = [("the quick brown fox", "en"), ("le renard brun saute", "fr"), (None, "xx"), ("der schnelle Fuchs", None), ("123", "num")] * 2
    learned = langid.learn(frame("text string, lang string", *rows))
    asked = frame("text string, lang_pred int", ("the fox", 1), ("le renard", 2), (None, 3), ("", 4), ("12 !?", 5), ("ЖЖЖ", 6))
    found = values(langid.predict(asked, learned), "text", "lang_pred", "score")
    assert [x[1] for x in found] == ["en", "fr", "und", "und", "und", "en"] and all(0 <= x[2] <= 1 for x in found)
    assert values(langid.predict(asked, langid.learn(frame("text string, lang string"))), "lang_pred") == [("und",)] * 6
    assert values(langid.predict(frame("text string"), learned)) == []


def test_a_texts_vector_is_the_sum_of_its_bound_trigrams():
    letters = langid.Letters(64)
    owner, index, grams = letters.trigrams(["ab a", "ba"])
    vectors = letters.bound(grams)
    got = np.stack([vectors[index[owner == i]].sum(0) for i in (0, 1)])
    one = {c: letters.draw(ord(c)) for c in " ab"}

    def bundle(text):
        return sum(np.roll(one[a], 2) * np.roll(one[b], 1) * one[c] for a, b, c in zip(text, text[1:], text[2:]))

    assert (got[0] == bundle(" ab a ")).all() and (got[1] == bundle(" ba ")).all()


def test_sums_in_blocks(monkeypatch):
    letters, rng = langid.Letters(32), np.random.RandomState(3)
    owner, index, grams = letters.trigrams(["".join(map(chr, rng.randint(97, 123, n))) for n in (40, 0, 300, 7)])
    whole = letters.bundled(owner, index, grams, 4)
    vectors = letters.bound(grams)
    assert all((whole[i] == vectors[index[owner == i]].sum(0)).all() for i in range(4)) and not whole[1].any()
    monkeypatch.setattr(langid, "BLOCK", 5)
    assert (letters.bundled(owner, index, grams, 4) == whole).all()


def test_memory_of_many_letters(monkeypatch):
    """A thousand texts with 131 letters each that no other has. Drawing their vectors takes long and is left out."""
    monkeypatch.setattr(langid.Letters, "draw", lambda self, point: np.full(self.dim, 1 - point % 2 * 2, np.int8))
    points = [c for c in map(chr, range(0x110000)) if c.isalpha()][:131000]
    run = ["".join(points[i::1000]) for i in range(1000)]
    tracemalloc.start()
    letters = langid.Letters(langid.DIM)
    owner, index, grams = letters.trigrams(run)
    found = letters.bundled(owner, index, grams, len(run))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.shape == (1000, langid.DIM) and len(letters.vectors) == 131001 and peak < 400 << 20


def test_predictions_against_plain_sums(spark, frame):
    """The whole result, letter by letter: prototypes, cosines and ties."""
    rng = random.Random(8)
    known = {"aa": "abcde", "bb": "cdefg", "cc": "efgЖЯ"}
    learned = [("".join(rng.choices(known[name] + " 1", k=rng.randrange(1, 60))), name) for name in sorted(known) for _ in range(12)]
    asked = [(n, "".join(rng.choices(rng.choice(list(known.values())) + "  -", k=rng.randrange(0, 40)))) for n in range(60)] + [(99, None)]
    letters = langid.Letters(langid.DIM)

    def vector(text):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        joined = f" {' '.join(words)} " if words else ""
        one = {c: letters.draw(ord(c)).astype(int) for c in joined}
        grams = [np.roll(one[a], 2) * np.roll(one[b], 1) * one[c] for a, b, c in zip(joined, joined[1:], joined[2:])]
        return sum(grams, np.zeros(langid.DIM, int))

    prototypes = {name: sum(vector(t) for t, n in learned if n == name) for name in sorted(known)}
    found = langid.predict(frame("doc_id long, text string", *asked), langid.learn(frame("text string, lang string", *learned)))
    rows = {i: (lang, score) for i, lang, score in values(found, "doc_id", "lang_pred", "score")}
    for n, text in asked:
        own = vector(text)
        if not own.any():
            assert not any(map(str.isalpha, text or "")) and rows[n] == ("und", 0)
            continue
        cosines = {k: own @ v / np.linalg.norm(own) / np.linalg.norm(v) for k, v in prototypes.items()}
        name = max(cosines, key=cosines.get)
        assert rows[n][0] == name and abs(rows[n][1] - max(0, cosines[name])) < 1e-9


def test_a_table_with_a_column_of_the_same_name(frame):
    learned = langid.learn(frame("text string, lang string", ("the fox", "en")))
    found = langid.predict(frame("text string, _best long, _BEST_ long", ("the fox", 7, 8)), learned)
    assert found.columns == ["text", "_best", "_BEST_", "lang_pred", "score"] and found.first()[1:4] == (7, 8, "en")


@needs_tables
def test_held_out_languages(spark):
    truth = dict(values(texts(spark), "doc_id", "lang"))
    rows = QUERIES["op9_language_id"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(rows) == len(truth)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)


# --- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]) + sum(map(int, digits[-1::-2]))
            fits = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "phone": lambda: 8 <= len(digits) <= 15,
                "card": lambda: 16 <= len(digits) <= 19 and doubled % 10 == 0,
            }
            if fits[kind]():
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_plain_patterns():
    rng, anchors = random.Random(2), pii.automaton()
    for _ in range(20_000):
        text = "".join(rng.choice("a@.+-0123456789 ( )1.1.1.é") for _ in range(rng.randrange(60)))
        assert [s for s in pii.spans_of(text, anchors) if s[0] in pii.BASE] == plain(text), text
    cards = "4111 1111 1111 1111, 4111-1111-1111-1112; +1 (555) 123-4567 é 10.0.0.256 10.0.0.255"
    assert [s[0] for s in pii.spans_of(cards, anchors)] == ["ip", "card", "phone"]


def test_added_kinds_and_masks(frame):
    rows = [
        (1, 'key token = "ab12cd34ef" end'), (2, "IBAN: DE89370400440532013000."), (3, "see https://me:pw123@host.org/x"), (4, None), (5, ""),
        (6, "mail é a.b@c.de now"), (7, "account holders"),
    ]
    df = pii.find(frame("doc_id long, text string, spans int", *((*r, 0) for r in rows)))
    kinds = {r.doc_id: [s["kind"] for s in r.spans] for r in df.collect()}
    assert kinds == {1: ["secret"], 2: ["account"], 3: ["email", "url"], 4: [], 5: [], 6: ["email"], 7: []}
    masked = dict(values(pii.redact(df), "doc_id", "text"))
    assert masked[1] == 'key token = "<SECRET>" end' and masked[2] == "IBAN: <ACCOUNT>." and masked[6] == "mail é <EMAIL> now"
    assert masked[3] == "see <URL>/x" and masked[4] is None and masked[5] == ""


@needs_tables
def test_the_query_of_personal_data(spark):
    truth = dict(values(texts(spark), "doc_id", "text"))
    for row in QUERIES["op10_pii"](spark, FOLDER).collect():
        spans = plain(truth[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


# --- toxicity


def test_nearest_examples_are_exact():
    rng = random.Random(3)
    terms = {f"t{i}": 1 + i for i in range(40)}
    vectors = {(n, rng.randrange(2)): toxicity.Counter(rng.choices(sorted(terms), k=rng.randrange(1, 6))) for n in range(500)}
    model = toxicity.build(terms, vectors, (260, 260), {0: 900, 1: 260})
    matrix = np.zeros((len(model.votes), len(terms)))
    for column, term in enumerate(sorted(terms)):
        _, most, examples, weights = model.index.get(term, (None, None, np.zeros(0, int), np.zeros(0)))
        matrix[examples, column] = weights
    for _ in range(200):
        vector = model.vector(toxicity.Counter(rng.choices(sorted(terms), k=rng.randrange(1, 5))))
        cosines = matrix @ np.array([vector.get(t, 0.0) for t in sorted(terms)])
        best = [i for i in np.lexsort((np.arange(len(cosines)), -np.round(cosines, 9))) if cosines[i] > 0][: toxicity.NEIGHBOURS]
        places, found = model.nearest(vector)
        assert np.allclose(found, cosines[best]) and len(places) == len(best)


def test_toxic_words_are_learned(frame):
    rng = random.Random(4)
    plainly = ["house", "tree", "river", "cloud", "stone", "bird", "road"]
    rows, labels = [], []
    for n in range(300):
        words = rng.choices(plainly, k=12)
        if n % 5 == 0:
            words[rng.randrange(12)] = rng.choice(("slime", "crud"))
        rows.append((n, " ".join(words)))
        labels.append((n, int(n % 5 == 0)))
    labels += [(0, 1), (None, 1), (1, None), (2, 7), (5000, 1)]
    rows += [(1000, "you slime"), (1001, "a tree by the river"), (1002, None), (1003, ""), (1000, "you slime")]
    docs = frame("doc_id long, text string, score string", *((*r, "x") for r in rows))
    model = toxicity.fit(docs, frame("doc_id long, toxic int", *labels))
    found = values(toxicity.score(docs, model).filter("doc_id >= 1000"), "doc_id", "score")
    assert all(s > 0.9 for n, s in found if n == 1000) and all(s < 0.1 for n, s in found if n > 1000) and len(found) == 5
    assert toxicity.evidence(model, "you slime")[0][1] == 1 and toxicity.evidence(model, "tree") == []


def test_a_language_with_few_examples_keeps_its_terms(frame):
    rng = random.Random(7)
    rows, labels = [], []

    def add(words, own, toxic):
        words = rng.choices(words, k=10)
        rows.append((len(rows), " ".join(words + own)))
        labels.append((len(labels), toxic))

    english, spanish = ["house", "tree", "river", "cloud", "stone", "bird"], ["casa", "sol", "mar", "luna", "pan", "flor"]
    for n in range(160):
        add(english, [], 0)
    for n in range(32):
        add(english, ["slime"], 1)
    for n in range(40):
        add(spanish, ["bocado"] if n < 8 else [], 0)
    for n in range(8):  # no word is frequent, only their beginning; clean texts have it too
        add(spanish, ["boc" + "aeiouxyz"[n] + "ra"], 1)
    model = toxicity.fit(frame("doc_id long, text string", *rows), frame("doc_id long, toxic int", *labels))
    assert toxicity.evidence(model, "una bocina") and model.score(toxicity.terms_of("una bocina", model.known())) >= toxicity.THRESHOLD
    assert model.score(toxicity.terms_of("la casa luna", model.known())) < toxicity.THRESHOLD


def test_without_examples_nothing_is_toxic(frame):
    model = toxicity.fit(frame("doc_id long, text string"), frame("doc_id long, toxic int"))
    assert values(toxicity.score(frame("text string", "a", None), model), "score") == [(0.0,), (0.0,)]


@needs_tables
def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(values(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "toxic"))
    rows = [r for r in QUERIES["op4_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(truth[r.doc_id] == r.predicted for r in rows) >= 0.93 * len(rows)


# --- benchmark items


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min((v, j) for j, v in enumerate(row))


def test_bit_parallel_distance():
    rng = random.Random(5)
    for _ in range(1000):
        item = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 60)))
        assert decontam.best_end(item, text) == distance(item, text)


def test_every_item_within_the_budget_is_found(frame):
    rng = random.Random(6)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "nunc", "vel", "odio"]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(2, 20)))) for i in range(8)] + [(100, None), (101, "  "), (102, "Sit  Amet")]
    rows = []
    for n in range(60):
        chars = list(rng.choice(items[:8])[1])
        for _ in range(rng.randrange(8)):
            k = rng.randrange(len(chars))
            chars[k : k + 1] = rng.choice(("", "X", chars[k] + "q"))
        rows.append((n, " ".join(rng.choices(words, k=5)) + "\n" + "".join(chars) + " " + " ".join(rng.choices(words, k=5))))
    rows += [(100, None), (101, "")]
    rows = [(n, t, n) for n, t in rows]
    df = decontam.find(frame("doc_id long, text string, item_id long", *rows), frame("item_id long, text string", *items), rate=0.1)
    for row in df.collect():
        text = decontam.normal(row.text)
        near = {i: distance(decontam.normal(t), text)[0] for i, t in items if decontam.normal(t)}
        expected = {i: d for i, d in near.items() if d <= int(0.1 * len(decontam.normal(dict(items)[i])))}
        assert {x["item_id"]: x["distance"] for x in row.leaks} == expected
        for x in row.leaks:
            if x["distance"] == 0:
                assert decontam.normal(dict(items)[x["item_id"]]) in decontam.normal(row.text[x["start"] : x["end"]])


def test_no_items_and_no_texts(frame):
    none, item = frame("item_id long, text string"), frame("item_id long, text string", (1, "some item"))
    assert values(decontam.find(frame("doc_id long, text string", (1, "a")), none), "leaks") == [([],)]
    assert values(decontam.find(frame("doc_id long, text string"), item)) == []


def test_items_in_lots(frame, monkeypatch):
    monkeypatch.setattr(decontam, "LOT_BYTES", 10)
    items = frame("item_id long, text string", (1, "first item"), (2, "second item"), (3, "third item"))
    df = decontam.find(frame("doc_id long, text string", (1, "the first item and the third item")), items)
    assert [x["item_id"] for x in df.first().leaks] == [1, 3]


def test_the_plan_of_many_lots_is_that_of_one(frame, monkeypatch):
    rows = [(n, f"text {n} holds item number {n % 7} here", n) for n in range(20)]
    docs, items = frame("doc_id long, text string, _leaks long", *rows), [(n, f"item number {n}") for n in range(7)]
    whole = decontam.find(docs, frame("item_id long, text string", *items))
    monkeypatch.setattr(decontam, "LOT_BYTES", 1)
    parts = decontam.find(docs, frame("item_id long, text string", *items))
    assert parts.columns == whole.columns == ["doc_id", "text", "_leaks", "leaks"]
    assert sorted(values(parts)) == sorted(values(whole))
    assert parts._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


# --- pipeline


@needs_tables
def test_pipeline_against_its_rules(spark, tmp_path):
    docs = texts(spark)
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, states[-1], FOLDER).write.parquet(str(tmp_path / name))
        states.append(spark.read.parquet(str(tmp_path / name)))
    rows = [{r.doc_id: r for r in s.collect()} for s in states]
    assert all(s.columns == docs.columns for s in states[:-1])
    scores = dict(values(QUERIES["op4_toxicity"](spark, FOLDER), "doc_id", "predicted"))
    assert set(rows[1]) == {i for i, p in scores.items() if not p}
    from tests.llm.test_neardup import brute

    groups = brute([(i, r.text) for i, r in rows[1].items()])
    assert {str(i) for i in rows[2]} == {a for a, b, _ in groups if a == b}
    items = [decontam.normal(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {i for i, r in rows[2].items() if any(x in decontam.normal(r.text) for x in items)}
    assert dirty and set(rows[3]) <= set(rows[2]) - dirty and len(rows[2]) - len(rows[3]) <= len(dirty) + 2
    assert set(rows[4]) == set(rows[3])
    assert all(r.n_chars == len(r.text) and not plain(r.text) for r in rows[4].values())
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    for i, row in rows[5].items():
        assert np.frombuffer(row.ids, np.uint32).tolist() == library.encode(rows[4][i].text, add_bos=True, add_eos=True)
        assert row.n_tokens == len(row.ids) // 4


def test_pipeline_stages_on_odd_tables(spark, frame, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    frame("doc_id long, quality int, toxic int", (1, None, None)).write.parquet(f"{folder}/labels.parquet")
    frame("item_id long, text string", (None, None)).write.parquet(f"{folder}/benchmark.parquet")
    for rows in ([], [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x@y.zz", None, None, None)]):
        frame(kind, *rows).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert sorted(values(found, "doc_id", "text"), key=str) == ([(1, ""), (2, "<EMAIL>"), (None, None)] if rows else [])


def test_numbers_of_tokens(frame):
    row = pieces.stage(None, frame("doc_id long, text string", (1, "a b")), "").select(F.col("n_tokens")).first()
    assert row[0] == 4


@needs_tables
@pytest.mark.parametrize("number", range(4))
def test_stages_keep_columns_with_names_of_their_own(frame, number):
    """Columns that a stage would like to add for itself stay as they are."""
    names = ("_id", "_hash", "_own", "_spans", "_SPANS_", "_toxicity", "_leaks", "n_chars")
    rows = [(n, f"some words of text number {n} that nobody else has", *([7] * len(names))) for n in range(3)] + [(None, None, *([7] * len(names)))]
    docs = frame("doc_id long, text string, " + ", ".join(f"{c} long" for c in names), *rows)
    kept = corpus_pipeline.STAGES[number][1](docs.sparkSession, docs, FOLDER)
    assert kept.columns == docs.columns
    assert len(values(kept)) == 4 and all(r[2:-1] == (7,) * (len(names) - 1) for r in values(kept))
