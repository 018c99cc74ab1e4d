import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake.functions import text as T
from roadlake.operators import news
from tests.conftest import plan, values


@pytest.fixture
def extract(frame):
    def run(title, content):
        rows = news.extract(frame("title string, content string", (title, content))).collect()
        return rows[0]

    return run


def roads(row):
    return [tuple(r) for r in row.roads]


def test_road_with_all_signals(extract):
    row = extract("Jalan rusak di Gubeng", "Jalan Raya Darmo berlubang besar dan sangat parah. 12 warga melapor.")
    assert roads(row) == [("Raya Darmo", "Gubeng", "pothole", "critical", 90, 0.78)]
    assert (row.complaint_count, row.sentiment, row.sentiment_score, row.extraction_confidence) == (12, "negative", -1.0, 0.84)


def test_negation(extract):
    row = extract("Warga Rungkut", "Jl. Kendangsari Lama, tidak rusak dan sudah bagus")
    assert roads(row) == [("Kendangsari Lama", "Rungkut", "general", "medium", 45, 0.45)]
    assert (row.complaint_count, row.sentiment, row.sentiment_score) == (None, "positive", 1.0)
    # "tidak" makes the positive word negative, and half a positive of the negative one
    assert extract("", "tidak mulus").sentiment_score == -1.0
    assert extract("", "rusak rusak tidak rusak").sentiment_score == pytest.approx((0.5 - 2) / 2.5)
    # the negation must lie within 15 characters
    assert extract("", "tidak" + "x" * 10 + "mulus").sentiment == "negative"
    assert extract("", "tidak" + "x" * 11 + "mulus").sentiment == "positive"


def test_keywords_inside_words_count(extract):
    # "diperbaiki" is positive, and so is the "baik" inside it
    row = extract("", "diperbaiki tetapi parah")
    assert row.sentiment_score == pytest.approx(0.33)


def test_longer_name_replaces_its_part(extract):
    row = extract("", "Jalan Kertajaya, lalu Jalan Kertajaya Indah rusak ringan. Jalan KERTAJAYA INDAH, lagi")
    assert [r[0] for r in roads(row)] == ["Kertajaya Indah"]
    assert roads(row)[0][2:5] == ("general", "low", 20)


def test_road_name_limits(extract):
    assert roads(extract("", "Jalan Abc, bagus")) == []
    assert [r[0] for r in roads(extract("", "Jalan Abcd, bagus"))] == ["Abcd"]
    assert [r[0] for r in roads(extract("", "Jalan Satu Dua Tiga Empat rusak, Jalan Pemuda"))] == ["Satu Dua Tiga Empat", "Pemuda"]
    assert roads(extract("", "Jalan " + "A" + "b" * 39 + ", bagus")) == []
    assert [r[0] for r in roads(extract("Jl. Basuki Rahmat", "Jalan Pemuda, macet"))] == ["Pemuda"]


def test_signals_are_local(extract):
    row = extract("", "Jalan Pemuda, " + "x " * 50 + "berlubang di Wonokromo")
    assert roads(row) == [("Pemuda", "Wonokromo", None, None, None, 0.2)]


def test_no_road(extract):
    row = extract("", "kerusakan akibat longsor, ratusan keluhan")
    assert roads(row) == [("UNKNOWN", None, "erosion", "medium", 45, 0.3)]
    assert (row.complaint_count, row.extraction_confidence) == (150, 0.35)
    # only one of the two signals
    assert roads(extract("", "tergerus")) == [("UNKNOWN", None, "erosion", None, None, 0.6)]
    assert roads(extract("", "fatal")) == [("UNKNOWN", None, None, "critical", 90, 0.75)]


def test_nothing(extract):
    row = extract("Cuaca cerah", None)
    assert (row.roads, row.complaint_count, row.sentiment, row.sentiment_score, row.extraction_confidence) == ([], None, "neutral", 0.0, 0.0)


def test_district(frame):
    df = frame("x string", "kec. wonokromo", "kecamatan dukuh pakis dan gubeng", "waru", "warugunung", "gubengan", "pabean  cantian")
    assert [v for (v,) in values(df.select(F.expr(T.district("x"))))] == [
        "Wonokromo", "Dukuh Pakis", "Waru", "Warugunung", None, None,
    ]


def test_complaints(frame):
    df = frame("x string", "15 orang dan 20 warga", "7laporan", "puluhan warga", "banyak dan ratusan", "12 rumah", "99999999999 warga, beberapa", "9" * 30 + " warga, beberapa")
    assert values(df.select(F.expr(T.complaints("x")).alias("c")).select("c.complaint_count", "c.confidence")) == [
        (15, 0.9), (7, 0.9), (30, 0.4), (150, 0.4), (None, 0.0), (99999999999, 0.9), (None, 0.0),
    ]
    assert values(df.select(F.expr(T.complaints("x")).alias("c")).filter("c.unreadable"), "c.complaint_count") == [(None,)]


def test_primary_road_is_first_on_ties(extract, frame):
    df = news.extract(frame("title string, content string", ("", "Jalan Pemuda, rusak. Jalan Veteran, rusak")))
    assert values(df.select(news.primary_road().alias("r")).select("r.road_name")) == [("Pemuda",)]


def test_messages(frame):
    when = datetime(2024, 1, 5)
    schema = "url string, article_url string, title string, content string, source string, published_at timestamp, scraped_at timestamp"
    df = frame(
        schema,
        ("u1", "real", "a", "Jalan Pemuda, rusak. Jalan Veteran, bagus", "s", when, datetime(2024, 1, 6)),
        ("u2", None, "b", "longsor", "s", None, when),
        ("u3", None, "c", "cerah", "s", None, when),
    )
    rows = news.messages(news.extract(df)).orderBy("title", "road_name")
    assert values(rows, "event_id", "url", "road_name", "keyword", "road_confidence", "event_time") == [
        (hashlib.sha256(b"u1").hexdigest()[:16], "real", "Pemuda", "general", 0.45, when),
        (hashlib.sha256(b"u1").hexdigest()[:16], "real", "Veteran", "general", 0.45, when),
        (hashlib.sha256(b"u2").hexdigest()[:16], "u2", None, "erosion", 0.6, when),
        (hashlib.sha256(b"u3").hexdigest()[:16], "u3", None, None, 0.0, when),
    ]
    sure = news.messages(news.extract(df), min_confidence=0.5)
    assert sorted(values(sure, "title")) == [("b",), ("c",)]


def test_unseen_and_ledger(frame):
    articles = frame("no int, url string, content string", (3, "a", "late"), (1, "a", "first"), (2, "b", "x"), (4, "c", "y"))
    seen = frame("url string", "b").select(news.article_id().alias("article_id"), "url")
    fresh = news.unseen(articles, seen, "no")
    assert sorted(values(fresh, "no", "content")) == [(1, "first"), (4, "y")]
    text = plan(fresh)
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning(article_id")
    appended = news.mark_seen(seen, articles.withColumn("article_id", news.article_id()))
    assert sorted(values(appended, "url")) == [("a",), ("c",)]


def test_top_entries(frame):
    rows = [("q1", i) for i in range(40)] + [("q2", i) for i in range(3)]
    top = news.top_entries(frame("q string, place int", *rows), "q", "place")
    assert sorted(values(top)) == [("q1", i) for i in range(15)] + [("q2", i) for i in range(3)]


def test_published_at(frame):
    df = frame("x string", "Tue, 05 Mar 2024 07:08:09 GMT", "5 Mar 2024 07:08:09 +0700", "Tue, 05 Mar 2024 07:08 GMT", "yesterday", None)
    assert [v for (v,) in values(df.select(news.published_at("x")))] == [
        datetime(2024, 3, 5, 7, 8, 9), datetime(2024, 3, 5, 0, 8, 9), datetime(2024, 3, 5, 7, 8), None, None,
    ]


def test_road_summary(frame):
    schema = "road_name string, district string, sentiment string, complaint_count int, event_time timestamp, severity_level string, damage_type string"
    when = datetime(2024, 1, 5)
    df = frame(
        schema, ("A", "x", "negative", 5, when, "critical", "pothole"), ("A", "x", "positive", None, None, "low", "crack"),
        ("A", "x", None, 2, None, None, None), (None, "x", "negative", 9, when, "high", "crack"),
    )
    assert values(news.road_summary(df)) == [("A", "x", 3, 1, 1, 7, when, pytest.approx(5 / 3), "crack")]
