"""News articles to road mentions and road summaries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.functions import text as T
from roadlake.operators.clean import first_per_key


def article_id(url: str = "url") -> Column:
    return F.left(F.sha2(F.col(url), 256), F.lit(16))


def published_at(raw: str) -> Column:
    """Timestamp of an RFC 2822 date with a zone name or an offset; NULL for any other text."""
    day = F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3},\s*", "")
    formats = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm z", "d MMM yyyy HH:mm Z")
    return F.coalesce(*[F.try_to_timestamp(day, F.lit(f)) for f in formats])


def top_entries(feed: DataFrame, query: str, position: str, n: int = rules.ARTICLES_PER_QUERY) -> DataFrame:
    """The first ``n`` entries of each search query, in feed order; other columns decide between equal positions."""
    return first_per_key(feed, [query], [F.asc(position), *_others(feed, query, position)], n)


def _others(df: DataFrame, *named: str) -> list[Column]:
    """The other columns that can be sorted, to settle ties the same way on any cluster."""
    return [F.asc(c) for c, t in df.dtypes if c not in named and "map<" not in t]


def unseen(articles: DataFrame, ledger: DataFrame, order: str, url: str = "url") -> DataFrame:
    """First copy of each article that the ledger does not hold.

    Copies are cut per map task before the shuffle; the anti join uses the same key and so the
    same shuffle.
    """
    named = articles.withColumn("article_id", article_id(url))
    first = first_per_key(named, ["article_id"], [F.asc(order), *_others(named, "article_id", order)])
    return first.join(ledger.select("article_id"), "article_id", "left_anti")


def mark_seen(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows to append to the ledger: articles of the batch it does not hold yet, each once."""
    rows = batch.select(*ledger.columns)
    new = first_per_key(rows, ["article_id"], _others(rows, "article_id") or [F.asc("article_id")])
    return new.join(ledger.select("article_id"), "article_id", "left_anti")


def _mention(road: str, district: str, confidence: str) -> str:
    return (
        f"named_struct('road_name', {road}, 'district', {district}, 'damage_type', s.damage.damage_type, "
        "'severity_level', s.severity.severity_level, 'severity_score', s.severity.severity_score, "
        f"'confidence', round({confidence}, 2))"
    )


def _signals(low: str) -> str:
    return f"named_struct('damage', {T.damage(low)}, 'severity', {T.severity(low)}, 'district', {T.district(low)})"


def _road_mention(text: str, road: str, district: str) -> str:
    """Signals from the text around a road name; its confidence is the mean of those found."""
    damage, severity = "s.damage.confidence", "s.severity.confidence"
    mean = f"({damage} + {severity}) / (int({damage} > 0) + int({severity} > 0))"
    confidence = f"if({damage} + {severity} > 0, {mean}, {rules.ROAD_CONFIDENCE}e0)"
    row = _mention(road, f"coalesce(s.district, {district})", confidence)
    return T.let("near", f"lower({T.around(text, road)})", T.let("s", _signals("near"), row))


def _nameless_mentions(low: str, district: str) -> str:
    """One UNKNOWN road for an article that tells of damage but names no road, else no mention."""
    damage, severity = "s.damage.confidence", "s.severity.confidence"
    both = f"least({damage}, {severity})"
    row = _mention("'UNKNOWN'", district, f"if({both} > 0, {both}, greatest({damage}, {severity}))")
    signals = f"named_struct('damage', {T.damage(low)}, 'severity', {T.severity(low)})"
    return T.let("s", signals, f"filter(array({row}), r -> {damage} + {severity} > 0)")


def extract(articles: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Add the signals of an article: ``roads`` (array of mentions), complaints, sentiment, confidence."""
    blanks = F.lit(" \t\n\r\x0b\x0c")
    both = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))
    texts = articles.withColumn("_text", F.btrim(both, blanks)).withColumn("_low", F.lower("_text"))
    found = texts.withColumns(
        {
            "_names": F.expr(T.road_names("_text")),
            "_district": F.expr(T.district("_low")),
            "_complaints": F.expr(T.complaints("_low")),
            "_sentiment": F.expr(T.sentiment("_low")),
        }
    )
    named = f"transform(_names, road -> {_road_mention('_text', 'road', '_district')})"
    roads = found.withColumn(
        "roads", F.expr(f"if(size(_names) > 0, {named}, {_nameless_mentions('_low', '_district')})")
    )
    # the confidence of the mentions, and of the complaint count where there is one
    sure = "concat(roads.confidence, filter(array(_complaints.confidence), c -> c > 0))"
    mean = "if(size(sure) > 0, round(aggregate(sure, 0e0, (total, c) -> total + c) / size(sure), 2), 0e0)"
    return roads.withColumns(
        {
            "complaint_count": F.col("_complaints.complaint_count"),
            "sentiment": F.col("_sentiment.sentiment"),
            "sentiment_score": F.col("_sentiment.sentiment_score"),
            "extraction_confidence": F.expr(T.let("sure", sure, mean)),
        }
    ).drop("_text", "_low", "_names", "_district", "_complaints", "_sentiment")


def primary_road(roads: str = "roads") -> Column:
    """The most sure mention, the first one on ties."""
    best = F.array_max(F.transform(roads, lambda r: r["confidence"]))
    return F.get(F.filter(roads, lambda r: r["confidence"] == best), F.lit(0))


def messages(extracted: DataFrame, min_confidence: float = 0.0, city: str = rules.REGION["city"]) -> DataFrame:
    """One message per road mention; an article without any gives one message without a road.

    Expects url, title, source, published_at and scraped_at, and optionally article_url, next to
    the columns of ``extract``.
    """
    url = F.coalesce("article_url", "url") if "article_url" in extracted.columns else F.col("url")
    kept = F.filter("roads", lambda r: r["confidence"] >= min_confidence)
    rows = extracted.select(
        article_id().alias("event_id"),
        F.coalesce("published_at", "scraped_at").alias("event_time"),
        F.lit(city).alias("city"),
        "title", "sentiment_score", "source", url.alias("url"), "published_at", "scraped_at",
        "complaint_count", "sentiment", "extraction_confidence",
        F.size("roads").alias("_mentions"),
        F.explode_outer(kept).alias("road"),
    )
    # an article whose mentions all fall below the bound sends nothing
    rows = rows.filter(F.col("road").isNotNull() | (F.col("_mentions") == 0))
    return rows.select(
        "event_id", F.col("event_id").alias("article_id"), "event_time", "city",
        "road.district",
        "title", "sentiment_score", "source", "url", "published_at", "scraped_at",
        "complaint_count", "sentiment", "extraction_confidence",
        F.nullif(F.col("road.road_name"), F.lit("UNKNOWN")).alias("road_name"),
        "road.damage_type", "road.severity_level", "road.severity_score",
        F.col("road.damage_type").alias("keyword"),
        F.coalesce("road.confidence", F.lit(0.0)).alias("road_confidence"),
    )


def road_summary(news: DataFrame, published: str = "event_time", levels=rules.NEWS_LEVELS) -> DataFrame:
    """News per road and district: tone, complaints, severity and the commonest damage type."""
    level = F.lit(0)
    for rank, name in enumerate(levels, start=1):
        level = F.when(F.col("severity_level") == name, rank).otherwise(level)
    return (
        news.filter(F.col("road_name").isNotNull())
        .groupBy("road_name", "district")
        .agg(
            F.count("*").alias("news_count"),
            F.count_if(F.coalesce(F.col("sentiment") == "negative", F.lit(False))).alias("negative_count"),
            F.count_if(F.coalesce(F.col("sentiment") == "positive", F.lit(False))).alias("positive_count"),
            F.coalesce(F.sum("complaint_count"), F.lit(0)).alias("total_complaints"),
            F.max(published).alias("latest_news"),
            F.avg(level).alias("avg_severity_score"),
            F.expr("mode() WITHIN GROUP (ORDER BY damage_type)").alias("dominant_damage_type"),
        )
    )
