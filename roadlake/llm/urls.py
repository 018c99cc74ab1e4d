"""URL filters, native (operator 2).

Two kinds of rules:
  address rules (host, path) fit a host and its subdomains whose path starts with the rule's path;
  pattern rules are regular expressions with the literal tokens that every match contains.
Each pattern rule is filed under its rarest literal token (counted over the tokens of all URLs; only
rule tokens are counted). A URL's distinct tokens fetch the rules filed under them, and only these run
their regular expressions. An address rule decides first (the longest wins, ties to the smaller
rule string); otherwise a fitting pattern rule blocks; otherwise the URL is allowed.

Patterns are matched against the lower-cased URL. A null URL and one without ``://`` have an empty
host and path; the patterns still apply to the latter. Every row gets a verdict, repeated rows and null ids too.
The rules are arguments of the caller and do not grow with the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import table

#: The address rules of the query (host, path, verdict).
ADDRESS_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Pattern rules (regular expression, literal tokens of every match).
PATTERN_RULES = (
    (r"://([a-z0-9-]+\.)*ads-track[a-z0-9-]*\.", ("ads",)),
    (r"://([a-z0-9-]+\.)*adult-[a-z0-9-]+\.", ("adult",)),
    (r"://([a-z0-9-]+\.)*casino-[a-z0-9-]+\.", ("casino",)),
    (r"://([a-z0-9-]+\.)*cheap-pills\.", ("cheap", "pills")),
    (r"://([a-z0-9-]+\.)*free-bets\.", ("free", "bets")),
    (r"://([a-z0-9-]+\.)*spam-[a-z0-9-]+\.", ("spam",)),
    (r"[?&]utm_source=spam(&|#|$)", ("utm_source", "spam")),
    (r"/(login|signin)/?([?#]|$)", ("login",)),
    (r"/(login|signin)/?([?#]|$)", ("signin",)),
)
TOKEN = r"[a-z0-9_]+"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    name = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def lowered(url: Column) -> Column:
    return F.translate(F.coalesce(url, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lowered(url), F.lit(TOKEN), F.lit(0)))


def rarest(df: DataFrame, url: str, patterns=PATTERN_RULES) -> dict[str, list[str]]:
    """Token -> regular expressions filed under it. The driver gets a row per token of the rules at most."""
    words = sorted({t for _, own in patterns for t in own})
    if not words:
        return {}
    hits = F.array_intersect(tokens(F.col(url)), F.array(*map(F.lit, words)))
    counts = dict(df.select(F.explode(hits).alias("token")).groupBy("token").count().collect())
    index: dict[str, list[str]] = {}
    for pattern, own in patterns:
        index.setdefault(min(own, key=lambda t: (counts.get(t, 0), t)), []).append(pattern)
    return index


def judge(
    df: DataFrame, url: str = "url", addresses=ADDRESS_RULES, patterns=PATTERN_RULES
) -> DataFrame:
    """``df`` with host, path, rule, verdict and pattern (the first fitting regular expression, if one was asked).

    Columns of these names are replaced.
    """
    index = rarest(df, url, patterns)
    df = df.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})

    def fits(rule) -> Column:
        name, start, _ = rule
        own = (F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))
        return own & F.startswith(F.col("path"), F.lit(start))

    by_length = sorted(addresses, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    rule = reduce(lambda c, r: c.when(fits(r), F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("verdict"))), by_length, F)
    decided = F.col("_rule") if by_length else F.lit(None).cast("struct<rule:string,verdict:string>")
    df = df.withColumn("_rule", rule if by_length else decided)
    if index:
        filed = F.create_map(*(F.lit(x) for token in sorted(index) for x in (token, index[token])))
        fetched = F.flatten(
            F.transform(F.array_intersect(tokens(F.col(url)), F.array(*map(F.lit, sorted(index)))), lambda t: F.element_at(filed, t))
        )
        fitting = F.array_min(F.filter(fetched, lambda p: F.regexp_like(lowered(F.col(url)), p)))
    else:
        fitting = F.lit(None).cast("string")
    return df.withColumns(
        {
            "rule": F.col("_rule.rule"),
            "pattern": F.when(F.col("_rule.rule").isNull(), fitting),
        }
    ).withColumn(
        "verdict", F.coalesce(F.col("_rule.verdict"), F.when(F.col("pattern").isNotNull(), "block"), F.lit("allow"))
    ).drop("_rule")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    """Every rule against every row; patterns without the index."""
    cases, verdicts = [], []
    for name, start, verdict in sorted(ADDRESS_RULES, key=lambda r: -len(r[0] + r[1])):
        test = f"(host = {_literal(name)} OR ends_with(host, {_literal('.' + name)})) AND starts_with(path, {_literal(start)})"
        cases.append(f"WHEN {test} THEN {_literal(name + start)}")
        verdicts.append(f"WHEN {_literal(name + start)} THEN {_literal(verdict)}")
    hits = ", ".join(f"CASE WHEN regexp_matches(low, {_literal(p)}) THEN {_literal(p)} END" for p in sorted({p for p, _ in PATTERN_RULES}))
    return f"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS tail FROM pages),
cut AS (
  SELECT page_id,
         coalesce(regexp_extract(tail, '^[^/?#]*', 0), '') AS raw,
         coalesce(regexp_extract(tail, '^[^/?#]*([^?#]*)', 1), '') AS path,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM rest),
named AS (
  SELECT page_id, path, low, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM cut),
ruled AS (
  SELECT *, CASE {" ".join(cases)} END AS rule, coalesce({hits}) AS hit FROM named)
SELECT page_id, host, path, rule,
       CASE rule {" ".join(verdicts)} ELSE CASE WHEN hit IS NULL THEN 'allow' ELSE 'block' END END AS verdict,
       CASE WHEN rule IS NULL THEN hit END AS pattern
FROM ruled"""


ORACLE = _oracle()
