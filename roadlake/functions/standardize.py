"""Category standardisation as SQL expressions, usable on columns and as SQL functions.

Each ``*_sql`` function takes the text of an expression and returns the text of another one, so the
same rule serves DataFrame code (``F.expr``) and SQL functions (``roadlake.functions.sql``).
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.session import local_table

_BLANKS = r"' \t\n\r\u000b\u000c'"


def quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip_sql(x: str) -> str:
    """Cut all leading and trailing white space, not only blanks."""
    return f"btrim({x}, {_BLANKS})"


def title_sql(x: str) -> str:
    """Capitalise every run of letters (``o'neil st.a`` becomes ``O'Neil St.A``)."""
    runs = rf"split({x}, '(?<!\\p{{L}})(?=\\p{{L}})')"
    return f"array_join(transform({runs}, run -> concat(upper(left(run, 1)), lower(substr(run, 2)))), '')"


def match_sql(key: str, entries: dict[str, str], fallback: str) -> str:
    """Exact entry, else the first entry contained in the key or containing it, else the fallback."""
    exact = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in entries.items())
    partial = " ".join(
        f"WHEN contains({key}, {quote(k)}) OR contains({quote(k)}, {key}) THEN {quote(v)}"
        for k, v in entries.items()
    )
    return f"coalesce(CASE {key} {exact} END, CASE {partial} END, {fallback})"


def district_sql(x: str, districts: dict[str, str] = rules.DISTRICTS) -> str:
    """Known district by its normalised spelling, else the name in title case; NULL when empty."""
    key = rf"regexp_replace(lower({strip_sql(x)}), '[_\\-\\s]+', '_')"
    table = ", ".join(f"{quote(k)}, {quote(v)}" for k, v in districts.items())
    known = f"try_element_at(map({table}), {key})"
    return f"CASE WHEN {x} <> '' THEN coalesce({known}, {title_sql(strip_sql(x))}) END"


def damage_type_sql(x: str, entries: dict[str, str] = rules.DAMAGE_TYPES) -> str:
    key = f"translate(lower({strip_sql(x)}), ' -', '__')"
    return f"CASE WHEN {x} <> '' THEN {match_sql(key, entries, quote('Unknown'))} ELSE 'Unknown' END"


def _named_level_sql(x: str, entries: dict[str, str]) -> str:
    key = f"lower({strip_sql(x)})"
    return f"CASE WHEN {x} <> '' THEN {match_sql(key, entries, title_sql(strip_sql(x)))} ELSE 'Unknown' END"


def weather_condition_sql(x: str, entries: dict[str, str] = rules.WEATHER_CONDITIONS) -> str:
    return _named_level_sql(x, entries)


def congestion_level_sql(x: str, entries: dict[str, str] = rules.CONGESTION_LEVELS) -> str:
    return _named_level_sql(x, entries)


def severity_text_sql(x: str, entries: dict[str, str] = rules.SEVERITY_LEVELS) -> str:
    """Level from text. An empty text is part of every entry, so it takes the first one."""
    key = f"lower({strip_sql(x)})"
    return f"CASE WHEN {x} IS NULL THEN 'Unknown' ELSE {match_sql(key, entries, quote('Unknown'))} END"


def severity_score_sql(x: str, bounds=rules.SEVERITY_BOUNDS) -> str:
    """Level from a score of 0 to 100."""
    steps = " ".join(f"WHEN {x} <= {high} THEN {quote(level)}" for high, level in bounds if high is not None)
    return f"CASE WHEN {x} IS NULL THEN 'Unknown' {steps} ELSE {quote(bounds[-1][1])} END"


def _column(builder):
    def as_column(x: str, *args) -> Column:
        return F.expr(builder(x, *args))

    as_column.__doc__ = builder.__doc__
    return as_column


title = _column(title_sql)
district = _column(district_sql)
damage_type = _column(damage_type_sql)
weather_condition = _column(weather_condition_sql)
congestion_level = _column(congestion_level_sql)
severity_text = _column(severity_text_sql)
severity_score = _column(severity_score_sql)


def clean_name(x: str) -> Column:
    """Trim and capitalise each word."""
    return F.initcap(F.trim(x))


def rules_table(spark: SparkSession) -> DataFrame:
    """All dictionaries as rows of (domain, key, value)."""
    domains = {
        "districts": rules.DISTRICTS,
        "damage_types": rules.DAMAGE_TYPES,
        "weather_conditions": rules.WEATHER_CONDITIONS,
        "severity_levels": rules.SEVERITY_LEVELS,
        "congestion_levels": rules.CONGESTION_LEVELS,
    }
    rows = [(domain, k, v) for domain, entries in domains.items() for k, v in entries.items()]
    domain, key, value = map(list, zip(*rows))
    return local_table(spark, domain=domain, key=key, value=value)
