"""Road, damage, severity, complaint and sentiment signals in Indonesian news text.

Each function takes the text of SQL expressions and returns the text of another one, which stays
inside the JVM. ``text`` is the original text, ``low`` its lower-case form.
"""

import re

from roadlake import rules
from roadlake.functions.standardize import quote


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once per row."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _literal(word: str) -> str:
    """A word as a regular expression that matches just it."""
    return re.sub(r"([^\w\s])", r"\\\1", word)


def _list(words) -> str:
    return f"array({', '.join(quote(w) for w in words)})"


def _hits(low: str, keywords) -> str:
    """How many of the keywords occur."""
    return "(" + " + ".join(f"int(contains({low}, {quote(k)}))" for k in keywords) + ")"


def road_names(text: str, pattern: str = rules.ROAD_PATTERN, stop_words=rules.ROAD_STOP_WORDS) -> str:
    """Distinct road names of 4 to 39 characters in order of appearance.

    A name is one to four capitalised words after "Jalan" or "Jl.", up to a stop word, a comma, a
    full stop or the end of the text. A name that is part of a longer one found in the same text
    is left out.
    """
    pattern = "(?U)" + pattern.replace("{stop_words}", "|".join(stop_words))
    found = f"regexp_extract_all({text}, {quote(pattern)}, 1)"
    trimmed = f"transform({found}, road -> regexp_replace(road, '[.,]+$', ''))"
    fitting = f"filter({trimmed}, road -> length(road) BETWEEN 4 AND 39)"
    first_spellings = let(
        "keys",
        "transform(spelled, road -> lower(road))",
        "filter(spelled, (road, i) -> array_position(keys, lower(road)) = i + 1)",
    )
    part_of_other = "exists(distinct_roads, r -> lower(r) <> lower(road) AND contains(lower(r), lower(road)))"
    most_specific = f"filter(distinct_roads, road -> NOT {part_of_other})"
    return let("distinct_roads", let("spelled", fitting, first_spellings), most_specific)


def around(text: str, name: str, width: int = rules.LOCAL_WINDOW) -> str:
    """The text from ``width`` characters before the first ``name`` to ``width`` after it."""
    cut = f"substr({text}, greatest(at - {width}, 1), at + length({name}) + {width} - greatest(at - {width}, 1))"
    return let("at", f"position({name}, {text})", f"if(at = 0, {text}, {cut})")


def district(low: str, names=rules.NEWS_DISTRICTS) -> str:
    """The longest district name that stands in the text as whole words, else NULL."""
    # the plain search rules out most names before a pattern is tried
    steps = " ".join(
        f"WHEN contains({low}, {quote(n.lower())}) AND rlike({low}, {quote(rf'(?U)\b{_literal(n.lower())}\b')}) THEN {quote(n)}"
        for n in sorted(names, key=len, reverse=True)
    )
    return f"CASE {steps} END"


def damage(low: str, banks=rules.DAMAGE_KEYWORDS, sure=rules.DAMAGE_CONFIDENCE) -> str:
    """struct(damage_type, confidence): the type with most keywords, the first one on ties."""
    hits = f"array({', '.join(_hits(low, words) for words in banks.values())})"
    best = (
        "named_struct("
        f"'damage_type', if(array_max(hits) > 0, get({_list(banks)}, int(array_position(hits, array_max(hits)) - 1)), NULL), "
        f"'confidence', if(array_max(hits) > 0, least(1e0, {sure[0]}e0 + {sure[1]}e0 * array_max(hits)), 0e0))"
    )
    return let("hits", hits, best)


def _severity(level: str, score: str, confidence: str) -> str:
    return (
        f"named_struct('severity_level', CAST({level} AS STRING), 'severity_score', CAST({score} AS INT), "
        f"'confidence', CAST({confidence} AS DOUBLE))"
    )


def severity(low: str, banks=rules.SEVERITY_KEYWORDS, weak=rules.WEAK_SEVERITY, sure=rules.SEVERITY_CONFIDENCE) -> str:
    """struct(severity_level, severity_score, confidence): the worst level with a keyword."""
    weak_level, weak_score, weak_confidence, weak_words = weak
    hits = f"array({', '.join(_hits(low, words) for _, words in banks.values())})"
    steps = " ".join(
        f"WHEN get(hits, {i}) > 0 THEN {_severity(quote(level), score, f'least(1e0, {sure[0]}e0 + {sure[1]}e0 * get(hits, {i}))')}"
        for i, (level, (score, _)) in enumerate(banks.items())
    )
    weak_case = f"WHEN {_hits(low, weak_words)} > 0 THEN {_severity(quote(weak_level), weak_score, weak_confidence)}"
    return let("hits", hits, f"CASE {steps} {weak_case} ELSE {_severity('NULL', 'NULL', '0')} END")


def complaints(low: str, nouns=rules.COMPLAINT_NOUNS, approx=rules.COMPLAINT_APPROX, sure=rules.COMPLAINT_CONFIDENCE) -> str:
    """struct(complaint_count, confidence, unreadable): a stated number, else an estimate from a quantity word.

    A stated number that no BIGINT holds gives no count, and ``unreadable`` says so.
    """
    pattern = rf"(?U)([0-9]+)\s*(?:{'|'.join(nouns)})"
    stated = f"regexp_extract({low}, {quote(pattern)}, 1)"
    estimate = "CASE " + " ".join(f"WHEN contains({low}, {quote(w)}) THEN {n}" for w, n in approx.items()) + " END"
    signal = (
        "named_struct('complaint_count', if(s.stated <> '', try_cast(s.stated AS BIGINT), s.estimate), 'confidence', "
        f"CASE WHEN try_cast(s.stated AS BIGINT) IS NOT NULL THEN {sure['stated']}e0 WHEN s.stated <> '' THEN 0e0 "
        f"WHEN s.estimate IS NOT NULL THEN {sure['estimate']}e0 ELSE 0e0 END, 'unreadable', s.stated <> '' AND try_cast(s.stated AS BIGINT) IS NULL)"
    )
    return let("s", f"named_struct('stated', coalesce({stated}, ''), 'estimate', {estimate})", signal)


def _occurrences(low: str, keyword: str, negations, width: int) -> str:
    """struct(plain, negated) counts; negated means a negation word lies in the ``width`` characters before."""
    word = _literal(keyword)
    before = "|".join(rf"{_literal(n)}.{{0,{width - len(n)}}}" for n in negations if len(n) <= width)
    # one left-to-right scan for the word; the group is empty where the look-behind does not hold
    found = f"regexp_extract_all({low}, {quote(rf'(?s){word}(?:(?<=({before}){word})|)')}, 1)"
    marks = f"if(contains({low}, {quote(keyword)}), {found}, CAST(array() AS ARRAY<STRING>))"
    negated = "size(filter(marks, m -> m <> ''))"
    return let("marks", marks, f"named_struct('plain', size(marks) - {negated}, 'negated', {negated})")


def sentiment(low: str, positive=rules.POSITIVE_KEYWORDS, negative=rules.NEGATIVE_KEYWORDS,
              negations=rules.NEGATION_WORDS, width: int = rules.NEGATION_WINDOW, neutral: float = rules.NEUTRAL) -> str:
    """struct(sentiment, sentiment_score) from keyword counts.

    A negated positive keyword counts as negative, a negated negative one as half a positive.
    """

    def total(keywords) -> str:
        counts = ", ".join(_occurrences(low, k, negations, width) for k in keywords)
        added = "named_struct('plain', n.plain + c.plain, 'negated', n.negated + c.negated)"
        return f"aggregate(array({counts}), named_struct('plain', 0, 'negated', 0), (n, c) -> {added})"

    scores = (
        "named_struct('good', t.positive.plain + 0.5e0 * t.negative.negated, "
        "'bad', t.negative.plain + 1e0 * t.positive.negated)"
    )
    net = "if(s.good + s.bad > 0, (s.good - s.bad) / (s.good + s.bad), 0e0)"
    label = (
        f"named_struct('sentiment', CASE WHEN net > {neutral}e0 THEN 'positive' WHEN net < -{neutral}e0 THEN 'negative' "
        "ELSE 'neutral' END, 'sentiment_score', round(net, 2))"
    )
    counted = f"named_struct('positive', {total(positive)}, 'negative', {total(negative)})"
    return let("s", let("t", counted, scores), let("net", net, label))
