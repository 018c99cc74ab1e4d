"""Personal data by anchor expansion (operator 10).

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, digits, ``://`` and
identifier cues. Local parsers expand each anchor to the full span and validate it. Each character is
visited a bounded number of times per kind.

Base kinds, leftmost and non-overlapping within a kind; a match that fails its check is dropped and
not tried again:
  email  local part, ``@`` and a domain with a dot
  ip     four dotted numbers of at most 255
  card   16 to 19 digits with single blanks or hyphens between, passing the Luhn sum
  phone  ``+`` and 8 to 15 digits with blanks, brackets, dots and hyphens between
Added kinds:
  url      scheme with ``://`` that holds user data (``user:secret@host``) or a query value after a cue
  account  an IBAN with a right check number, or the value after an account cue
  secret   the value after a credential cue

A null or empty text has no spans. Positions are code points, ends are exclusive. Repeated rows and
further columns are kept; a column named like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm.common import arrays, table, unused

KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = KINDS[:4]
#: Words that announce an identifier.
CUES = {
    "account": ("iban", "account", "passport", "ssn"),
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key"),
}
SPANS = "array<struct<kind:string,start:int,end:int>>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USER = re.compile(r"://[^\s/?#@:]+:[^\s/?#@]+@[^\s/?#]+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: What may stand between a cue and its value.
LINK = re.compile(r"[A-Za-z_]{0,12}['\"]?\s{0,3}(?:[:=#]|\bis\b|\bno\.?|\bnumber\b)\s{0,3}['\"]?")
VALUE = re.compile(r"[A-Za-z0-9+/_-]{6,}")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def iban(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def automaton():
    anchors = ahocorasick.Automaton()
    for word, kind in (("@", "email"), ("+", "phone"), ("://", "url"), *((d, "digit") for d in "0123456789")):
        anchors.add_word(word, kind)
    for kind, words in CUES.items():
        for word in words:
            for form in (word, word.upper(), word.capitalize()):
                anchors.add_word(form, kind)
    anchors.make_automaton()
    return anchors


def spans_of(text: str, anchors) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind in the order of KINDS, then by start."""
    found: dict[str, list[tuple[int, int]]] = {}
    after = dict.fromkeys(KINDS, 0)

    def keep(kind: str, start: int, end: int, valid: bool = True) -> None:
        after[kind] = end
        if valid:
            found.setdefault(kind, []).append((start, end))

    digit = -2  # the last digit seen
    for at, kind in anchors.iter(text):
        if kind == "digit":
            if digit != at - 1 and at >= after["ip"] and (m := IP.match(text, at)):
                keep("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")))
            digit = at
            if at >= after["card"] and (m := CARD.match(text, at)):
                digits = only_digits(m[0])
                keep("card", at, m.end(), 16 <= len(digits) <= 19 and luhn(digits))
        elif kind == "email":
            start = at
            while start > after["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                keep("email", start, m.end())
        elif kind == "phone":
            if at >= after["phone"] and (m := PHONE.match(text, at)):
                keep("phone", at, m.end(), 8 <= len(only_digits(m[0])) <= 15)
        elif kind == "url":
            if at - 2 >= after["url"] and (m := USER.match(text, at - 2)):
                start = at - 2
                while start > after["url"] and (text[start - 1] in LOCAL):
                    start -= 1
                keep("url", start, m.end())
        elif at >= after[kind] and (m := LINK.match(text, at + 1)):
            if kind == "account" and (n := IBAN.match(text, m.end())) and iban(n[0]):
                keep("account", n.start(), n.end())
            elif (n := VALUE.match(text, m.end())) and sum("0" <= c <= "9" for c in n[0]) >= 4:
                keep(kind, n.start(), n.end())
    return [(kind, *span) for kind in KINDS for span in found.get(kind, ())]


def find(df: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``df`` with an array of (kind, start, end) per text."""
    row = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(SPANS)
    def spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        anchors = automaton()
        names = [f.name for f in row.value_type]
        for batch in texts:
            yield pa.chunked_array(
                [
                    pa.array([[dict(zip(names, s)) for s in spans_of(t or "", anchors)] for t in part.to_pylist()], row)
                    for part in arrays(batch)
                ],
                row,
            ).combine_chunks()

    return df.withColumn(into, spans(F.col(text)))


def redact(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with each span of the texts replaced by its kind in angle brackets.

    Overlapping spans become one mark, named after the first of them; ties go to the longer span.
    """
    # (text so far, end of what is done) over the spans in order of their starts
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("done"))

    def step(state: Column, span: Column) -> Column:
        end = -span["back"]
        gap = F.substring(F.col(text), state["done"] + 1, span["start"] - state["done"])
        mark = F.concat(state["out"], gap, F.lit("<"), F.upper(span["kind"]), F.lit(">"))
        return F.struct(
            F.when(span["start"] >= state["done"], mark).otherwise(state["out"]).alias("out"),
            F.greatest(state["done"], end).alias("done"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col(text), state["done"] + 1, F.length(F.col(text))))

    return df.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, finish)).otherwise(F.col(text)))


def _digest(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the given kinds, comma-joined; the spans come in this order already."""
    chosen = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(_of("spans", kind) for kind in BASE),
        F.sha2(_digest(BASE), 256).alias("base_sha256"),
        _digest(KINDS).alias("spans"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data in the texts is replaced by marks; n_chars follows the new text."""
    spans = unused(docs, "_spans")
    clean = redact(find(docs, into=spans), spans=spans).drop(spans)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)
