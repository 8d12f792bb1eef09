"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Every step is a Spark column expression: ``regexp_extract_all`` gives the
matches of a kind, ``split`` by the same pattern the text between them, and a
fold over both gives code-point offsets.  Validators (digit counts, octet
range, Luhn, mod-97) drop proposals without retrying inside them.  Words such
as "account" or "ssn" shortly before a span raise its score; kinds of
``BASE_KINDS`` are reported once validated, the further kinds only from
``MIN_SCORE`` on.

Patterns use possessive quantifiers and a look-behind at the start of a run, so
matching is linear in the text and cannot overflow the stack on long runs; the
matches are the same as those of the plain patterns.

Defined cases: null or empty text has no spans; repeated rows are handled row
by row; other columns are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.llm.text import computed_once, free_name, lower_ascii

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"
MIN_SCORE = 0.6
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.4


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def luhn(digits: Column) -> Column:
    """True where the digit string passes the Luhn check."""
    d = F.split(F.reverse(digits), "")

    def weight(x: Column, i: Column) -> Column:
        v = x.cast("int")
        twice = v * 2
        return F.when(i % 2 == 0, v).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(d, weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True where an account number passes the mod-97 check."""
    flat = F.upper(F.regexp_replace(account, " ", ""))
    turned = F.split(F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4)), "")

    def step(rem: Column, ch: Column) -> Column:
        value = F.when(ch.rlike("[0-9]"), ch.cast("int")).otherwise(F.ascii(ch) - 55)
        return (rem * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(turned, F.lit(0), step) == 1


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str                                  # proposes spans
    present: Callable[[Column], Column]           # cheap necessary test of the whole text
    valid: Callable[[Column], Column]             # confirms one proposal
    score: float
    context: tuple[str, ...]


LOCAL = "A-Za-z0-9._%+-"
# The base kinds in their listed order.
BASE_KINDS = (
    Kind("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True), 0.9, ("mail", "contact")),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), _octets, 0.7, ("address", "server", "host")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda t: t.rlike(r"(?:[0-9][\x20-]?){13}[0-9]"), _card, 0.7, ("card", "visa", "credit")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda t: F.contains(t, F.lit("+")), lambda m: F.length(_digits(m)).between(10, 15),
         0.6, ("phone", "call", "tel")),
)
FURTHER_KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), mod97, 0.8, ("iban", "account", "bank")),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), lambda m: ~m.rlike("^(?:000|666|9)"),
         0.3, ("ssn", "social security")),
)
KINDS = BASE_KINDS + FURTHER_KINDS


def _kind_spans(text: Column, kind: Kind, rank: int) -> Column:
    """The validated spans of one kind, in order, with their context score."""
    parts = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["pos"] + F.length(part["gap"])
        hit = part["hit"]
        end = start + F.length(F.coalesce(hit, F.lit("")))
        from_ = F.greatest(start - CONTEXT_CHARS, F.lit(0))
        before = lower_ascii(F.substring(text, from_ + 1, start - from_))
        near = F.lit(False)
        for word in kind.context:
            near = near | F.contains(before, F.lit(word))
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0))
        span = F.array(F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"),
                                end.cast("int").alias("end"), F.lit(kind.name).alias("kind"),
                                score.alias("score")))
        found = F.when(hit.isNotNull() & kind.valid(hit), F.concat(acc["spans"], span)) \
            .otherwise(acc["spans"])
        return F.struct(end.cast("int").alias("pos"), found.alias("spans"))

    empty = F.array().cast(SPAN)
    folded = F.aggregate(parts, F.struct(F.lit(0).alias("pos"), empty.alias("spans")), step)
    return F.when(kind.present(text), folded["spans"]).otherwise(empty)


def find_spans(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` plus column ``out``: confirmed spans sorted by start, then kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    names = []
    df = docs
    for rank, kind in enumerate(KINDS):
        name = free_name(df.columns, f"p_{kind.name}")
        names.append(name)
        df = df.withColumn(name, _kind_spans(body, kind, rank))
    base = F.lit(len(BASE_KINDS))
    merged = F.sort_array(F.filter(F.concat(*[F.col(n) for n in names]),
                                   lambda s: (s["rank"] < base) | (s["score"] >= MIN_SCORE)))
    return df.withColumn(out, computed_once(merged)).drop(*names)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[KIND]``; where spans overlap,
    the later one covers only what the earlier one has not."""
    def step(acc: Column, s: Column) -> Column:
        at = F.greatest(s["start"], acc["pos"])
        parts = F.concat(acc["parts"], F.array(
            F.substring(text, acc["pos"] + 1, at - acc["pos"]),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        inside = s["end"] <= acc["pos"]
        return F.struct(F.when(inside, acc["pos"]).otherwise(s["end"]).alias("pos"),
                        F.when(inside, acc["parts"]).otherwise(parts).alias("parts"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``length`` names a
    column to hold the new number of characters.  Null text stays null."""
    at = free_name(docs.columns, "pii_spans")
    df = find_spans(docs, text, at)
    df = df.withColumn(text, F.when(F.col(text).isNotNull(), redacted(F.col(text), F.col(at))))
    if length and length in docs.columns:
        kind = docs.schema[length].dataType
        df = df.withColumn(length, F.when(F.size(at) > 0, F.length(text).cast(kind))
                           .otherwise(F.col(length)))
    return df.drop(at)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds and the spans."""
    df = find_spans(docs.select("doc_id", "text"), out="spans_")
    spans = F.col("spans_")

    def of_kind(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    count = [of_kind(k.name) for k in BASE_KINDS]
    base = F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))
    return df.select("doc_id", *count, F.sha2(span_text(base), 256).alias("base_sha256"),
                     span_text(spans).alias("spans"))
