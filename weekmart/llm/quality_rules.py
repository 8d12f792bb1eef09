"""Quality rules: a threshold table compiled into one Spark projection.

``THRESHOLDS`` lists (metric, comparison, bound, least number of words for the
rule to apply).  ``quality_metrics`` computes the counts, ``judge`` compiles the
table into one boolean column; there is no user function and no shuffle.

The stop-word rule needs a list for the text's language, so it holds for
documents whose ``lang`` is one of ``LISTED_LANGS`` (``en-US`` counts as ``en``).
Without a ``lang`` (null, blank, ``und``, or no such column) it holds unless more
than half of the words have a letter that is not Latin.  All other texts are
judged by the remaining rules.

Defined cases: null text counts as empty (no words, rejected as too short);
repeated rows are judged row by row; every other column is carried along
untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.llm.text import SPACE_CHARS, computed_once, free_name, lower_ascii, space_words

# Frequent function words of the listed languages.
LISTED_LANGS = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the of and to in a is that for it with as on by this was "
    "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch "
    "de la le et les des en un une du que est pour qui dans "
    "el los las y se del por con una para al lo su no"
).split()

SYMBOLS = r"[#*$%&|<>]"
OTHER_SCRIPT = r"[\p{L}&&[^\p{IsLatin}]]"

# metric, comparison that must hold, bound, only from this many words
THRESHOLDS: tuple[tuple[str, str, float, int], ...] = (
    ("words", ">=", 50, 0),
    ("repeat_ratio", "<=", 0.5, 0),       # words in repeated 3-word windows / words
    ("mean_word_chars", ">=", 2.0, 50),
    ("mean_word_chars", "<=", 15.0, 50),
    ("symbol_ratio", "<=", 0.3, 50),      # symbols / words
    ("bang_ratio", "<=", 0.3, 50),        # exclamation marks / words
    ("dup_line_ratio", "<=", 0.5, 50),    # lines equal to an earlier one / lines
    ("stop_ratio", ">=", 0.005, 200),     # stop words / words
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_bangs", "n_lines", "n_stop_words")


def _repeat_words(positions: str) -> Column:
    """Words covered by the flagged window starts: each start covers up to
    three words, less where the next flagged start is nearer."""
    pos = F.col(positions)
    gaps = F.transform(pos, lambda p, i: F.least(F.lit(3), F.coalesce(
        F.get(pos, i + 1) - p, F.lit(3))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)


def _has_stop_words(docs: DataFrame, words: Column) -> Column:
    """True where ``STOP_WORDS`` has words of the text's language."""
    foreign = F.size(F.filter(words, lambda x: x.rlike(OTHER_SCRIPT)))
    by_script = 2 * foreign <= F.size(words)
    lang = next((f.name for f in docs.schema if f.name.lower() == "lang"
                 and f.dataType.typeName() in ("string", "varchar", "char")), None)
    if lang is None:
        return by_script
    code = F.lower(F.trim(F.regexp_replace(F.col(lang), "[-_].*$", "")))
    unknown = F.coalesce(code, F.lit("")).isin("", "und")
    return F.when(unknown, by_script).otherwise(code.isin(*LISTED_LANGS))


def quality_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts of ``COUNTS`` in a struct column ``quality``,
    with ``stop_rule`` true where the stop-word rule can be applied.

    A repeated window is found by sorting the document's (window hash, start)
    pairs and comparing neighbours, so the work is n log n in its words.  Two
    different windows of one document meet in the 64-bit hash with a chance of
    about n^2 / 2^65, below 1e-10 for a text of 20,000 words.
    """
    def name(x: str) -> str:
        return free_name(docs.columns, x)

    w, h, o, pos = name("q_words"), name("q_windows"), name("q_sorted"), name("q_starts")
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.col(w)
    n = F.size(words)
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    pairs = F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    ordered = F.when(F.size(F.array_distinct(F.col(h))) < F.size(F.col(h)), F.sort_array(pairs)) \
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def start_if_repeated(p: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col(o), i - 1)["h"])
        after = F.get(F.col(o), i + 1)["h"]
        return F.when(p["h"].eqNullSafe(before) | p["h"].eqNullSafe(after), p["i"])

    starts = F.sort_array(F.filter(F.transform(F.col(o), start_if_repeated),
                                   lambda x: x.isNotNull()))
    lines = F.filter(F.split(body, "\n"), lambda l: F.length(F.btrim(l, F.lit(SPACE_CHARS))) > 0)
    lw, ln = name("q_lower"), name("q_lines")
    df = docs.withColumn(w, space_words(F.col(text))).withColumn(h, windows) \
        .withColumn(o, ordered).withColumn(pos, starts).withColumn(ln, lines) \
        .withColumn(lw, lower_ascii(F.array_join(words, " ")))
    stops = F.size(F.filter(F.split(F.col(lw), " "), lambda x: x.isin(STOP_WORDS)))
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(F.col(ln)) - F.size(F.array_distinct(F.col(ln)))).cast("long").alias("n_dup_lines"),
        _repeat_words(pos).alias("n_repeat_words"),
        F.regexp_count(body, F.lit("!")).cast("long").alias("n_bangs"),
        F.size(F.col(ln)).cast("long").alias("n_lines"),
        stops.cast("long").alias("n_stop_words"),
        _has_stop_words(docs, words).alias("stop_rule"))
    return df.withColumn("quality", computed_once(counts)).drop(w, h, o, pos, ln, lw)


def _metric(name: str, q: Column) -> Column:
    per = lambda a, b: a / F.greatest(b, F.lit(1))
    return {
        "words": q["n_words"],
        "repeat_ratio": per(q["n_repeat_words"], q["n_words"]),
        "mean_word_chars": per(q["word_chars"], q["n_words"]),
        "symbol_ratio": per(q["n_symbols"], q["n_words"]),
        "bang_ratio": per(q["n_bangs"], q["n_words"]),
        "dup_line_ratio": per(q["n_dup_lines"], q["n_lines"]),
        "stop_ratio": per(q["n_stop_words"], q["n_words"]),
    }[name]


def judge(quality: Column, thresholds: Sequence[tuple[str, str, float, int]] = THRESHOLDS) -> Column:
    """True where every rule of the table holds."""
    verdict = F.lit(True)
    for metric, comparison, bound, least_words in thresholds:
        value = _metric(metric, quality)
        holds = value >= bound if comparison == ">=" else value <= bound
        exempt = quality["n_words"] < least_words
        if metric == "stop_ratio":
            exempt = exempt | ~quality["stop_rule"]
        verdict = verdict & (holds | exempt)
    return verdict


def base_failed(quality: Column) -> Column:
    """Too short, or more than half of its words in repeated windows."""
    n = quality["n_words"]
    return (n < 50) | (100 * quality["n_repeat_words"] > 50 * n)


def keep_good(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents that pass, with their own columns only."""
    col = free_name(docs.columns, "q_kept")
    clash = "quality" in {c.lower() for c in docs.columns}
    src = docs.withColumnRenamed("quality", free_name(docs.columns, "q_own")) if clash else docs
    judged = quality_metrics(src).withColumn(
        col, judge(F.col("quality"), thresholds) & ~base_failed(F.col("quality")))
    out = judged.where(F.col(col)).drop(col, "quality")
    return out.toDF(*docs.columns)


def quality_report(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """One row per document: the base counts and the verdict."""
    q = F.col("quality")
    named = [c for c in docs.columns if c.lower() == "lang"]
    judged = quality_metrics(docs.select("doc_id", "text", *named))
    return judged.select(
        "doc_id", q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"),
        q["n_symbols"].alias("n_symbols"), q["n_dup_lines"].alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"), base_failed(q).alias("base_failed"),
        (~base_failed(q) & judge(q, thresholds)).alias("kept"))
