"""License scans by diagonal voting.

Every rolling word k-gram of a text is joined by its hash to the positions it
has in the license templates, and the words are compared, so each joined row is
a verified k-gram.  A row votes for the diagonal ``text position - template
position``; votes are kept as a bit per template position, combined before the
shuffle.  Neighbouring diagonals (words added or left out, up to a quarter of the
template) are merged into candidate spans that cover enough of the template.

Candidates are verified against the text: the span's words are read back, its
qualifying words (``lesser``, ``noncommercial``, ``not``, ...) must be those of the
template in the same order, and a span merged from several diagonals must hold
``COVERAGE`` of the template's words in order (longest common subsequence).

The base phrases are templates as well: a base place is a diagonal on which all
k-grams of the phrase voted, that is, its words stand consecutively.

Defined cases: null text is empty; texts shorter than a k-gram have no hits;
rows equal in doc_id and text get the same result, null ids included; other
columns do not matter; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekmart.llm.storage import stored
from weekmart.llm.text import alnum_words

K = 2
DRIFT = 2            # words a span may gain or lose besides a quarter of its template
COVERAGE = 0.75      # share of a template's k-grams a span must hold
BITS = 63            # template positions held by one long; longer templates take several
BROADCAST_POSITIONS = 10_000

# Label and phrase.
BASE_PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Label and the wording of the license's usual notice.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general "
             "public license as published by the free software foundation"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc-nd", "licensed under a creative commons attribution noncommercial noderivatives 4 0 "
                    "international license"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution noncommercial sharealike 4 0 "
                    "international license"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general "
             "public license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu library general "
             "public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
)

# Words that make another license of a wording they stand in.
QUALIFIERS = ("affero alike commercial derivatives derivs lesser library nc nd no noderivatives noderivs "
              "non noncommercial not sa share sharealike").split()


def _chunks(*lists: Sequence) -> int:
    """Longs that hold the positions of the longest template."""
    return max((len(t.split()) - K) // BITS + 1 for texts in lists for _, t in texts)


def template_positions(spark: SparkSession, base: Sequence, templates: Sequence) -> DataFrame:
    """(gram, template, label, is_base, at, grams) of every template k-gram."""
    rows = []
    for i, (label, text) in enumerate([*base, *templates]):
        words = text.split()
        grams = [" ".join(words[j:j + K]) for j in range(len(words) - K + 1)]
        if not grams:
            raise ValueError(f"a template needs at least {K} words: {text!r}")
        rows += [(g, i, label, i < len(base), j, len(grams)) for j, g in enumerate(grams)]
    names = ("t_gram", "template", "label", "is_base", "at", "grams")
    literals = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    df = spark.range(1).select(F.inline(F.array(*literals))).withColumn("t_hash", F.xxhash64("t_gram"))
    return F.broadcast(df) if len(rows) <= BROADCAST_POSITIONS else df


def votes(docs: DataFrame, positions: DataFrame, chunks: int, text: str = "text") -> DataFrame:
    """(doc_id, doc_hash, template, label, is_base, grams, diagonal, m0.., start,
    end): the template positions voted for and the words from start to end."""
    words = docs.select("doc_id", F.xxhash64(text).alias("doc_hash"),
                        alnum_words(F.col(text)).alias("words"))
    n = F.size("words")
    grams = F.when(n >= K, F.transform(
        F.sequence(F.lit(0), n - K),
        lambda i: F.concat_ws(" ", *[F.get("words", i + j) for j in range(K)])))
    rolled = words.select("doc_id", "doc_hash", F.posexplode(grams).alias("pos", "gram"))
    hits = rolled.withColumn("hash", F.xxhash64("gram")) \
        .join(positions, (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")))
    bit = F.expr(f"shiftleft(1L, at % {BITS})")
    masks = [F.bit_or(F.when(F.floor(F.col("at") / BITS) == c, bit).otherwise(F.lit(0).cast("long")))
             .alias(f"m{c}") for c in range(chunks)]
    return hits.groupBy("doc_id", "doc_hash", "template", "label", "is_base", "grams",
                        (F.col("pos") - F.col("at")).alias("diagonal")) \
        .agg(*masks, F.min("pos").alias("start"), (F.max("pos") + K).alias("end"))


def _held(masks: Sequence) -> Column:
    return sum((F.bit_count(m) for m in masks[1:]), F.bit_count(masks[0]))


def candidates(voted: DataFrame, chunks: int) -> DataFrame:
    """(doc_id, doc_hash, template, label, merged, coverage, start, end): each
    diagonal by itself, and with the following ones up to a quarter of the
    template away, that hold ``COVERAGE`` of the template."""
    own = [F.col(f"m{c}") for c in range(chunks)]
    reach = F.floor(F.col("grams") / 4) + DRIFT + 0.5
    w = W.partitionBy("doc_id", "doc_hash", "template").orderBy("scaled").rangeBetween(0, 1)
    rows = voted.where("not is_base").withColumn("scaled", F.col("diagonal") / reach)
    spread = rows.select("*", *[F.bit_or(m).over(w).alias(f"w{c}") for c, m in enumerate(own)],
                         F.min("start").over(w).alias("w_start"), F.max("end").over(w).alias("w_end"))
    share = lambda masks: _held(masks) / F.col("grams")
    either = F.array(
        F.struct(F.lit(False).alias("merged"), share(own).alias("coverage"), "start", "end"),
        F.struct(F.lit(True).alias("merged"),
                 share([F.col(f"w{c}") for c in range(chunks)]).alias("coverage"),
                 F.col("w_start").alias("start"), F.col("w_end").alias("end")))
    return spread.select("doc_id", "doc_hash", "template", "label", F.inline(either)) \
        .where(F.col("coverage") >= COVERAGE).distinct()


def _in_order(span: Column, wording: Column) -> Column:
    """Length of the longest common subsequence of two word arrays."""
    def step(row: Column, word: Column) -> Column:
        # A cell is the largest of its left, upper and (for equal words) diagonal neighbour.
        def cell(done: Column, i: Column) -> Column:
            hit = F.get(row, i) + F.when(F.get(wording, i) == word, 1).otherwise(0)
            return F.concat(done, F.array(F.greatest(F.element_at(done, -1), F.get(row, i + 1), hit)))
        return F.aggregate(F.sequence(F.lit(0), F.size(wording) - 1), F.array(F.lit(0)), cell)

    first = F.array_repeat(F.lit(0), F.size(wording) + 1)
    return F.element_at(F.aggregate(span, first, step), -1)


def verified(found: DataFrame, docs: DataFrame, wordings: Sequence[str], text: str = "text") -> DataFrame:
    """The candidates whose words are those of their template."""
    source = docs.select(F.col("doc_id").alias("d_id"), F.xxhash64(text).alias("d_hash"),
                         F.col(text).alias("d_text"))
    met = source.join(found, (F.col("doc_hash") == F.col("d_hash"))
                      & F.col("doc_id").eqNullSafe(F.col("d_id"))).select(
        *found.columns, F.slice(alnum_words(F.col("d_text")), F.col("start") + 1,
                                F.col("end") - F.col("start")).alias("span"))
    all_words = F.array(*[F.split(F.lit(t), " ") for t in wordings])
    met = met.withColumn("wording", F.get(all_words, F.col("template")))
    qualifying = lambda words: F.filter(words, lambda x: x.isin(QUALIFIERS))
    same = qualifying(F.col("span")) == qualifying(F.col("wording"))
    ordered = F.when(~same, False).when(~F.col("merged"), True).otherwise(
        _in_order(F.col("span"), F.col("wording")) >= COVERAGE * F.size("wording"))
    return met.where(ordered)


def spans(voted: DataFrame, docs: DataFrame, wordings: Sequence[str], chunks: int) -> DataFrame:
    """(doc_id, doc_hash, label, is_base, first_word, coverage): verified spans.
    Base phrases need a full diagonal; templates ``COVERAGE`` over merged ones."""
    full = voted.where(F.col("is_base") & (_held([F.col(f"m{c}") for c in range(chunks)])
                                           == F.col("grams"))).select(
        "doc_id", "doc_hash", "label", "is_base", F.col("diagonal").alias("first_word"),
        F.lit(1.0).alias("coverage"))
    found = verified(stored(candidates(voted, chunks)), docs, wordings)
    return full.unionByName(found.select("doc_id", "doc_hash", "label", F.lit(False).alias("is_base"),
                                         F.col("start").alias("first_word"), "coverage"))


def license_report(docs: DataFrame, base: Sequence = BASE_PHRASES,
                   templates: Sequence = TEMPLATES) -> DataFrame:
    """One row per document: base places and labels, all labels, best score."""
    chunks = _chunks(base, templates)
    voted = stored(votes(docs, template_positions(docs.sparkSession, base, templates), chunks))
    found = spans(voted, docs, [t for _, t in (*base, *templates)], chunks)
    is_base = F.col("is_base")
    first = F.when(is_base, F.col("first_word").cast("long"))
    by_doc = found.groupBy(F.col("doc_id").alias("s_id"), F.col("doc_hash").alias("s_hash")).agg(
        F.count(F.when(is_base, 1)).alias("n_base"), F.min(first).alias("first_word"),
        F.max(first).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",")
        .alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.round(F.max("coverage"), 6).alias("score"))
    counts = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"),
                         F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    return counts.join(by_doc, (F.col("doc_hash") == F.col("s_hash"))
                       & F.col("doc_id").eqNullSafe(F.col("s_id")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
