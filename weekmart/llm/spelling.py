"""Spelling variants: words one code point apart, grouped under their common form.

1. Words are counted in Spark.
2. Of a word's two halves one is exact in each of its near words, so near words share
   their first three code points or their last three.  The vocabulary is dealt twice,
   by its first and by its last ``KEY`` code points, into shards of bounded size.
3. Each shard holds a bidirectional FM-index of its words (``variant_index``); its
   words are searched with the first half exact and the error behind it, or with the
   last half exact and the error before it.  Pairs of the second search that agree in the
   first half as well were found by the first and are left out.
4. The most frequent near word becomes a word's form if it is common enough, and forms
   are followed to the last by doubling the links.

A key of more than ``HOT_WORDS`` words is cut into slices; each pair of slices is a
shard of its own (words of the one searched in the index of the other), so that no
group is unbounded and no pair is lost.

Defined cases: null text has no words; a null doc_id counts as an empty one in the hash; repeated rows
count as often as they stand; other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.llm.storage import stored
from weekmart.llm.text import lower_ascii
from weekmart.llm.variant_index import VariantIndex

RUN_SEPARATORS = r"[^a-zÀ-ÿ]+"        # in lower-cased text
DROP_EVERY = 199        # a run whose hash this divides loses a code point
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
KEY = 3
HOT_WORDS = 50_000
SHARD_WORDS = 25_000
PAIRS = "word string, n bigint, near string, near_n bigint"


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points that occur at least
    ``least_count`` times, with one code point dropped where the hash says so."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.split(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), RUN_SEPARATORS)).alias("run"))
    # Only longer runs than a word's least length can lose a code point and stay one.
    runs = runs.where(F.length("run") >= least_length)
    h = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod("h", F.lit(DROP_EVERY)) == 0, cut).otherwise(F.col("run"))
    return runs.select("run", h.alias("h")).select(word.alias("word")) \
        .where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")) \
        .where(F.col("n") >= least_count)


def dealt(words: DataFrame, key, hot_words: int) -> DataFrame:
    """(group, i, j, word, n, indexed, asked): the rows of each shard.  Small keys are
    dealt into common groups; a hot key's slices meet pairwise."""
    keyed = words.select("word", "n", key.alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size"))
    hot = sizes.where(F.col("size") > hot_words).select(
        F.col("key").alias("hot_key"), F.ceil(F.col("size") / hot_words).cast("int").alias("slices"))
    shards = max(1, -(-words.count() // SHARD_WORDS))
    x = keyed.join(hot, F.col("key") == F.col("hot_key"), "left")
    is_hot = F.col("slices").isNotNull()
    x = x.select(
        "word", "n", F.coalesce("slices", F.lit(1)).alias("slices"),
        F.when(is_hot, F.concat(F.lit("="), "key")).otherwise(
            F.pmod(F.xxhash64("key"), F.lit(shards)).cast("string")).alias("group"),
        F.pmod(F.xxhash64("word"), F.coalesce("slices", F.lit(1))).cast("int").alias("slice"))
    every = F.sequence(F.lit(0), F.col("slices") - 1)
    own = F.col("slice")
    cells = F.array_union(
        F.transform(every, lambda k: F.struct(own.alias("i"), k.alias("j"))),
        F.transform(every, lambda k: F.struct(k.alias("i"), own.alias("j"))))
    x = x.select("word", "n", "group", "slice", F.explode(cells).alias("c"))
    return x.select("group", "c.i", "c.j", "word", "n", (F.col("c.i") == own).alias("indexed"),
                    (F.col("c.j") == own).alias("asked"))


def search_shard(rows: pd.DataFrame, second_half: bool) -> pd.DataFrame:
    """Pairs (asked word, indexed word) at one error in the given half."""
    held = rows[rows["indexed"]].sort_values("word")
    asked = rows[rows["asked"]]
    out = pd.DataFrame({"word": [], "n": [], "near": [], "near_n": []})
    if not len(held) or not len(asked):
        return out
    words, questions = held["word"].tolist(), asked["word"].tolist()
    q, w = VariantIndex(words).search(questions, second_half)
    if not second_half:
        fresh = [not words[b].startswith(questions[a][:len(questions[a]) // 2])
                 for a, b in zip(q.tolist(), w.tolist())]
        q, w = q[fresh], w[fresh]
    near = held.iloc[w]
    of = asked.iloc[q]
    return pd.DataFrame({"word": of["word"].to_numpy(), "n": of["n"].to_numpy(),
                         "near": near["word"].to_numpy(), "near_n": near["n"].to_numpy()})


def near_pairs(words: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """(word, n, near, near_n): each ordered pair of near words once.  ``words`` is
    (word, n), distinct, of at least 2 * ``KEY`` code points."""
    shard = ["group", "i", "j"]
    behind = dealt(words, F.substring("word", 1, KEY), hot_words).groupBy(*shard) \
        .applyInPandas(lambda rows: search_shard(rows, True), PAIRS)
    before = dealt(words, F.expr(f"right(word, {KEY})"), hot_words).groupBy(*shard) \
        .applyInPandas(lambda rows: search_shard(rows, False), PAIRS)
    return behind.unionByName(before)


def forms(words: DataFrame, pairs: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n): the most frequent near word, the smallest in
    code-point order of equal ones, where it is ``times`` as frequent as the word."""
    # Spark compares strings by their UTF-8 bytes, which is code-point order.
    best = F.min_by(F.col("near"), F.struct(-F.col("near_n"), F.col("near")))
    per = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("near"),
                                    F.max("near_n").alias("near_n")) \
        .withColumnRenamed("word", "w")
    common = F.col("near_n") >= times * F.col("n")
    return words.join(per, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("near")).alias("form"), F.when(common, F.col("near_n")).alias("form_n"))


def with_roots(words: DataFrame) -> DataFrame:
    """``words`` with ``root``: the last word that its forms lead to.  Each round
    doubles the length of the links; counts grow along them, so there is an end."""
    links = stored(words.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("w"), F.col("root").alias("further"))
        longer = stored(links.join(ahead, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("w").isNotNull().alias("moved")))
        links = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    ends = links.select(F.col("word").alias("w"), "root")
    return words.join(ends, F.col("word") == F.col("w"), "left") \
        .withColumn("root", F.coalesce("root", "word")).drop("w")


def spelling_report(docs: DataFrame) -> DataFrame:
    """One row per word: its form, the root of its group and its near words."""
    words = stored(count_words(docs))
    found = stored(forms(words, near_pairs(words)))
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
