"""URL filters: fixed host/path rules, then association rules mined from labels.

Labelled URLs become sets of tokens (host labels, path segments, query names);
Spark's FP-growth mines the combinations that at least ``MIN_BAD_PAGES`` bad pages
share, a number that does not depend on the table's size; their confidence is
counted over all labelled pages.  A token of bad pages only is a rule as it is and not
mined further.  Tokens that stand in exactly the same labelled
URLs are mined as one and written out again afterwards, so that a long repeated
URL does not give every subset of its tokens.  Rules below the confidence bound
are pruned, and so is a rule whose tokens include those of another rule at least
as confident.  Rules are matched by an inverted index: a rule's rarest token ->
rule, joined to the URLs' tokens; a rule applies to a URL that has all its tokens.

Defined cases: a url that is null or has no ``://`` has empty host and path,
matches no fixed rule and no mined one; pages without label are not used to
mine, and an empty label table mines nothing (verdict ``allow``); repeated rows
are judged alike; other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.llm.storage import stored

# host, path, verdict
RULES: tuple[tuple[str, str, str], ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_BAD_PAGES = 3
MIN_CONFIDENCE = 0.6


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    longest_first = sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0])), reverse=True)
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in longest_first]
    return F.coalesce(*fits)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host labels, path segments (numbers as #) and
    query names."""
    labels = F.transform(F.array_remove(F.split(host_of(url), r"\."), ""),
                         lambda x: F.concat(F.lit("host:"), x))
    plain = F.regexp_replace(path_of(url), "[0-9]+", "#")
    parts = F.transform(F.array_remove(F.split(plain, "/"), ""),
                        lambda x: F.concat(F.lit("path:"), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*://[^?#]*\?([^#]*)", 1)
    names = F.transform(F.array_remove(F.split(query, "&"), ""),
                        lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(labels, parts, names))


def holding(sets: DataFrame, rows: DataFrame, items: str) -> DataFrame:
    """``rows`` joined to the sets (set_id, members, rare, ...) that the array
    ``items`` holds; found by each set's rarest member."""
    posts = rows.select("*", F.explode(items).alias("rare"))
    return posts.join(sets, "rare").where(F.size(F.array_except("members", items)) == 0)


def _with_rarest(sets: DataFrame, seen: DataFrame) -> DataFrame:
    """``sets`` (set_id, members, ...) with the member that the fewest pages have."""
    rare = sets.select("set_id", F.explode("members").alias("item")).join(seen, "item") \
        .groupBy("set_id").agg(F.min(F.struct("pages", "item"))["item"].alias("rare"))
    return sets.join(rare, "set_id")


def mine(labelled: DataFrame, min_bad: int = MIN_BAD_PAGES,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, tokens, confidence, rare) from rows (url, bad)."""
    spark = labelled.sparkSession
    urls = stored(labelled.where("url is not null").groupBy("url").agg(
        F.count("*").alias("pages"), F.count(F.when(F.col("bad"), 1)).alias("bad_pages")))
    words = urls.select("*", F.explode(tokens(F.col("url"))).alias("token"))
    # Tokens of the same URLs have equal counts and hash sums.
    by_token = words.groupBy("token").agg(
        F.sum("pages").alias("pages"), F.sum("bad_pages").alias("bad_pages"),
        F.sum(F.xxhash64("url").cast("decimal(38,0)")).alias("h1"),
        F.bit_xor(F.xxhash64("url", F.lit(1))).alias("h2")).where(F.col("bad_pages") >= min_bad)
    classes = stored(by_token.groupBy("pages", "bad_pages", "h1", "h2").agg(
        F.min("token").alias("item"), F.collect_list("token").alias("names")))
    # A token that no good page has is a rule of confidence 1.  No set that holds it can
    # be surer, so it is mined no further: else k such tokens would give 2^k sets.
    only_bad = F.col("bad_pages") == F.col("pages")
    certain = classes.where(only_bad).select(
        F.xxhash64(F.array("item")).alias("set_id"), F.array("item").alias("members"),
        F.col("item").alias("rare"), F.lit(1.0).alias("confidence"))
    open_classes = classes.where(~only_bad)
    baskets = stored(words.select("url", "token").join(
        open_classes.select("item", F.explode("names").alias("token")), "token")
        .groupBy("url").agg(F.collect_set("item").alias("items")).join(urls, "url"))
    bad = baskets.where("bad_pages > 0").select(
        "items", F.explode(F.sequence(F.lit(1), F.col("bad_pages"))).alias("i")).select("items")
    n_bad = bad.count()
    least = certain
    if n_bad:
        growth = FPGrowth(itemsCol="items", minSupport=(min_bad - 0.5) / n_bad,
                          numPartitions=spark.sparkContext.defaultParallelism)
        found = growth.fit(bad).freqItemsets
        sets = stored(found.select(F.xxhash64(F.array_sort("items")).alias("set_id"),
                                   F.array_sort("items").alias("members"), "freq"))
        sets = stored(_with_rarest(sets, open_classes.select("item", "pages")))
        counted = holding(sets, baskets.select("items", "pages"), "items") \
            .groupBy("set_id").agg(F.sum("pages").alias("pages"))
        sure = stored(sets.join(counted, "set_id").withColumn("confidence", F.col("freq") / F.col("pages"))
                      .where(F.col("confidence") >= min_confidence).drop("pages", "freq"))
        # A rule that holds all tokens of another at least as confident adds nothing.
        larger = sure.select(F.col("set_id").alias("a_id"), F.col("members").alias("a_members"),
                             F.col("confidence").alias("a_confidence"))
        covered = holding(sure, larger, "a_members") \
            .where("size(members) < size(a_members) and confidence >= a_confidence") \
            .select(F.col("a_id").alias("set_id")).distinct()
        least = certain.unionByName(sure.join(covered, "set_id", "left_anti"))
    # Every choice of one token per class is a rule; tokens of a class are equally rare.
    members = least.select("set_id", "rare", "confidence", F.explode("members").alias("item")) \
        .join(classes.select("item", "names"), "item").groupBy("set_id", "confidence").agg(
            F.array_sort(F.collect_list(F.struct((F.col("item") != F.col("rare")).alias("later"),
                                                 "item", "names"))).alias("m"))
    none = F.array(F.array().cast("array<string>"))
    choices = F.aggregate(F.col("m"), none, lambda done, c: F.flatten(F.transform(
        done, lambda d: F.transform(c["names"], lambda x: F.concat(d, F.array(x))))))
    rules = members.select("confidence", F.explode(choices).alias("chosen"))
    return rules.select(F.xxhash64(F.array_sort("chosen")).alias("rule_id"),
                        F.array_sort("chosen").alias("tokens"), "confidence",
                        F.get("chosen", F.lit(0)).alias("rare"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, score): distinct URLs that some rule matches, with the highest
    confidence among their rules."""
    words = urls.select("url").where("url is not null").distinct() \
        .select("url", tokens(F.col("url")).alias("words"))
    sets = rules.withColumnsRenamed({"rule_id": "set_id", "tokens": "members"})
    return holding(sets, words, "words").groupBy("url").agg(F.max("confidence").alias("score"))


def judge_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per page.  ``labels`` has (doc_id, quality, toxic) of the page
    with that id; a page is bad if its quality is 0 or it is toxic."""
    bad = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad"))
    rules = mine(pages.select("page_id", "url").join(bad, "page_id").select("url", "bad"))
    hit = matches(pages, stored(rules)).withColumnRenamed("url", "hit_url")
    url = F.col("url")
    judged = pages.select("page_id", "url").join(hit, url == F.col("hit_url"), "left").select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), "score")
    fixed = fixed_rule(F.col("host"), F.col("path"))
    mined = F.when(F.col("score").isNotNull(), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", fixed["rule"].alias("rule"),
                         F.coalesce(fixed["verdict"], mined).alias("verdict"),
                         F.col("score").alias("mined_confidence"))
