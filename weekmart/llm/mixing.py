"""Mixing sources to target weights by temperature.

Source shares p become weights proportional to p**a.  The exponent a is bisected
in [0, 1]: 1 keeps the corpus as it is, 0 makes the sources equal.  It is the
largest one whose weights reach the target entropy, raised where needed so that
no source is repeated more often than ``max_repeats``.

The weights are realised as budgeted block permutations.  A source's quota is
its weight times the token budget.  Every source is cut into blocks by a hash of
its documents; each epoch visits the blocks (and the sub-blocks and documents in
them) in its own hashed order.  Whole epochs take every document; the last one
stops in the order before the document that would exceed the quota.  Its end is
found by running sums over at most ``BLOCKS`` blocks, then over the sub-blocks of
the one block it falls into, then over the documents of one sub-block, so no task
holds a source.

Defined cases: a null source is a source of its own; documents without words
(null or empty text) carry no tokens and are not drawn; rows equal in doc_id and
text stand at the same place of the order and are drawn together or not at all;
further columns are carried along and new ones get a leading underscore if their
name is taken; an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekmart.llm.storage import stored
from weekmart.llm.text import free_name, space_words

BLOCKS = 1024
SECTIONS = 16      # points per round of the bisection: four halvings in one job
ROUNDS = 6
BROADCAST_SOURCES = 10_000


@dataclass(frozen=True)
class Target:
    entropy_share: float | None = 0.95   # of the largest possible entropy, ln(sources)
    max_repeats: float | None = 4.0
    budget_tokens: int | None = None     # default: the corpus' own tokens
    seed: int = 7


def source_tokens(docs: DataFrame, source: str = "source") -> DataFrame:
    """(source, tokens) of sources that have tokens."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.sum("n_tokens").alias("tokens")).where("tokens > 0")


def _measures(sources: DataFrame, total: int, budget: int, points: list[float]):
    """{a: (entropy, highest repetition)} for several exponents in one job."""
    p = F.col("tokens") / F.lit(float(total))
    a = F.col("a")
    rows = sources.select(p.alias("p"), F.explode(F.array(*map(F.lit, points))).alias("a")) \
        .groupBy("a").agg(F.sum(F.pow("p", a)).alias("z"),
                          F.sum(F.pow("p", a) * F.ln("p")).alias("s"),
                          F.max(F.pow("p", a - 1)).alias("m")).collect()  # one row per point
    return {r.a: (math.log(r.z) - r.a * r.s / r.z, budget / total * r.m / r.z) for r in rows}


def exponent(sources: DataFrame, target: Target, total: int, budget: int, n: int) -> float:
    """The temperature exponent of the target."""
    def bisect(index: int, bound: float) -> float:
        """Largest a in [0, 1] whose measure (falling in a) is at least ``bound``."""
        ends = _measures(sources, total, budget, [0.0, 1.0])
        if ends[1.0][index] >= bound:
            return 1.0
        if ends[0.0][index] < bound:
            return 0.0
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [lo + (hi - lo) * i / SECTIONS for i in range(1, SECTIONS)]
            at = _measures(sources, total, budget, points)
            above = [x for x in points if at[x][index] >= bound]
            below = [x for x in points if at[x][index] < bound]
            lo, hi = max([lo, *above]), min([hi, *below])
        return lo if index == 0 else hi

    a = 1.0
    if target.entropy_share is not None and n > 1:
        a = bisect(0, target.entropy_share * math.log(n) - 1e-12)
    if target.max_repeats is not None:
        if budget > target.max_repeats * total:
            raise ValueError("the budget exceeds max_repeats times the corpus")
        ends = _measures(sources, total, budget, [a])
        if ends[a][1] > target.max_repeats:
            a = max(a, bisect(1, target.max_repeats + 1e-12))
    return a


def weights(sources: DataFrame, target: Target) -> DataFrame:
    """(source, tokens, weight, quota, epochs, rest): ``epochs`` whole passes and
    ``rest`` tokens of one more."""
    sums = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not sums.n:
        return sources.select("*", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota"),
                              F.lit(0).cast("long").alias("epochs"), F.lit(0).cast("long").alias("rest"))
    total, n = int(sums.t), int(sums.n)
    budget = target.budget_tokens or total
    a = exponent(sources, target, total, budget, n)
    p = F.col("tokens") / F.lit(float(total))
    z = sources.agg(F.sum(F.pow(p, F.lit(a)))).first()[0]
    w = F.pow(p, F.lit(a)) / F.lit(z)
    quota = F.floor(w * budget + F.lit(1e-6)).cast("long")
    return sources.select("source", "tokens", w.alias("weight"), quota.alias("quota")).select(
        "*", F.floor(F.col("quota") / F.col("tokens")).cast("long").alias("epochs"),
        (F.col("quota") % F.col("tokens")).alias("rest"))


def _orders(seed: int, epoch: Column, key: Column) -> list[Column]:
    """A document's place in an epoch: order of its block, its sub-block, itself."""
    block = F.pmod(key, F.lit(BLOCKS))
    sub = F.pmod(F.shiftrightunsigned(key, 20), F.lit(BLOCKS))
    return [F.xxhash64(F.lit(seed), epoch, block).alias("o1"),
            F.xxhash64(F.lit(seed), epoch, block, sub).alias("o2"),
            F.xxhash64(F.lit(seed), epoch, key).alias("o3")]


def _cut(level: DataFrame, order: str) -> DataFrame:
    """Per source the first place in ``order`` whose running sum exceeds the
    rest, with the tokens before it."""
    w = W.partitionBy("source").orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    over = level.withColumn("upto", F.sum("t").over(w)).where(F.col("upto") > F.col("rest"))
    return over.groupBy("source").agg(F.min(F.struct(order, (F.col("upto") - F.col("t"))
                                                     .alias("before"))).alias("c")) \
        .select("source", F.col("c")[order].alias(order), F.col("c")["before"].alias("before"))


def _on_source(a: DataFrame, b: DataFrame, extra: list[str] = (), how: str = "inner",
               small: bool = True) -> DataFrame:
    names = ["source", *extra]
    other = b.withColumnsRenamed({k: f"_{k}" for k in names})
    cond = F.lit(True)
    for k in names:
        cond = cond & a[k].eqNullSafe(other[f"_{k}"])
    return a.join(F.broadcast(other) if small else other, cond, how).drop(*[f"_{k}" for k in names])


def ends(keyed: DataFrame, plan: DataFrame, seed: int, small: bool) -> DataFrame:
    """(source, o1, o2, o3): each source's last epoch takes what stands before."""
    drawn = _on_source(keyed, plan.select("source", "epochs", "rest"), small=small)
    placed = drawn.select("source", "rest", "n_tokens", *_orders(seed, F.col("epochs"), F.col("key")))
    subs = stored(placed.groupBy("source", "rest", "o1", "o2").agg(F.sum("n_tokens").alias("t")))
    one = _cut(subs.groupBy("source", "rest", "o1").agg(F.sum("t").alias("t")), "o1")
    inside = _on_source(subs, one, ["o1"], small=small)
    two = _cut(inside.withColumn("rest", F.col("rest") - F.col("before")).drop("before"), "o2")
    # The documents of that one sub-block; equal places are summed.
    before = one.select("source", "o1", F.col("before").alias("b1"))
    docs = _on_source(placed, before, ["o1"], small=small)
    docs = _on_source(docs, two.withColumnRenamed("before", "b2"), ["o2"], small=small)
    single = docs.select("source", "o1", "o2", "o3", (F.col("rest") - F.col("b1") - F.col("b2"))
                         .alias("rest"), F.col("n_tokens").alias("t")) \
        .groupBy("source", "o1", "o2", "rest", "o3").agg(F.sum("t").alias("t"))
    three = _cut(single.select("source", "rest", "o3", "t"), "o3").drop("before")
    places = _on_source(one.drop("before"), two.drop("before"), small=False)
    return _on_source(places, three, small=False)


def mix(docs: DataFrame, target: Target = Target(), source: str = "source",
        text: str = "text") -> DataFrame:
    """``docs`` repeated and dropped to the target: their columns plus
    ``mix_epoch``, ``mix_order`` (place of the block in the epoch) and
    ``mix_weight`` of the source."""
    cols = docs.columns
    epoch, order, weight = (free_name(cols, x) for x in ("mix_epoch", "mix_order", "mix_weight"))
    tok, key = free_name(cols, "mix_tokens"), free_name(cols, "mix_key")
    counted = docs.withColumn(tok, F.size(space_words(F.col(text))).cast("long")) \
        .withColumn(key, F.xxhash64(F.col("doc_id"), F.col(text)))
    keyed = stored(counted.select(F.col(source).alias("source"), F.col(tok).alias("n_tokens"),
                                  F.col(key).alias("key")).where("n_tokens > 0"))
    plan = stored(weights(source_tokens(keyed), target))
    small = plan.count() <= BROADCAST_SOURCES
    last = _on_source(plan, ends(keyed, plan, target.seed, small), how="left", small=False)
    last = stored(last.select(F.struct("*").alias("m"), F.col("source").alias("m_source")))
    side = F.broadcast(last) if small else last
    m = F.col("m")
    joined = docs.withColumn(key, F.xxhash64(F.col("doc_id"), F.col(text))) \
        .withColumn(tok, F.size(space_words(F.col(text)))).where(F.col(tok) > 0)
    place = F.col(free_name(cols, "mix_place"))
    name = free_name(cols, "mix_place")
    joined = joined.join(side, joined[source].eqNullSafe(F.col("m_source")))
    n = m["epochs"]
    every = F.filter(F.sequence(F.lit(0).cast("long"), n), lambda e: (e < n) | _before(e, key, m, target))
    out = joined.withColumn(name, F.explode(every))
    return out.select(
        *cols, place.cast("int").alias(epoch),
        _orders(target.seed, place, F.col(key))[0].alias(order), m["weight"].alias(weight))


def _before(e: Column, key: str, m: Column, target: Target) -> Column:
    """Whether the document stands before its source's end in the last epoch."""
    o1, o2, o3 = _orders(target.seed, e, F.col(key))
    return (o1 < m["o1"]) | ((o1 == m["o1"]) & ((o2 < m["o2"]) | ((o2 == m["o2"]) & (o3 < m["o3"]))))


def mixing_report(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """One row per drawn document and epoch."""
    small = docs.select("doc_id", "source", "text")
    return mix(small, target).select(
        "doc_id", "source", F.col("mix_epoch").alias("epoch"),
        F.col("mix_order").alias("block_order"), F.col("mix_weight").alias("weight"))
