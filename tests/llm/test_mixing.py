"""Temperature mixing against brute force."""

import math
from collections import defaultdict

import pytest
import xxhash

from weekmart.llm import mixing
from weekmart.llm.mixing import Target, mix, source_tokens, weights


@pytest.fixture(scope="module")
def small(spark):
    rows, i = [], 0
    for source, n in (("a", 300), ("b", 60), ("c", 15), (None, 30), ("void", 0)):
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + (i * 7) % 13)), source, "x"))
            i += 1
    rows += [(9000, None, "a", "x"), (9001, "", "void", "x"), (5, rows[5][1], "a", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_epoch string").cache()


def shares(small):
    tokens = defaultdict(int)
    for r in small.collect():
        tokens[r.source] += len((r.text or "").split())
    return {s: t for s, t in tokens.items() if t}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values() if x)


def brute_weights(tokens, target):
    total = sum(tokens.values())
    budget = target.budget_tokens or total

    def at(a):
        p = {s: (t / total) ** a for s, t in tokens.items()}
        z = sum(p.values())
        return {s: x / z for s, x in p.items()}

    def search(ok):
        if ok(1.0):
            return 1.0
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if ok(mid) else (lo, mid)
        return lo

    a = 1.0
    if target.entropy_share is not None:
        a = search(lambda x: entropy(at(x)) >= target.entropy_share * math.log(len(tokens)))
    worst = lambda x: max(at(x)[s] * budget / t for s, t in tokens.items())
    if target.max_repeats is not None and worst(a) > target.max_repeats:
        lo, hi = a, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if worst(mid) <= target.max_repeats else (mid, hi)
        a = hi
    return at(a)


@pytest.mark.parametrize("target", [Target(), Target(0.99, None), Target(None, 2.0), Target(1.0, 1.5),
                                    Target(0.9, None, 500)])
def test_weights(spark, small, target):
    docs = small.withColumn("n_tokens", mixing.F.size(mixing.space_words(mixing.F.col("text"))))
    got = {r.source: r for r in weights(source_tokens(docs), target).collect()}
    tokens = shares(small)
    want = brute_weights(tokens, target)
    assert set(got) == set(want)
    budget = target.budget_tokens or sum(tokens.values())
    for s, r in got.items():
        assert r.tokens == tokens[s]
        assert r.weight == pytest.approx(want[s], abs=1e-5)
        assert r.epochs * r.tokens + r.rest == r.quota <= r.weight * budget + 1e-3


@pytest.mark.parametrize("target", [Target(0.99, None), Target(None, None, 700), Target(1.0, 3.0)])
def test_drawn_documents(spark, small, target):
    out = mix(small, target)
    assert out.columns == [*small.columns, "_mix_epoch", "mix_order", "mix_weight"]
    rows = out.collect()
    docs = small.withColumn("n_tokens", mixing.F.size(mixing.space_words(mixing.F.col("text"))))
    plan = {r.source: r for r in weights(source_tokens(docs), target).collect()}
    place = defaultdict(list)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    h64 = lambda v, s: xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), s & ((1 << 64) - 1))
    keys = {(r.doc_id, r.text): r.k for r in
            small.withColumn("k", mixing.F.xxhash64("doc_id", "text")).collect()}
    for r in small.collect():
        n = len((r.text or "").split())
        if n:
            place[r.source].append((keys[r.doc_id, r.text], n, r.doc_id))
    drawn = defaultdict(list)
    for r in rows:
        drawn[r.source, r["_mix_epoch"]].append(r.doc_id)
    for s, p in plan.items():
        for e in range(p.epochs):
            assert sorted(drawn[s, e]) == sorted(d for _, _, d in place[s])
        used = sum(n for _, n, d in place[s] if d in set(drawn[s, p.epochs]))
        assert used <= p.rest
        longest = max(n for _, n, _ in place[s]) * 2
        assert p.rest - used < longest or p.rest == 0
        assert (s, p.epochs + 1) not in drawn
    assert all(r.source != "void" and r.text for r in rows)


def test_empty_and_wordless(spark, small):
    assert mix(small.where("false")).count() == 0
    assert mix(small.where("doc_id >= 9000")).count() == 0
