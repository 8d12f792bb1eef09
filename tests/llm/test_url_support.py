"""A bad host is mined whatever the size of the table."""

import pytest

from weekmart.llm import url_rules


@pytest.mark.parametrize("n_good", [20, 3000])
def test_support_does_not_grow(spark, n_good):
    bad = [(i, f"http://spam{i % 2}.org/win/{i}") for i in range(8)]
    mixed = [(50 + i, f"http://mixed.org/win/{i}") for i in range(6)]  # 4 bad of 6
    good = [(100 + i, f"http://h{i % 50}.fine.org/win/{i}") for i in range(n_good)]
    pages = spark.createDataFrame(bad + mixed + good + [(90, "http://spam1.org/new")],
                                  "page_id long, url string")
    labels = [(i, 0, 0) for i, _ in bad] + [(i, int(i > 53), 0) for i, _ in mixed]
    labels = spark.createDataFrame(labels + [(i, 1, 0) for i, _ in good],
                                   "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judge_urls(pages, labels).collect()}
    assert got[90].verdict == "block" and all(got[i].mined_confidence == 1.0 for i, _ in bad)
    assert all(abs(got[i].mined_confidence - 4 / 6) < 1e-9 for i, _ in mixed)
    assert all(got[i].verdict == "allow" for i, _ in good)


def test_long_repeated_url(spark):
    url = "http://a.b.org/" + "/".join(f"s{chr(97 + i)}" for i in range(24))
    rows = [(url, True)] * 5 + [("http://c.org/x", False)] * 5 + [("http://c.org/x", True)] * 3
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert {tuple(r.tokens) for r in rules} == \
        {(f"host:{x}",) for x in "ab"} | {(f"path:s{chr(97 + i)}",) for i in range(24)} | {("host:org",)}


def brute_rules(rows, min_bad=3, min_confidence=0.6):
    """Every token set of at least ``min_bad`` bad pages, sure enough, and not covered by
    a subset at least as sure."""
    from itertools import combinations
    from urllib.parse import urlsplit
    pages = []
    for url, bad in rows:
        parts = urlsplit(url)
        pages.append(({f"host:{x}" for x in parts.netloc.split(".")}
                      | {f"path:{x}" for x in parts.path.split("/") if x}, bad))
    counts = {}
    for names, bad in pages:
        for n in range(1, len(names) + 1):
            for c in combinations(sorted(names), n):
                total, wrong = counts.get(c, (0, 0))
                counts[c] = (total + 1, wrong + bad)
    sure = {frozenset(c): w / t for c, (t, w) in counts.items() if w >= min_bad and w / t >= min_confidence}
    return {(tuple(sorted(c)), round(p, 9)) for c, p in sure.items()
            if not any(d < c and q >= p for d, q in sure.items())}


@pytest.mark.parametrize("seed", range(3))
def test_rules_against_brute_force(spark, seed):
    import random
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        host = rng.choice(["a.org", "b.org", "c.com"])
        path = "/".join(x for x in "uvwxyz" if rng.random() < 0.4)
        rows.append((f"http://{host}/{path}", rng.random() < (0.95 if "x" in path and host == "a.org" else 0.4)))
    got = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert {(tuple(r.tokens), round(r.confidence, 9)) for r in got} == brute_rules(rows)


def test_many_tokens_of_bad_pages_only(spark):
    """18 bad URLs of one host, each without one of 18 tokens: 2^18 sets, 19 rules."""
    names = [f"t{chr(97 + i)}" for i in range(18)]
    rows = [("http://bad.org/" + "/".join(n for n in names if n != lacking), True) for lacking in names]
    rows += [("http://good.org/x", False)] * 4
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert {tuple(r.tokens) for r in rules} == {("host:bad",)} | {(f"path:{n}",) for n in names} | {("host:org",)}
