"""Proximity matches of benchmark windows against brute force."""

import random

import pytest
from tests.llm import brute
from tests.llm.conftest import SF
from weekmart.llm import decontaminate

COLS = ("doc_id", "n_near", "near_sha256")


def key(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(("" if x is None else str(x)) for x in r))


@pytest.fixture(scope="module")
def written(spark):
    """Documents that shuffle, thin out and spread the words of items."""
    rng = random.Random(11)
    items = [(1, " ".join(f"a{i}" for i in range(14))), (2, "to be or not to be that is the question whether"),
             (3, "b0 b1 b2 b3 b4 b5"), (4, "c0 c1 c2"), (5, "never0 d1 d2 d3 d4 d5 d6 d7 d8 d9"),
             (6, "never1 never2 e2 e3 e4 e5 e6 e7 e8 e9"), (None, "f0 f1 f2 f3 f4 f5"), (7, None), (8, "...")]
    rows = [(100 + i, " ".join(f"x{rng.randrange(30)}" for _ in range(40))) for i in range(5)]
    for n, (_, text) in enumerate(items):
        words = (text or "").split()
        for kind in range(9):
            w = words[:]
            rng.shuffle(w) if kind % 3 == 0 else None
            if kind % 3 == 1 and w:
                w[rng.randrange(len(w))] = "other"
            if kind >= 3 and w:
                for _ in range(3 * kind):
                    w.insert(rng.randrange(len(w) + 1), f"x{rng.randrange(30)}")
            rows.append((1000 + 10 * n + kind, "x1 " * kind + " ".join(w) + " x2" * 25 + " " + " ".join(words[:8])))
    rows += [(5000, None), (5001, ""), (5002, "a0"), (None, items[0][1]), (5003, items[1][1])] + [(5004, items[0][1])] * 50
    rows.append((5005, ("a0 a1 a2 " + "x " * 21) * 700 + "a4 a3 a2 a1 a0 a5 a6 a7 a8 a12"))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(7),
            spark.createDataFrame(items, "item_id long, text string"), rows, items)


@pytest.mark.parametrize("small", [False, True])
def test_written_variants(written, monkeypatch, small):
    if small:           # everything beyond the bounds: joined by shuffle
        monkeypatch.setattr(decontaminate, "MAX_TERMS_IN_TASK", 3)
        monkeypatch.setattr(decontaminate, "BROADCAST_DOCS", 1)
    docs, items, rows, texts = written
    got = decontaminate.contamination_report(docs, items)
    want = brute.near_items(rows, texts)
    assert key(got.select(*COLS).collect()) == key(want)
    assert sum(r[1] > 0 for r in want) > sum(r.contaminated for r in got.collect())


def test_given_tables(spark, docs, rows):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    got = decontaminate.contamination_report(docs, items).select(*COLS).collect()
    assert key(got) == key(brute.near_items(rows, [tuple(r) for r in items.collect()]))


def test_no_items(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(docs, none).where("n_near > 0").count() == 0
