"""The near-duplicate stage leaves one row of each component."""

from collections import Counter

from pyspark.sql import functions as F

from tests.llm import brute
from weekmart.llm import simhash


def text(name, tail=""):
    return " ".join(f"{name}{i}" for i in range(300)) + tail


def test_one_row_per_component(spark):
    rows = [(7, text("a"), "x")] * 50 + [(7, text("a"), "y"), (8, text("a"), "x")]
    # id 3 leads one component and has a second text in the component of 2.
    rows += [(3, text("b"), "x"), (4, text("b"), "x"), (2, text("c"), "x"), (3, text("c"), "x")]
    # One id with two texts that lead two components.
    rows += [(1, text("d"), "x"), (1, text("e"), "x"), (9, text("e"), "x")]
    # A component of null ids, and a null-id copy of a kept document.
    rows += [(None, text("f"), "x")] * 20 + [(None, text("f"), "y"), (None, text("b"), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string") \
        .withColumn("extra", F.create_map(F.lit("k"), F.col("own")))
    out = simhash.first_of_each(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    want = Counter({(7, text("a")): 1, (3, text("b")): 1, (2, text("c")): 1, (1, text("d")): 1,
                    (1, text("e")): 1, (None, text("f")): 1})
    assert got == want


def test_against_brute_force(docs, rows):
    named = brute.simhash(rows)
    got = simhash.first_of_each(docs).select("doc_id", "text").collect()
    prints = {(d, t): p for (d, t), (p, _) in zip(rows, named)}
    leaders = Counter(prints[r.doc_id, r.text] for r in got)
    assert all(n == 1 for n in leaders.values())
    assert {r.doc_id for r in got if r.doc_id is not None} \
        == {c for _, c in named if c is not None}
