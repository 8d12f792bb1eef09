"""Sides that an explode makes long are joined by shuffle: Spark sizes them by the table
before it, and would send them to the driver."""

import contextlib
import io

import pytest

from weekmart.llm import decontaminate, simhash
from weekmart.llm.storage import stored


@pytest.fixture()
def wide(spark):
    """The broadcast limit that Spark has of itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10485760")
    yield spark
    spark.conf.set(key, before)


def plan_after(df) -> tuple[list, str]:
    """The rows, and the plan that made them."""
    rows = df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "isFinalPlan=true" in buf.getvalue()
    return rows, buf.getvalue().partition("== Initial Plan ==")[0]


def test_index_rows_of_fingerprints_are_not_broadcast(wide):
    values = [0, 1, 3, 7, 1 << 40, (1 << 40) + 1, (1 << 40) + 9, -1, 0x5A5A5A5A5A5A]
    fps = stored(wide.createDataFrame([(v,) for v in values], "fp bigint"))
    bits = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    want = {(a, b) for a in values for b in values if a < b and bits(a, b) <= 3}
    for hot in (64, 2):
        rows, plan = plan_after(simhash.links(fps, 3, hot))
        assert {(min(r), max(r)) for r in map(tuple, rows)} == want
        assert "SortMergeJoin" in plan and "Inner, Build" not in plan


def test_words_of_windows_are_not_broadcast(wide):
    words = [f"w{i}" for i in range(40)]
    docs = wide.createDataFrame([(i, " ".join(words[i:i + 20])) for i in range(20)], "doc_id bigint, text string")
    items = wide.createDataFrame([(1, " ".join(words[5:17])), (2, "w3 w4"), (3, "w9")], "item_id bigint, text string")
    wins = stored(decontaminate.windows(items))
    postings, vocabulary = decontaminate.build_index(docs, wins)
    ranked = decontaminate.ranked_terms(wins, postings, vocabulary)
    rows, plan = plan_after(decontaminate.phrase_matches(postings, ranked))
    found = {(r.doc_id, r.size, r.start) for r in rows}
    want = {(d, n, a - d) for d in range(20) for a, n in [*[(s, 10) for s in (5, 6, 7)], (3, 2), (9, 1)]
            if d <= a and a + n <= d + 20}
    assert found == want
    assert "Inner, Build" not in plan
    assert plan.count("SortMergeJoin") >= 2
