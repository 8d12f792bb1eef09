"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF
from weekmart.llm.storage import stored

BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, docs):
    at = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, at, SF))
        rows = [(r.doc_id, r.text) for r in at.collect()]
        got = sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id is not None)
        if name != "mix_sources":
            assert out.columns == at.columns
        if name == "near_duplicates":
            keep = [r for r, (_, c) in zip(rows, brute.simhash(rows)) if r[0] == c and c is not None]
            assert got == sorted(keep)
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hit = {r[0] for r in brute.decontaminate(rows, items) if r[5]}
            assert got == sorted(r for r in rows if r[0] is not None and r[0] not in hit)
        elif name == "redact_pii":
            assert len(got) == len([r for r in rows if r[0] is not None])
            assert all(brute.pii(t)[0] == [0, 0, 0, 0] for _, t in got)
            assert all(r.n_chars == len(r.text) for r in out.collect() if r.doc_id >= 9000)
        elif name == "quality_rules":
            assert all(not brute.quality(t)[5] for _, t in got)
            assert len(got) > 100
        else:
            assert {d for d, _ in got} <= {d for d, _ in rows}
        seen.append(name)
        at = out
    assert seen == [n for n, _ in corpus_pipeline.STAGES]
    assert set(docs.columns) < set(at.columns)


def test_empty(spark, empty):
    at = empty
    for _, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, SF))
    assert at.count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(BASE) < set(out.columns) and out.count() > 0
