"""The operators against brute force on a small table with awkward rows."""

from collections import Counter

import pytest

from tests.llm import brute
from tests.llm.conftest import SF
from weekmart.llm import (
    decontaminate, licenses, pii, quality_rules, secrets_crf, simhash, substring_dedup,
    url_rules, warc,
)


def same(found, expected):
    a, b = Counter(map(tuple, found)), Counter(map(tuple, expected))
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


def test_simhash(docs, rows):
    same(simhash.simhash_report(docs).collect(),
         [(d, *x) for (d, _), x in zip(rows, brute.simhash(rows))])


@pytest.mark.parametrize("max_bits", [1, 2, 3, 5])
@pytest.mark.parametrize("hot", [1, 64])
def test_simhash_links_are_complete(spark, max_bits, hot):
    import random
    rng = random.Random(max_bits)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(14):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {frozenset((r.u, r.v)) for r in simhash.links(df, max_bits, hot).collect()}
    m = (1 << 64) - 1
    want = {frozenset((a, b)) for a in signed for b in signed
            if a < b and ((a ^ b) & m).bit_count() <= max_bits}
    assert got == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 80)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert all(got[i] == 1 for i in range(2, 61))
    assert all(got[1000 + i] == 1000 for i in range(1, 80))


def test_decontaminate(spark, docs, rows):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    odd = spark.createDataFrame([(900, "two words"), (901, "tail"), (902, None), (903, ""),
                                 (None, "dup"), (900, "two words"), (904, "w1 w1")], bench.schema)
    items = bench.unionByName(odd)
    got = decontaminate.contamination_report(docs, items).collect()
    same([r[:6] for r in got], brute.decontaminate(rows, [tuple(r) for r in items.collect()]))
    assert any(r.contaminated for r in got)


def test_decontaminate_with_a_joined_vocabulary(spark, docs, rows, monkeypatch):
    """More benchmark words than tasks may hold: the same rows."""
    monkeypatch.setattr(decontaminate, "MAX_TERMS_IN_TASK", 10)
    monkeypatch.setattr(decontaminate, "BROADCAST_DOCS", 1)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    got = decontaminate.contamination_report(docs, items).collect()
    same([r[:6] for r in got], brute.decontaminate(rows, [tuple(r) for r in items.collect()]))


def test_substring(docs, rows):
    same(substring_dedup.substring_report(docs).collect(), brute.substring(rows))


def test_substring_hot_anchor(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_TEXTS", 1)
    monkeypatch.setattr(substring_dedup, "SHARD_PASSAGES", 5)
    same(substring_dedup.substring_report(docs).collect(), brute.substring(rows))


def test_quality(docs, rows):
    got = quality_rules.quality_report(docs).collect()
    same([tuple(r)[:7] for r in got], [(d, *brute.quality(t)) for d, t in rows])
    assert all(not (r.kept and r.base_failed) for r in got)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in got)


def test_licenses(docs, rows):
    got = licenses.license_report(docs).collect()
    same([tuple(r)[:6] for r in got],
         [(d, *brute.licenses(t, licenses.BASE_PHRASES)) for d, t in rows])
    by_id = {r.doc_id: r for r in got}
    assert by_id[9016].labels == "mit" and by_id[9016].n_base == 0
    assert set(by_id[9015].base_labels.split(",")) == {"apache", "cc-by", "gpl", "mit"}


def test_pii(docs, rows):
    got = pii.pii_report(docs).collect()
    same([(r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256).__repr__() for r in got],
         [(d, *brute.pii(t)).__repr__() for d, t in rows])
    spans = {r.doc_id: r.spans for r in got}[9017]
    assert "iban:" in spans and "ssn:" in spans


def test_redact(docs):
    out = pii.redact(docs, "text", "n_chars")
    assert out.columns == docs.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[9017].startswith("[EMAIL]") and "bob@x.org" not in text[9017]
    assert text[9000] is None and text[9003] == "one"
    assert pii.pii_report(out).where("n_email + n_ip + n_card + n_phone > 0").count() == 0


def test_secrets(docs, rows):
    got = secrets_crf.secret_report(docs).collect()
    expected = []
    for d, t in rows:
        counts, spans = brute.secrets(t)
        expected.append((d, *counts, brute.sha(",".join(spans))))
    same([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], expected)
    for r in got:
        kept = [s for s in r.spans.split(",") if s and not s.startswith("crf:")]
        assert brute.sha(",".join(kept)) == r.base_sha256


def test_warc(spark, scratch):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    big, small = "é" * 700, "s" * 999
    rows = [(9001, "http://a/", big), (9002, None, big), (9003, "http://b/\r\nX: y", big),
            (9003, "http://b/\r\nX: y", big), (9004, "c", small), (9005, "c", small),
            (9006, "d", None), (9007, "d", ""), (None, "e", big), (None, None, None)]
    pages = pages.unionByName(spark.createDataFrame(rows, pages.schema))
    data = [tuple(r) for r in pages.collect()]
    same(warc.warc_report(pages, scratch).collect(), brute.warc(data))
    back = warc.read_archive(spark, scratch)
    by_id = {r.page_id: r for r in back.collect()}
    html = {p: (h or "").encode() for p, _, h in data}
    for p, r in by_id.items():
        if p is not None:
            assert bytes(r.payload) == html[p]
            body = bytes(r.payload) if r.record_type == "response" else b""
            assert bytes(r.record) == r.warc_header.encode() + r.http_header.encode() + body + b"\r\n\r\n"
            length = int(r.warc_header.split("Content-Length: ")[1].split("\r\n")[0])
            assert length == len(r.http_header.encode()) + len(body)
    stored = spark.read.parquet(f"{scratch}/payloads")
    assert stored.count() == len({h for h in map(lambda x: (x[2] or "").encode(), data)})


def test_warc_files(spark, scratch):
    import glob
    import gzip
    pages = spark.createDataFrame([(1, "u", "x\r\n\r\ny"), (2, "v", "z")],
                                  "page_id long, url string, html string")
    warc.write_archive(warc.pages_as_payloads(pages), f"{scratch}/a")
    back = warc.read_archive(spark, f"{scratch}/a")
    warc.export_files(back, f"{scratch}/files")
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{scratch}/files/part-*".replace("file:", "")))
    assert sorted(raw) == sorted(b"".join(bytes(r.record) for r in back.collect()))


def test_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = [(9000, None), (9001, ""), (9002, "no scheme"), (9003, "HTTP://WWW.Example.COM/en/x?q"),
           (9004, "http://example.com"), (9005, "http://xexample.com/en/"), (9006, "a://b.net/fr/\n#x"),
           (9006, "a://b.net/fr/\n#x"), (9007, "://com/"), (9008, "x://net/es/y://com/")]
    pages = pages.unionByName(spark.createDataFrame(odd, pages.schema))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = url_rules.judge_urls(pages, labels).collect()
    want = []
    for p, u in [tuple(r) for r in pages.collect()]:
        host, path, best = brute.url(u, url_rules.RULES)
        want.append((p, host, path, best and best[0], best and best[1]))
    same([(r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got], want)
    assert {r.verdict for r in got} == {"allow", "block"}


def test_mined_url_rules(spark):
    bad = [(i, f"http://s{i}.spam.org/win/{i}?id={i}") for i in range(40)]
    good = [(100 + i, f"http://s{i}.fine.org/win/{i}") for i in range(60)]
    pages = spark.createDataFrame(bad + good + [(500, "http://new.spam.org/win/9?id=1")],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 0) for i, _ in bad] + [(i, 1, 0) for i, _ in good],
                                   "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judge_urls(pages, labels).collect()}
    assert got[500] == "block" and all(got[i] == "block" for i, _ in bad)
    assert all(got[i] == "allow" for i, _ in good)


def test_empty_tables(spark, empty, scratch):
    items = spark.createDataFrame([], "item_id long, text string")
    assert simhash.simhash_report(empty).count() == 0
    assert decontaminate.contamination_report(empty, items).count() == 0
    assert substring_dedup.substring_report(empty).count() == 0
    assert quality_rules.quality_report(empty).count() == 0
    assert licenses.license_report(empty).count() == 0
    assert pii.pii_report(empty).count() == 0
    assert secrets_crf.secret_report(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert warc.warc_report(pages, scratch).count() == 0
    assert url_rules.judge_urls(pages, labels).count() == 0


def test_no_items(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(docs, items).where("contaminated").count() == 0
