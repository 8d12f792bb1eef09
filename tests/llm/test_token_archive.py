"""Token archive: exact round trips against the tokenizer itself."""

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weekmart.llm import pair_grammar as G
from weekmart.llm import token_archive as A
from weekmart.session import scratch_dir

FILE = public_tokenizers.path("byte_bpe_50k.json")
END = 2


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    return A.Encoder(open(FILE, encoding="utf-8").read())


def ids_of(encoder, texts):
    coded = encoder(pa.array([t.encode() for t in texts], pa.large_binary()))
    ids, ends = coded.texts(0, len(texts)), np.cumsum(coded.sizes)
    return [ids[e - n:e].tolist() for e, n in zip(ends.tolist(), coded.sizes.tolist())]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Zé'.,\n\t  　​9-!😀ñ\x1c\u0085s"), max_size=30), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    t = Tokenizer.from_file(FILE) if not hasattr(test_pieces_give_the_ids_of_whole_texts, "t") \
        else test_pieces_give_the_ids_of_whole_texts.t
    test_pieces_give_the_ids_of_whole_texts.t = t
    e = getattr(test_pieces_give_the_ids_of_whole_texts, "e", None) or A.Encoder(open(FILE, encoding="utf-8").read())
    test_pieces_give_the_ids_of_whole_texts.e = e
    assert ids_of(e, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_added_tokens_and_forgotten_pieces(encoder, tokenizer, monkeypatch):
    texts = ["a <|endoftext|> b", "plain text", "plain text again"]
    want = [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert ids_of(encoder, texts) == want
    monkeypatch.setattr(A, "KNOWN", 1)
    assert ids_of(encoder, texts[1:]) == want[1:] and ids_of(encoder, texts[1:]) == want[1:]


@pytest.mark.parametrize("file", ["word_bpe_49k.json"])
def test_other_tokenizers_encode_whole_texts(file):
    config = open(public_tokenizers.path(file), encoding="utf-8").read()
    e, t = A.Encoder(config), Tokenizer.from_str(config)
    assert not e.by_pieces
    texts = ["Some Words, here", "", "more"]
    assert ids_of(e, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_a_shard_gives_back_its_ids(ids, start, count):
    ids = np.array(ids * 3, np.int64)
    s = G.Shard(G.encode_shard([7, None], np.array([0, len(ids)]), ids, 7))
    assert s.ids().tolist() == ids.tolist() == s.document(1).tolist()
    start = min(start, len(ids))
    count = min(count, len(ids) - start)
    assert s.read(start, count).tolist() == ids[start:start + count].tolist()


def test_frequent_pairs_become_rules():
    rng = np.random.default_rng(5)
    phrases = [rng.integers(0, 1000, 12) for _ in range(50)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 50, 2000)])
    symbols, rules = G.compress(ids, 1000)
    assert len(symbols) < len(ids) / 6
    assert (G.expand(symbols, rules, 1000) == ids).all()
    span = G.lengths(rules, 1000)
    assert span.tolist() == [len(G.expand(np.array([1000 + r]), rules, 1000)) for r in range(len(rules))]


def test_damaged_bytes_raise():
    body = bytearray(G.encode_shard([1], np.array([4]), np.array([1, 2, 1, 2]), 7))
    body[-1] ^= 1
    with pytest.raises(ValueError):
        G.Shard(bytes(body))


def test_archive_against_the_tokenizer(spark, docs, tokenizer):
    path = scratch_dir(spark, "tokens")
    d = docs.withColumn("part", F.lit("x")).withColumn("tie", F.lit(1)).withColumn("row", F.lit(2))
    A.write_archive(d, path, FILE, END, shard_ids=5000)
    got = A.read_documents(spark, path).join(A.shard_starts(spark, path), ["part", "number"]) \
        .select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids") \
        .orderBy("start").collect()
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    want = {}
    for k, text in rows:
        want.setdefault(k, []).append(tokenizer.encode(text, add_special_tokens=False).ids + [END])
    assert [r.doc_id for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        want[r.doc_id].remove(r.ids)
        at += r.n_tokens
    assert not any(want.values())
    assert spark.read.parquet(f"{path}/shards").count() > 10
    some = docs.where("doc_id in (9005, 9023) or doc_id is null or doc_id = 3")
    fetched = {}
    for r in A.fetch(spark, path, some.unionByName(some)).collect():
        fetched.setdefault(r.doc_id, []).append(r.ids)
    for k in fetched:
        assert sorted(fetched[k]) == sorted(tokenizer.encode(t, add_special_tokens=False).ids + [END]
                                            for j, t in rows if j == k)
    assert set(fetched) == {None, 9005, 9023, 3}


def test_report_and_empty_table(spark, docs, empty):
    got = A.token_report(docs, scratch_dir(spark, "tokens"), FILE, END)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == docs.count()
    assert A.token_report(empty, scratch_dir(spark, "tokens"), FILE, END).count() == 0


def test_a_repeated_id_fills_many_tasks(spark, scratch):
    same = spark.range(4000).select(F.lit(5).alias("doc_id"), F.lit("one and the same text " * 50).alias("text"))
    rows = A.encode_shards(same, open(FILE, encoding="utf-8").read(), END, 20_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert rows.select("part").distinct().count() > 4
        assert rows.agg(F.sum("n_docs")).first()[0] == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_new_pieces_are_encoded_without_positions(tokenizer):
    """The library's plain encode_batch also makes offsets, which nothing reads."""
    class IdsOnly:
        encode_batch_fast = staticmethod(tokenizer.encode_batch_fast)

    e = A.Encoder(open(FILE, encoding="utf-8").read())
    e.tokenizer = IdsOnly()
    for texts in ([" only easy pieces" * 300], ["été", "12", "ñ"], ["", ""], ["Both é here\n and 1-2 there"]):
        assert ids_of(e, texts) == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_reach_the_model_without_the_splitting(tokenizer):
    """A blank and letters are one word; the tokenizer's own splitting is not run for them."""
    class Never:
        def encode_batch_fast(self, *texts, **options):
            raise AssertionError(texts)

    e = A.Encoder(open(FILE, encoding="utf-8").read())
    ids_of(e, ["###", ",", "12."])                 # the other pieces of the text below
    e.tokenizer = Never()
    text = " plain words été Ünïcode ÿ" + " many words" * 300 + " word### été, word12."
    assert ids_of(e, [text]) == [tokenizer.encode(text, add_special_tokens=False).ids]


def test_pieces_that_came_up_again_are_kept(monkeypatch, tokenizer):
    e = A.Encoder(open(FILE, encoding="utf-8").read())
    for text in (" common once", " common other"):
        ids_of(e, [text])
    monkeypatch.setattr(A, "KNOWN", 2)
    texts = [" common third words", " common"]
    assert ids_of(e, texts) == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert b" common" in e.known and b" once" not in e.known


def test_tasks_encode_without_the_librarys_threads(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    monkeypatch.delenv("TOKENIZERS_PARALLELISM")
    A.encoder_of(open(FILE, encoding="utf-8").read())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZéÿ×÷Ã '%#|0½\nĀñ́s"), max_size=30), max_size=6))
def test_cuts_at_accents_marks_and_digits(texts):
    t = Tokenizer.from_file(FILE) if not hasattr(test_cuts_at_accents_marks_and_digits, "t") \
        else test_cuts_at_accents_marks_and_digits.t
    test_cuts_at_accents_marks_and_digits.t = t
    e = getattr(test_cuts_at_accents_marks_and_digits, "e", None) or A.Encoder(open(FILE, encoding="utf-8").read())
    test_cuts_at_accents_marks_and_digits.e = e
    assert ids_of(e, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("bits", [1, 7, 8, 17, 25, 31, 32])
def test_symbols_are_read_without_single_bits(monkeypatch, bits):
    """Eight symbols are whole bytes; one array cell for each bit is not needed."""
    values = np.random.default_rng(bits).integers(0, 1 << bits, 1001)
    raw, none = (np.frombuffer(G._pack(v, bits), np.uint8) for v in (values, values[:0]))
    monkeypatch.delattr(np, "unpackbits")
    assert G._unpack(raw, bits, 0, 1001).tolist() == values.tolist()
    assert G._unpack(raw, bits, 64, 130).tolist() == values[64:194].tolist()
    assert len(G._unpack(none, bits, 0, 0)) == 0
