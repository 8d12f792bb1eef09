"""Substring removal with FM-indexes over shards of passages.

A window is ``WINDOW`` consecutive words of a document; a window that also
starts in a document with a smaller doc_id is removed there.

1. Each text is cut at anchors: every window takes the smallest of its k-gram
   hashes, and neighbouring windows with the same anchor form one passage.  Equal
   windows have equal anchors, so they meet under the anchor's hash; anchors of one
   text only are dropped.  Copies of a whole text count once, under their smallest
   doc_id.
2. Passages of shared anchors are reduced to the distinct ones with their smallest
   doc_id and dealt by anchor into shards of bounded size.  An anchor of more than
   ``HOT_TEXTS`` texts is dealt by whole windows instead, so no group is unbounded.
3. Each shard builds an FM-index (wavelet tree over the Burrows-Wheeler transform
   of its words); all its passages are streamed through backward search at once,
   which gives for each window the smallest doc_id holding it.
4. Windows found under a smaller doc_id are cut out of the texts that hold them.

Words are compared as text inside the shards; hashes only decide who meets (64
bits) and which passages and texts are equal (128 bits).

Defined cases: null text has no words; texts of fewer than ``WINDOW`` words lose
nothing; windows within one document, or in rows with the same doc_id, are no
reason for removal; rows with a null doc_id lose nothing and remove nothing; rows
repeated whole get the same result; other columns do not matter; an empty table
gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.llm.fm_index import FMIndex
from weekmart.llm.storage import stored

WINDOW = 50
GRAM = 8                # words of an anchor
HOT_TEXTS = 2000        # texts of one anchor before it is dealt by windows
SHARD_PASSAGES = 20_000
SEEDS = (42, 43)        # the first as in Spark's xxhash64
EMPTY = hashlib.sha256(b"").hexdigest()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(anchor hash, first window, windows) of each passage of a text."""
    n = len(hashes) - window + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        return e, e, e
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for j in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j:len(hashes) - gram + 1 + j]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    view = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    place = np.arange(n) + view.argmin(axis=1)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return grams[place[first]].view(np.int64), first, np.diff(np.append(first, n))


def scan_texts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, two text hashes, words, hash of all words, passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            rows = []
            for text in batch.column(1):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = body.split()
                m, first, count = anchors(word_hashes(words))
                rows.append((*(_signed(xxhash.xxh64_intdigest(body, s)) for s in SEEDS), len(words),
                             hashlib.sha256(b" ".join(words)).hexdigest(), m, first, count))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()),
                     pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                names=["doc_id", "t1", "t2", "n_words", "all_sha256", "anchor", "first", "count"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, t1 bigint, t2 bigint, n_words bigint, "
                                  "all_sha256 string, anchor array<bigint>, first array<int>, "
                                  "count array<int>")


def distinct_texts(scanned: DataFrame) -> DataFrame:
    """(t1, t2, doc, runs): each text that has windows, under its smallest doc_id."""
    runs = F.arrays_zip("anchor", "first", "count")
    return scanned.where("n_words >= %d and doc_id is not null" % WINDOW) \
        .groupBy("t1", "t2").agg(F.min("doc_id").alias("doc"), F.first(runs).alias("runs"))


def shared_runs(texts: DataFrame) -> DataFrame:
    """(t1, t2, doc, runs): the passages whose anchor stands in several texts;
    each run is (anchor, first, count, hot)."""
    rows = texts.select("t1", "t2", "doc", F.explode("runs").alias("r"))
    rows = rows.select("t1", "t2", "doc", "r.anchor", "r.first", "r.count")
    shared = rows.groupBy("anchor").agg(F.min("t1").alias("a"), F.max("t1").alias("b"),
                                        F.count("*").alias("c")) \
        .where("a < b").select("anchor", (F.col("c") > HOT_TEXTS).alias("hot"))
    # Read back from storage, so that the join's sides are plain exchanges and a
    # common anchor's rows can be split over tasks.
    shared = stored(shared)
    return rows.join(shared, "anchor").groupBy("t1", "t2", "doc").agg(
        F.collect_list(F.struct("anchor", "first", "count", "hot")).alias("runs"))


def candidates(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``runs`` with the text, one row per distinct text."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("d_id"),
                    F.xxhash64("text").alias("d_hash"), "text").where("text is not null")
    return runs.join(d, (F.col("doc") == F.col("d_id")) & (F.col("t1") == F.col("d_hash"))) \
        .dropDuplicates(["doc", "t1"]).select("t1", "t2", "doc", "runs",
                                              F.col("text").cast("binary").alias("text"))


def passages(cand: DataFrame, bodies: bool) -> DataFrame:
    """One row per passage: its key (anchor, c1, c2), document and, if asked
    for, its words; a hot anchor's passage comes window by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def flush(rows):
            cols = list(zip(*rows))
            kinds = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()] * bodies
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(cols, kinds)],
                names=["anchor", "c1", "c2", "t1", "t2", "doc", "first", "count", "body"][:len(kinds)])

        for batch in batches:
            rows, size = [], 0
            for t1, t2, doc, runs, text in zip(*(batch.column(i) for i in range(5))):
                words = text.as_buffer().to_pybytes().split()
                t1, t2, doc = t1.as_py(), t2.as_py(), doc.as_py()
                for r in runs.as_py():
                    a, n = r["first"], r["count"]
                    pieces = [(a, n)] if not r["hot"] else [(a + j, 1) for j in range(n)]
                    for at, count in pieces:
                        body = b" ".join(words[at:at + count + WINDOW - 1])
                        c1, c2 = (_signed(xxhash.xxh64_intdigest(body, s)) for s in SEEDS)
                        key = r["anchor"] if not r["hot"] else c1
                        rows.append((key, c1, c2, t1, t2, doc, at, count)
                                    + ((body,) if bodies else ()))
                        size += len(body)
                    if size > 1 << 23:
                        yield flush(rows)
                        rows, size = [], 0
            if rows:
                yield flush(rows)

    kind = "anchor bigint, c1 bigint, c2 bigint, t1 bigint, t2 bigint, doc bigint, first int, count int"
    return cand.select("t1", "t2", "doc", "runs", "text").mapInArrow(
        run, kind + (", body binary" if bodies else ""))


def search_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """FM-index of a shard's passages, and for each passage a bit per window
    that occurs under a smaller doc_id than the passage's own."""
    number: dict[bytes, int] = {}
    seqs = []
    for body in rows["body"]:
        words = body.split(b" ")
        seqs.append(np.fromiter((number.setdefault(w, len(number) + 1) for w in words),
                                np.int64, len(words)))
    docs = rows["doc"].to_numpy(np.int64)
    least = FMIndex(seqs, docs, WINDOW).matches(seqs)
    masks = [sum(1 << j for j in np.flatnonzero(x < d).tolist()) for x, d in zip(least, docs.tolist())]
    out = rows[["anchor", "c1", "c2", "doc"]].copy()
    out["mask"] = np.array(masks, np.int64)
    return out


def duplicated_windows(cand: DataFrame) -> DataFrame:
    """(t1, t2, cuts): windows to remove, as structs (first, count, mask)."""
    distinct = stored(passages(cand, True).groupBy("anchor", "c1", "c2").agg(
        F.min("doc").alias("doc"), F.first("body").alias("body")))
    shards = max(1, -(-distinct.count() // SHARD_PASSAGES))
    found = distinct.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")) \
        .applyInPandas(lambda rows: search_shard(rows),
                       "anchor bigint, c1 bigint, c2 bigint, doc bigint, mask bigint") \
        .withColumnRenamed("doc", "least")
    # The first holder of a passage loses the marked windows, later ones all.
    whole = F.expr("shiftleft(1L, count) - 1")
    hits = passages(cand, False).join(found, ["anchor", "c1", "c2"]).select(
        "t1", "t2", "first", "count",
        F.when(F.col("doc") > F.col("least"), whole).otherwise(F.col("mask")).alias("mask"))
    return hits.where("mask <> 0").groupBy("t1", "t2").agg(
        F.collect_list(F.struct("first", "count", "mask")).alias("cuts"))


def cut_texts(cand: DataFrame, cuts: DataFrame) -> DataFrame:
    """(t1, t2, n_removed, kept, kept_sha256) of the texts that lose words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, sha = [], [], []
            for text, cuts in zip(batch.column(2), batch.column(3)):
                words = text.as_buffer().to_pybytes().split()
                edge = np.zeros(len(words) + 1, np.int64)
                for c in cuts.as_py():
                    for j in range(c["count"]):
                        if c["mask"] >> j & 1:
                            edge[c["first"] + j] += 1
                            edge[c["first"] + j + WINDOW] -= 1
                keep = np.cumsum(edge)[:-1] == 0
                rest = b" ".join(w for w, k in zip(words, keep.tolist()) if k)
                removed.append(int((~keep).sum()))
                kept.append(rest.decode())
                sha.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(sha, pa.string())],
                names=["t1", "t2", "n_removed", "kept", "kept_sha256"])

    return cand.select("t1", "t2", "text").join(cuts, ["t1", "t2"]).mapInArrow(
        run, "t1 bigint, t2 bigint, n_removed bigint, kept string, kept_sha256 string")


def substring_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, removed words and the hash of the rest."""
    scanned = stored(scan_texts(docs))
    texts = stored(distinct_texts(scanned))
    cand = stored(candidates(docs, shared_runs(texts)))
    cut = cut_texts(cand, duplicated_windows(cand)).drop("kept")
    rows = scanned.select("doc_id", "t1", "t2", "n_words", "all_sha256") \
        .join(texts.select("t1", "t2", "doc"), ["t1", "t2"], "left") \
        .join(cut, ["t1", "t2"], "left")
    copy = F.col("doc") < F.col("doc_id")
    own = (F.col("doc") == F.col("doc_id")) & F.col("n_removed").isNotNull()
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(own, F.col("n_removed")).otherwise(zero).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).when(own, F.col("kept_sha256")).otherwise(F.col("all_sha256"))
        .alias("kept_sha256"))
