"""Token ids of documents in Re-Pair compressed shards, in ascending doc_id order.

1. Documents are range-partitioned and sorted by doc_id (equal ids by text hash,
   equal rows dealt freely, so that a repeated id does not fill one task).
2. Each task turns its texts into ids, an end id after each document, and closes a
   shard at ``SHARD_IDS`` ids.  A shard is one grammar (``pair_grammar``): frequent
   pairs of ids become rules, and rules keep their expansion lengths.
3. Shards are rows (part, number, n_docs, n_ids, body) of a Parquet folder, written
   by Spark's committer; ``body`` holds the shard's own byte format and its checksum.
4. Readers decode whole shards, or single documents by random access.

Texts are cut where the tokenizer's own splitting always has a border, each new
piece is encoded once by the tokenizers library, and the pieces' ids are put
together; ``tests/llm`` compares this with encoding whole texts.  Pieces of a blank
and letters are one word of that splitting and reach the library's model without it.
A tokenizer that does not split that way encodes whole texts.

Defined cases: a null text is empty (its ids are the end id alone); rows repeated
or with equal doc_ids each have their own place; rows with a null doc_id come first;
other columns do not matter; an empty table gives an empty archive; a shard is never
cut inside a document, so a very long text makes a shard of its own size.
"""

from __future__ import annotations

import json
import os
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmart.llm.pair_grammar import Shard, encode_shard

SHARD_IDS = 1 << 20
SLICE_BYTES = 8 << 20   # text turned into ids at once
JOINED = 200            # words encoded as one string
KNOWN = 1_000_000       # pieces whose ids a worker keeps; beyond, those that came up once are forgotten
LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHARDS = "part int, number int, n_docs bigint, n_ids bigint, body binary"


def splits_at_words(config: dict) -> bool:
    """Whether the tokenizer is byte-level BPE whose splitting has a border before
    each blank that follows a visible character, and after each run of letters."""
    pre, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and config.get("normalizer") is None
            and config.get("truncation") is None and model.get("type") == "BPE"
            and not model.get("dropout"))


def accents(data: np.ndarray) -> np.ndarray:
    """Where second bytes of the letters U+00C0..U+00FF stand (without U+00D7 and U+00F7)."""
    out = np.zeros(len(data), bool)
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    out[after] = (data[after] != 0x97) & (data[after] != 0xB7)
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in the UTF-8 bytes where texts start or are safely cut."""
    kind = np.zeros(256, np.uint8)      # bits: 1 letter, 2 visible, 4 blank, 8 digit or mark
    kind[33:127] = 10
    kind[list(LETTERS)] = 3
    kind[list(b" \n")] = 4
    k = kind[data]
    k[accents(data)] = 3
    cut = np.zeros(len(data) + 1, bool)
    # Blanks after something visible, digits and marks after a letter.
    cut[1:-1] = (k[1:] & (k[:-1] << 1) & 4 | k[1:] & (k[:-1] << 3) & 8) > 0
    cut[offsets] = True
    return np.flatnonzero(cut)


def byte_signs() -> np.ndarray:
    """The character (UTF-16) for which a byte stands in a byte-level vocabulary."""
    signs = np.arange(256, dtype="<u2")
    hidden = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173)]
    signs[hidden] = 256 + np.arange(len(hidden))
    return signs


def layout(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of each text and the end, and the bytes they point into."""
    offsets = np.zeros(1, np.int64) if texts.buffers()[1] is None else \
        np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


class Encoder:
    """Ids of many texts at once with a tokenizer of the tokenizers library."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(config)
        parsed = json.loads(config)
        self.added = [t["content"].encode() for t in parsed.get("added_tokens") or []]
        self.by_pieces = splits_at_words(parsed)
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known: dict[bytes, int] = {}
        self.ids, self.count, self.uses = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        if self.by_pieces:
            parsed |= {"added_tokens": [], "post_processor": None, "pre_tokenizer": {
                "type": "Split", "pattern": {"String": chr(byte_signs()[32])},
                "behavior": "MergedWithNext", "invert": False}}
            self.words = Tokenizer.from_str(json.dumps(parsed))
            self.width = np.zeros(self.base, np.int64)     # bytes of an id's text
            for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
                self.width[number] = len(token)

    def plain(self, texts: list[str], step: int, tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of texts, ``step`` at a time: the library's results
        take far more memory than the ids."""
        ids, sizes = [np.zeros(0, np.int32)], []
        for i in range(0, len(texts), step):
            for e in (tokenizer or self.tokenizer).encode_batch_fast(
                    texts[i:i + step], add_special_tokens=False):
                ids.append(np.array(e.ids, np.int32))
                sizes.append(len(ids[-1]))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def pieces(self, texts: pa.LargeBinaryArray) -> np.ndarray:
        """The numbers of distinct pieces in ``known``; new ones are encoded."""
        if len(self.known) > KNOWN:
            self.forget(np.flatnonzero(self.uses > 1)[:KNOWN // 2])
        names = texts.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        is_new = number < 0
        if is_new.any():
            number[is_new] = len(self.known) + np.arange(np.count_nonzero(is_new))
            self.known.update(zip(names[is_new], number[is_new].tolist()))
            ids, sizes = self.encode_pieces(texts.filter(pa.array(is_new)))
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, sizes])
            self.uses = np.append(self.uses, np.zeros(len(sizes), np.int32))
        self.uses[number] += 1
        return number

    def encode_pieces(self, texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids).  A blank and letters are one word of the tokenizer's
        splitting: many are joined and split at the blanks alone; each word's ids are
        found again by the bytes they stand for."""
        offsets, data = layout(texts)
        offsets, data = offsets - offsets[0], data[offsets[0]:offsets[-1]]
        letter = np.zeros(256, bool)
        letter[list(LETTERS)] = True
        letter, second = letter[data], accents(data)
        letter |= second
        letter[:-1] |= second[1:]
        word = (data[offsets[:-1]] == 32) & (np.diff(offsets) > 1) & \
            (np.add.reduceat(~letter, offsets[:-1], dtype=np.int64) == 1)
        ends = np.cumsum(np.diff(offsets)[word])
        body = byte_signs()[data[np.repeat(word, np.diff(offsets))]]
        at = np.append(np.append(0, ends)[:-1:JOINED], len(body)).tolist()
        flat, _ = self.plain([body[i:j].tobytes().decode("utf-16-le") for i, j in zip(at, at[1:])], 32, self.words)
        sizes = np.zeros(len(texts), np.int64)
        sizes[word] = np.diff(np.searchsorted(np.cumsum(self.width[flat]), ends) + 1, prepend=0)
        others = texts.filter(pa.array(~word)).cast(pa.large_string()).to_pylist()
        rest, sizes[~word] = self.plain(others, 2000)
        ids = np.empty(int(sizes.sum()), np.int32)
        of_word = np.repeat(word, sizes)
        ids[of_word], ids[~of_word] = flat, rest
        return ids, sizes

    def forget(self, kept: np.ndarray) -> None:
        """Forget all pieces but those with the numbers ``kept``: pieces that came up
        more than once are likely to come again."""
        names = list(self.known)
        self.known = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.ids = Coded(self.ids, self.count, kept, np.array([0, len(kept)])).texts(0, 1)
        self.count, self.uses = self.count[kept], np.zeros(len(kept), np.int32)

    def __call__(self, texts: pa.LargeBinaryArray) -> "Coded":
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw, base = texts.buffers()[2], int(offsets[0])
        data = np.frombuffer(raw, np.uint8)[base:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        whole = not self.by_pieces
        if self.added and not whole:
            body = data.tobytes()
            whole = any(a in body for a in self.added)
        if whole or not len(data):
            ids, sizes = self.plain([t.as_py().decode() for t in texts], 32)
            return Coded(ids, sizes, np.arange(len(texts)), np.arange(len(texts) + 1))
        at = cuts(data, offsets - base).astype(np.int64)
        at += base
        coded = pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                      [None, pa.py_buffer(at), raw]).dictionary_encode()
        number = self.pieces(coded.dictionary)
        return Coded(self.ids, self.count, number[coded.indices.to_numpy(zero_copy_only=False)],
                     np.searchsorted(at, offsets))


def encoder_of(config: str) -> Encoder:
    """The worker process's encoder for a tokenizer.  It lives in ``sys.modules``, as
    functions that travel by value share no globals from task to task."""
    # Tasks share the cores already: the library's own threads would only add to them.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    kept = sys.modules.setdefault("weekmart_worker_state", types.ModuleType("weekmart_worker_state"))
    if getattr(kept, "config", None) != config:
        kept.config, kept.encoder = config, Encoder(config)
    return kept.encoder


def slices(texts: pa.LargeBinaryArray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` together."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last
        first = last


class Coded:
    """Texts as numbers of pieces; ids are put together a few texts at a time."""

    def __init__(self, ids, sizes, pieces, bounds):
        """``ids`` and ``sizes`` of the pieces; text t holds ``pieces[bounds[t]:bounds[t + 1]]``."""
        self.ids, self.count, self.pieces, self.bounds = ids, sizes, pieces, bounds
        self.start = np.cumsum(sizes) - sizes
        total = np.concatenate([[0], np.cumsum(sizes[pieces])])
        self.sizes = np.diff(total[bounds])              # ids of each text

    def texts(self, first: int, last: int) -> np.ndarray:
        which = self.pieces[self.bounds[first]:self.bounds[last]]
        count = self.count[which]
        source = np.repeat(self.start[which] - (np.cumsum(count) - count), count)
        source += np.arange(len(source))
        return self.ids[source]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """``ids`` with ``end_id`` after each document."""
    out = np.full(len(ids) + len(sizes), end_id, np.int32)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    out[inside] = ids
    return out


def encode_shards(docs: DataFrame, config: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """The shards of ``docs`` as rows; (part, number) gives their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, part, number = None, TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        sizes, parts, held = [], [], 0

        def shard():
            ids = np.concatenate(parts)
            body = encode_shard(names, np.concatenate(sizes), ids, max(encoder.base, end_id + 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([len(names)], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([body], pa.binary())], names=["part", "number", "n_docs", "n_ids", "body"])

        for batch in batches:
            if not batch.num_rows:
                continue
            encoder = encoder or encoder_of(config)
            texts, owners = batch.column(1).cast(pa.large_binary()), batch.column(0).to_pylist()
            for begin, end in slices(texts):
                coded = encoder(texts.slice(begin, end - begin))
                n, first = coded.sizes + 1, 0
                ends = np.cumsum(n)
                while first < len(n):
                    before = int(ends[first - 1]) if first else 0
                    # Up to the document that fills the shard.
                    last = int(np.searchsorted(ends, before + max(shard_ids - held, 1))) + 1
                    last = min(last, len(n))
                    names += owners[begin + first:begin + last]
                    sizes.append(n[first:last])
                    parts.append(with_end(coded.texts(first, last), coded.sizes[first:last], end_id))
                    held += len(parts[-1])
                    first = last
                    if held >= shard_ids:
                        yield shard()
                        names, sizes, parts, held, number = [], [], [], 0, number + 1
        if names:
            yield shard()

    ordered = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .select("doc_id", F.col("text").cast("binary").alias("text"),
                F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")) \
        .repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(run, SHARDS)


def write_archive(docs: DataFrame, path: str, tokenizer_file: str, end_id: int,
                  shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` into the archive folder ``path``.  The tokenizer's file is
    read here and travels with the tasks."""
    with open(tokenizer_file, encoding="utf-8") as f:
        config = f.read()
    encode_shards(docs, config, end_id, shard_ids).write.parquet(f"{path}/shards")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, number, first): how many ids stand before each shard.  Sums run inside
    a part; only the parts' totals, one a task of the writer, are added up in one place."""
    sizes = spark.read.schema(SHARDS).parquet(f"{path}/shards").select("part", "number", "n_ids")
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    offsets = totals.select("part", F.coalesce(
        F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("long")).alias("offset"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(offsets, "part").select(
        "part", "number",
        (F.col("offset") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0).cast("long"))).alias("first"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(part, number, place, doc_id, inside, n_tokens, ids_crc32, ids): each document
    of the archive, ``inside`` ids after its shard's start; the checksum is over its
    ids as little-endian 32-bit integers."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    columns = ["part", "number", "place", "doc_id", "inside", "n_tokens", "ids_crc32"]
    slab = 1 << 22                       # ids in one batch of rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, body in zip(*(batch.column(i) for i in range(3))):
                s = Shard(body.as_buffer())
                ids = s.ids().astype("<u4")
                n, raw = len(s.sizes), memoryview(ids).cast("B")
                ends = s.offsets + s.sizes
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(s.offsets.tolist(), ends.tolist())]
                cols = [np.full(n, part.as_py()), np.full(n, number.as_py()), np.arange(n), None,
                        s.offsets, s.sizes, np.array(crc, np.int64)]
                cols = [pa.array(s.doc_ids, k, mask=s.has_id == 0) if c is None else pa.array(c, k)
                        for c, k in zip(cols, kinds)]
                if not with_ids:
                    yield pa.RecordBatch.from_arrays(cols, names=columns)
                    continue
                first = 0
                while first < n:
                    last = max(first + 1, int(np.searchsorted(ends, s.offsets[first] + slab, "right")))
                    bounds = np.append(s.offsets[first:last], ends[last - 1]) - s.offsets[first]
                    lists = pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()),
                        pa.array(ids[s.offsets[first]:ends[last - 1]], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [c.slice(first, last - first) for c in cols] + [lists], names=columns + ["ids"])
                    first = last

    kind = "part int, number int, place int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    return spark.read.schema(SHARDS).parquet(f"{path}/shards").select("part", "number", "body").mapInArrow(
        run, kind + (", ids array<bigint>" if with_ids else ""))


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents named in ``wanted``: each is read by random
    access, without decoding its shard.  Repeated rows of ``wanted`` count once."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, body in zip(*(batch.column(i) for i in range(3))):
                s = Shard(body.as_buffer())
                n = len(s.sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part.as_py()), pa.int32()),
                     pa.array(np.full(n, number.as_py()), pa.int32()),
                     pa.array(np.arange(n), pa.int32()),
                     pa.array(s.doc_ids, pa.int64(), mask=s.has_id == 0)],
                    names=["part", "number", "place", "doc_id"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = Shard(body.as_buffer())
                for k in places:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(s.doc_ids[k]) if s.has_id[k] else None], pa.int64()),
                         pa.array([s.document(k).tolist()], pa.list_(pa.int64()))],
                        names=["doc_id", "ids"])

    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards").select("part", "number", "body")
    names = wanted.select(F.col("doc_id").cast("bigint").alias("w")).distinct()
    places = shards.mapInArrow(index, "part int, number int, place int, doc_id bigint") \
        .join(names, F.col("doc_id").eqNullSafe(F.col("w")), "left_semi") \
        .groupBy("part", "number").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return shards.join(places, ["part", "number"]).select("places", "body") \
        .mapInArrow(read, "doc_id bigint, ids array<bigint>")


def token_report(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> DataFrame:
    """Write the archive of ``docs`` to ``path`` and report what is read back."""
    spark = docs.sparkSession
    write_archive(docs, path, tokenizer_file, end_id)
    found = read_documents(spark, path, with_ids=False)
    return found.join(shard_starts(spark, path), ["part", "number"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
