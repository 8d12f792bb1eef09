"""SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint has a bit set where over half of its word-shingle
hashes (XXH64, seed 42) have it.  Fingerprints within ``max_bits`` differing
bits are linked, and linked documents form a component.

Links are found without comparing all pairs.  The 64 bits are cut into
``max_bits // 2 + 1`` segments, so in a linked pair at least one segment differs
by at most one bit.  Every distinct fingerprint is indexed under each segment as
it is and under each one-wildcard variant of it (one bit deleted); variants with
a 0 at the wildcard meet those with a 1 in an equality join, and each candidate
is verified by its exact bit distance.  A bucket with more than ``HOT_BUCKET``
fingerprints is cut again: within it the bits outside the segment must be close
too, so its members are indexed by variants of those bits in the same way.

Copies with one fingerprint are collapsed before the search, so thousands of
equal texts cost one row.  Components come from alternating star contraction over
checkpointed link tables; nothing is collected.

Defined cases: null or empty text (no words) has fingerprint zero and links like
any other; a text shorter than the shingle is one shingle; repeated rows are kept
and share a component; a null doc_id is never a component id unless its whole
component is null; further columns do not matter; an empty table gives none.
``first_of_each`` keeps one row of each component, whatever ids its rows have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from weekmart.llm.storage import stored
from weekmart.llm.text import by_shuffle, free_name

SEED = 42
BITS = 64
HOT_BUCKET = 64
CHUNK = 1 << 15  # shingles unpacked at once


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of UTF-8 text (unsigned)."""
    import xxhash

    # bytes.lower() changes A-Z only; bytes.split() cuts at space and \t..\r.
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        to = min(at + CHUNK, n)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1:to + width - 1].tolist())
        hashes = np.fromiter((digest(body[s:e], SEED) for s, e in spans), np.uint64, to - at)
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS) \
            .sum(0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, **hashes: Column) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` holds the 64 bits as a signed long.
    ``hashes`` are further long columns to compute beside them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle)
                            for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=names)

    names = ["doc_id", "fp", *hashes]
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                         *[c.alias(n) for n, c in hashes.items()])
    return narrow.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{n} bigint" for n in names[1:]]]))


def segments(bits: list[int], max_bits: int) -> list[list[int]]:
    """The bit positions cut into ``max_bits // 2 + 1`` even runs."""
    parts = max_bits // 2 + 1
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def variants(fps: DataFrame, parts: list[list[int]]) -> DataFrame:
    """``fps`` exploded to its index rows: slot, masked bits and side.  Side 0
    and 1 hold a wildcard variant's deleted bit; exact segments go to both."""
    kinds = []
    for s, part in enumerate(parts):
        kinds.append((s * 100 + BITS, _mask(part), 0))
        kinds += [(s * 100 + b, _mask([x for x in part if x != b]), _mask([b])) for b in part]
    table = F.array(*[F.struct(F.lit(slot).alias("slot"), F.lit(keep).cast("bigint").alias("keep"),
                               F.lit(bit).cast("bigint").alias("bit")) for slot, keep, bit in kinds])
    rows = fps.select("*", F.explode(table).alias("k"))
    fp, bit = F.col("fp"), F.col("k.bit")
    side = F.when(bit != 0, F.when(fp.bitwiseAND(bit) != 0, 1).otherwise(0))
    return rows.select(*fps.columns, "k.slot", fp.bitwiseAND(F.col("k.keep")).alias("masked"),
                       side.alias("side"))


def _meet(index: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Verified links of members that share ``keys``."""
    a = index.where("side is null or side = 0").select(*keys, F.col("fp").alias("u"), "side")
    b = index.where("side is null or side = 1").select(*keys, F.col("fp").alias("v"))
    met = by_shuffle(a).join(by_shuffle(b), keys).where("side is not null or u < v")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    return met.where(near).select("u", "v")


def links(fps: DataFrame, max_bits: int = 3, hot: int = HOT_BUCKET) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints at most ``max_bits`` apart.  A pair
    may come more than once."""
    parts = segments(list(range(BITS)), max_bits)
    index = variants(fps, parts)
    if max_bits == 0:
        return index.where("false").select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    big = index.groupBy("slot", "masked").count().where(F.col("count") > hot) \
        .select("slot", "masked").transform(stored)
    plain = index.join(big, ["slot", "masked"], "left_anti")
    found = _meet(plain, ["slot", "masked"], max_bits)
    if not big.take(1):
        return found
    crowded = index.join(big, ["slot", "masked"], "left_semi").select(
        "fp", F.col("slot").alias("slot1"), F.col("masked").alias("masked1"),
        F.col("side").alias("side1"))
    for s, part in enumerate(parts):
        inside = crowded.where(F.floor(F.col("slot1") / 100) == s)
        others = [b for b in range(BITS) if b not in part]
        again = variants(inside, segments(others, max_bits))
        keys = ["slot1", "masked1", "slot", "masked"]
        a = again.where("(side1 is null or side1 = 0) and (side is null or side = 0)") \
            .select(*keys, F.col("fp").alias("u"))
        b = again.where("(side1 is null or side1 = 1) and (side is null or side = 1)") \
            .select(*keys, F.col("fp").alias("v"))
        # With a wildcard in the outer variant the sides differ already, so the
        # inner bit may be either way round.
        c = again.where("side1 = 0 and side = 1").select(*keys, F.col("fp").alias("u"))
        d = again.where("side1 = 1 and side = 0").select(*keys, F.col("fp").alias("v"))
        near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
        for left, right in ((a, b), (c, d)):
            found = found.unionByName(
                by_shuffle(left).join(by_shuffle(right), keys).where((F.col("u") != F.col("v")) & near).select("u", "v"))
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large and small stars
    until the link table no longer changes; root is the smallest node."""
    def stars(e: DataFrame, both: bool) -> DataFrame:
        pairs = e.select("u", "v")
        if both:
            pairs = pairs.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = pairs.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        met = pairs.join(low, "u")
        if both:
            out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = met.select(F.col("v").alias("u"), F.col("m").alias("v")) \
                .unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct() \
        .transform(stored)
    before = state(e)
    while True:
        e = stars(stars(e, True), False).transform(stored)
        now = state(e)
        if now == before:
            break
        before = now
    return e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes`` (one row per ``fp``) with the root of their component."""
    roots = components(links(nodes.select("fp"), max_bits))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        *nodes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    prints = stored(fingerprints(docs, shingle))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    labelled = _rooted(nodes, max_bits)
    ids = labelled.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_print = labelled.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _has_map(kind.elementType)


def row_hashes(docs: DataFrame) -> dict[str, Column]:
    """Hashes of a row's text and of its columns besides doc_id and text."""
    rest = [F.to_json(docs[f.name]) if _has_map(f.dataType) else docs[f.name]
            for f in docs.schema if f.name.lower() not in ("doc_id", "text")]
    return {"text_hash": F.xxhash64(docs["text"]),
            "rest_hash": F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")}


def first_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest doc_id (a
    null id only if the component has no other), among rows that share it the
    one with the smallest hashes.  Equal rows are one."""
    hashes = row_hashes(docs)
    key = ["doc_id", *hashes]
    prints = stored(fingerprints(docs, shingle, **hashes))
    copies = prints.groupBy("fp", *key).agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *key, "copies")).alias("first")
    nodes = stored(copies.groupBy("fp").agg(first))
    kept = stored(_rooted(nodes, max_bits).groupBy("root").agg(F.min("first").alias("first"))
                  .select(*[F.col(f"first.{c}").alias(f"kept_{c}") for c in (*key, "copies")]))

    def rows_of(keys: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(keys["kept_doc_id"])
        for name, value in hashes.items():
            same = same & (value == keys[f"kept_{name}"])
        return docs.join(keys, same, "left_semi")

    once = rows_of(kept.where("kept_copies = 1"))
    repeated = kept.where("kept_copies > 1")
    if not repeated.take(1):
        return once
    name = free_name(docs.columns, "row_key")
    one = rows_of(repeated).withColumn(name, F.struct(docs["doc_id"], *hashes.values())) \
        .dropDuplicates([name]).drop(name)
    return once.unionByName(one)
