"""Product codes of integer vectors: codebooks refined by rounds of nearest-entry
assignment, each search through a GNAT over the codebook's entries (``gnat``).

Rows are read from one stored table of usable vectors.  A round sends the codebooks
(``parts`` x ``entries`` x length / parts numbers, fixed by the parameters) with the
tasks, adds up sums and counts per entry inside them and again in Spark, and brings
only the new codebooks to the driver.  Rounds stop early when nothing moves any more,
as all further ones would give the same.

Defined cases: rows with a null vector, or null, NaN or infinite components, are
dropped.  So are vectors that have no components, whose length the parts do not divide,
or whose length is not the table's most frequent one (ties: the longer).  Fewer rows
than entries give smaller codebooks.  First entries come from the smallest vec_ids, equal
ids by their components; rows with a null vec_id are coded but never first entries.
Repeated rows are coded alike.  Components too large for 64-bit distances are computed in exact
big integers; an error beyond 64 bits is null.  Equal labels (nulls together) share a label_error.
Other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.llm.gnat import Gnat
from weekmart.llm.storage import stored

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
LONG = 1 << 63


def usable(vectors: DataFrame, parts: int) -> DataFrame:
    """(vec_id, label, v): rows with finite vectors of the table's length."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", v.alias("v")) \
        .where(F.col("v").isNotNull() & ~bad & (F.size("v") > 0) & (F.size("v") % parts == 0))
    rows = stored(rows)
    length = rows.groupBy(F.size("v").alias("n")).count() \
        .orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (length[0].n if length else 0))


def to_integers(v: np.ndarray) -> np.ndarray:
    """floor(4096 * x) of each component, exact; 64-bit where distances fit."""
    scaled = np.floor(v * SCALE)
    if len(v) == 0 or np.abs(scaled).max(initial=0) < 2 ** 28:
        return scaled.astype(np.int64)
    return np.array([[math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE for x in row]
                     for row in v.tolist()], object).reshape(v.shape)


def _batches(batch: pa.RecordBatch, column: int) -> np.ndarray:
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return to_integers(flat.reshape(len(lists), -1))


class Codec:
    """The codebooks as one GNAT a part."""

    def __init__(self, books: list[list[list[int]]]):
        self.books = books
        big = max((abs(x) for b in books for e in b for x in e), default=0) >= 2 ** 28
        self.wide = big
        self.trees = [Gnat(np.array(b, object if big else np.int64)) for b in books]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry of each part, squared distance of each part), a row a vector."""
        if vectors.dtype == object and not self.wide:
            trees = [Gnat(t.entries.astype(object)) for t in self.trees]
        else:
            trees = self.trees
            vectors = vectors.astype(object) if self.wide else vectors
        found = [t.nearest(p) for t, p in zip(trees, np.split(vectors, len(trees), axis=1))]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def part_sums(rows: DataFrame, books: list) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> (rows assigned, componentwise sums)."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, total = Codec(books), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _batches(batch, 0)
            codes, _ = codec.assign(vectors)
            for p, piece in enumerate(np.split(vectors, parts, axis=1)):
                for e in np.unique(codes[:, p]).tolist():
                    chosen = piece[codes[:, p] == e]
                    count, sums = total.get((p, e), (0, 0))
                    total[p, e] = (count + len(chosen), sums + chosen.sum(axis=0).astype(object))
        out = [(p, e, k, count, str(s)) for (p, e), (count, sums) in total.items()
               for k, s in enumerate(sums)]
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(cols, [pa.int32()] * 3 + [pa.int64(), pa.string()])],
            names=["p", "e", "k", "n", "s"])

    # Sums of ordinary size are added up exactly as decimals; larger ones as the few
    # big integers that the tasks sent.
    sent = rows.select("v").mapInArrow(run, "p int, e int, k int, n bigint, s string")
    number = F.when(F.length("s") <= 28, F.col("s")).try_cast("decimal(38,0)")
    merged = sent.groupBy("p", "e", "k").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("s"),
        F.collect_list(F.when(F.length("s") > 28, F.col("s"))).alias("large"))
    out: dict[tuple[int, int], tuple[int, dict[int, int]]] = {}
    for r in merged.collect():
        out.setdefault((r.p, r.e), (r.n, {}))[1][r.k] = int(r.s) + sum(map(int, r.large))
    return {key: (n, [sums[k] for k in sorted(sums)]) for key, (n, sums) in out.items()}


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list:
    """The codebooks: part -> entry -> integer components."""
    first = rows.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).select("v").collect()
    if not first:
        first = rows.orderBy("v").limit(entries).select("v").collect()
    start = to_integers(np.array([r.v for r in first], np.float64))
    books = [[[int(x) for x in e] for e in part] for part in np.split(start, parts, axis=1)]
    for _ in range(rounds):
        found = part_sums(rows, books)
        moved = [[[s // found[p, e][0] for s in found[p, e][1]] if (p, e) in found else entry
                  for e, entry in enumerate(book)] for p, book in enumerate(books)]
        if moved == books:
            break
        books = moved
    return books


def encode(rows: DataFrame, books: list) -> DataFrame:
    """(vec_id, label, code, error) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, gaps = codec.assign(_batches(batch, 2))
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            total = [int(sum(g)) for g in gaps.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()),
                 pa.array([t if t < LONG else None for t in total], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(
        run, f"vec_id bigint, label {label}, code string, error bigint")


def decode(codes: DataFrame, books: list) -> DataFrame:
    """``codes`` with the integer vector that each code stands for (``decoded``)."""
    table = F.array(*[F.array(*[F.array(*[F.lit(x) for x in e]) for e in b]) for b in books])
    place = F.sequence(F.lit(0), F.lit(len(books) - 1))
    entry = lambda p: F.conv(F.substring("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int")
    return codes.withColumn("decoded", F.flatten(F.transform(
        place, lambda p: F.get(F.get(table, p), entry(p)))))


def books_digest(books: list) -> str:
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def code_report(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: code, errors and the digest of the final codebooks."""
    rows = usable(vectors, parts)
    if rows.isEmpty():
        books, coded = [], rows.select("vec_id", "label", F.lit("").alias("code"),
                                       F.lit(0).cast("bigint").alias("error"))
    else:
        books = train(rows, parts, entries, rounds)
        coded = stored(encode(rows, books))
    totals = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")) \
        .withColumnRenamed("label", "of_label")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
