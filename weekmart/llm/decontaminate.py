"""Benchmark decontamination by a distributed positional inverted index.

Training words that occur in any benchmark item are stored as postings: one row
per (document, term) with the sorted positions.  A benchmark window is looked
up from its rarest term: that term's postings, shifted by the term's offset in
the window, are the candidate starts; they are intersected with the shifted
list of the second rarest term, and the survivors with all remaining terms.
What is left are exact phrase matches.  Proximity matches are the stretches of
``NEAR_SPAN`` words that hold all of a window's distinct words but ``NEAR_MISSING``,
in any order: two of the window's rarest words must stand in such a stretch, so
the postings of those words are intersected first.

Documents are split into words once, when the index is written; the index is a
Parquet table in the shared checkpoint folder and every later step is a join of
narrow rows.  Documents are keyed by (id, hash of the text), so repeated rows
and null ids need no special care.

Defined cases: null text has no words; an item without words yields no window
and an item shorter than a window is one window; rows that repeat an item count
as one item; null item_ids are ignored; an empty index or item table hits
nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.llm.storage import stored
from weekmart.llm.text import alnum_words, by_shuffle

WINDOW = 10
MAX_TERMS_IN_TASK = 1_000_000  # a larger vocabulary is joined, not sent to the tasks

BROADCAST_DOCS = 500_000       # candidate documents sent to the postings; more are joined by shuffle

NEAR_SPAN = 20      # words of a stretch that is a proximity match
NEAR_MISSING = 1    # distinct words of the window that it may lack
NEAR_LEAST = 5      # windows of fewer distinct words have exact matches only

# Lower-cased UTF-8: runs of bytes that are digits, a-z or non-ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window_id, item_id, terms) of each distinct window of each item."""
    words = items.where("item_id is not null").select(
        F.col("item_id"), alnum_words(F.col("text")).alias("words")).where("size(words) > 0")
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    rows = words.select("item_id", F.explode(F.transform(
        starts, lambda i: F.slice("words", i, size))).alias("terms")).distinct()
    return rows.select(F.xxhash64("terms").alias("window_id"), "item_id", "terms")


def _document_postings(text: bytes, ids: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, and (term, position) of the indexed ones by term."""
    words = _WORD.findall(text.lower())
    codes = np.fromiter(map(ids.get, words, [-1] * len(words)), np.int32, len(words))
    at = np.flatnonzero(codes >= 0)
    order = np.argsort(codes[at], kind="stable")
    return len(words), codes[at][order], at[order].astype(np.int32)


def index_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Rows (doc_id, doc_hash, term, n, positions); a row with term -1 per
    document holds its word count in ``n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, rows, terms, sizes, spots = [], [], [], [], []
                for i, text in enumerate(part.column(2)):
                    body = text.as_buffer().to_pybytes() if text.is_valid else b""
                    n, codes, where = _document_postings(body, vocabulary)
                    cuts = np.flatnonzero(np.diff(codes, prepend=-1))
                    lengths = np.diff(np.append(cuts, len(codes)))
                    terms += [np.array([-1], np.int32), codes[cuts]]
                    sizes += [np.array([0]), lengths]
                    counts += [np.array([n]), lengths]
                    rows.append(np.full(len(cuts) + 1, i))
                    spots.append(where)
                row = np.concatenate(rows)
                ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                     pa.array(np.concatenate(terms)), pa.array(np.concatenate(counts).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(spots)))],
                    names=["doc_id", "doc_hash", "term", "n", "positions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"),
                         F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, doc_hash bigint, term int, n int, positions array<int>")


def index_by_join(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The rows of :func:`index_documents` for a vocabulary (word, term) of any size:
    words are joined to it by shuffle, a frequent word's rows split over tasks."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"), alnum_words(F.col("text")).alias("words"))
    spread = keyed.dropDuplicates(["doc_id", "doc_hash"]).select(
        "doc_id", "doc_hash", F.posexplode("words").alias("p", "word"))
    held = spread.join(vocabulary, "word").groupBy("doc_id", "doc_hash", "term").agg(
        F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list("p")).alias("positions"))
    counts = keyed.select("doc_id", "doc_hash", F.lit(-1).cast("long").alias("term"), F.size("words").alias("n"),
                          F.array().cast("array<int>").alias("positions"))
    return held.unionByName(counts)


def build_index(docs: DataFrame, wins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, vocabulary): the stored index and the windows' words (word, term).
    Up to ``MAX_TERMS_IN_TASK`` words travel with the tasks; more are joined."""
    words = stored(wins.select(F.explode("terms").alias("word")).distinct())
    if words.count() > MAX_TERMS_IN_TASK:
        vocabulary = stored(words.select("word", F.monotonically_increasing_id().alias("term")))
        return stored(index_by_join(docs, vocabulary)), vocabulary
    ids = {w.encode(): i for i, w in enumerate(sorted(r.word for r in words.collect()))}
    vocabulary = docs.sparkSession.createDataFrame([(k.decode(), v) for k, v in ids.items()],
                                                   "word string, term int")
    return stored(index_documents(docs, ids)), vocabulary


KEYS = ["doc_id", "doc_hash"]


def _same_doc(a: DataFrame, b: DataFrame, how: str = "inner", extra=()) -> DataFrame:
    """Join on the document key, null ids equal; b's key columns are dropped."""
    other = b.withColumnsRenamed({k: f"_{k}" for k in (*KEYS, *extra)})
    cond = a["doc_hash"] == other["_doc_hash"]
    for k in extra:
        cond = cond & (a[k] == other[f"_{k}"])
    cond = cond & a["doc_id"].eqNullSafe(other["_doc_id"])
    return a.join(other, cond, how).drop(*[f"_{k}" for k in (*KEYS, *extra)])


def ranked_terms(wins: DataFrame, postings: DataFrame, vocab: DataFrame) -> DataFrame:
    """(window_id, size, terms_by_rarity): the distinct words of each window as
    structs (count, term, offset), rarest first."""
    seen = postings.groupBy("term").agg(F.sum("n").alias("cf"))
    vocab = vocab.join(seen, "term", "left")
    spread = wins.select("window_id", "terms").distinct().select(
        "window_id", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "word"))
    return by_shuffle(spread).join(vocab, "word").groupBy("window_id", "size").agg(
        F.sort_array(F.collect_list(F.struct(
            F.coalesce("cf", F.lit(0)).alias("cf"), "term", "offset"))).alias("ranked"))


def phrase_matches(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, window_id, size, start) of every exact occurrence."""
    size = F.col("size")
    # A word absent from the corpus rules its windows out.
    live = ranked.where(F.col("ranked")[0]["cf"] > 0)
    first = live.select("window_id", "size", "ranked", F.col("ranked")[0]["term"].alias("term"),
                        F.col("ranked")[0]["offset"].alias("offset"))
    # Only the rarest terms' postings are read out position by position.
    cand = by_shuffle(postings).join(first, "term").select(
        *KEYS, "window_id", "size", "ranked", "offset", F.explode("positions").alias("p")) \
        .select(*KEYS, "window_id", "size", "ranked", (F.col("p") - F.col("offset")).alias("start")) \
        .where("start >= 0")
    second = cand.where(size > 1).withColumn("term", F.col("ranked")[1]["term"])
    terms = stored(live.where(size > 1).select(F.col("ranked")[1]["term"].alias("term")).distinct())
    # A vocabulary that tasks can hold can be sent to the postings.
    if terms.count() <= MAX_TERMS_IN_TASK:
        terms = F.broadcast(terms)
    listed = postings.join(terms, "term", "left_semi")
    met = _same_doc(by_shuffle(second), listed.select(*KEYS, "term", "positions"), extra=("term",)).where(
        F.array_contains("positions", F.col("start") + F.col("ranked")[1]["offset"])) \
        .drop("positions", "term")
    met = stored(met)
    # The remaining terms: one lookup per (document, term), all must hold.
    rest = met.where("size > 2").select(
        *KEYS, "window_id", "size", "start",
        F.explode(F.slice("ranked", 3, WINDOW * 1000)).alias("r"))
    rest = rest.select(*KEYS, "window_id", "size", "start", F.col("r")["term"].alias("term"),
                       F.col("r")["offset"].alias("offset"))
    wanted = stored(met.select(*KEYS).distinct())
    if wanted.count() <= BROADCAST_DOCS:
        wanted = F.broadcast(wanted)
    narrow = _same_doc(postings.select(*KEYS, "term", "positions").where("term >= 0"), wanted,
                       "left_semi")
    held = _same_doc(by_shuffle(rest), narrow, extra=("term",)).where(
        F.array_contains("positions", F.col("start") + F.col("offset")))
    whole = held.groupBy(*KEYS, "window_id", "size", "start").agg(F.count_distinct("offset").alias("c")) \
        .where(F.col("c") == size - 2).drop("c")
    cols = [*KEYS, "window_id", "size", "start"]
    return whole.select(*cols).unionByName(met.where("size = 2").select(*cols)) \
        .unionByName(cand.where("size = 1").select(*cols))


def near_windows(ranked: DataFrame, missing: int = NEAR_MISSING) -> DataFrame:
    """(window_id, need, terms, rare): distinct words of each window that occur in the
    corpus, how many a match needs, and the ``missing + 2`` rarest, two of which are in
    every match."""
    words = ranked.select("window_id", F.array_distinct(F.transform(
        "ranked", lambda x: F.struct(x["cf"].alias("cf"), x["term"].alias("term")))).alias("words"))
    live = words.select("window_id", (F.size("words") - missing).alias("need"), F.size("words").alias("m"),
                        F.transform(F.filter("words", lambda x: x["cf"] > 0), lambda x: x["term"]).alias("terms"))
    return live.where((F.col("m") >= NEAR_LEAST) & (F.col("need") >= 2) & (F.size("terms") >= F.col("need"))) \
        .select("window_id", "need", "terms", F.array_sort(F.slice("terms", 1, missing + 2)).alias("rare"))


def _by_place(held: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, term) of every posting of a batch, in order of row and position."""
    postings = held.flatten()
    lists = postings.field("positions")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(held)), held.value_lengths().to_numpy(zero_copy_only=False))
    row = np.repeat(rows, sizes)
    place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    term = np.repeat(postings.field("term").to_numpy(zero_copy_only=False).astype(np.int64), sizes)
    order = np.argsort(row * (1 << 33) + place, kind="stable")
    return row[order], place[order], term[order]


def _close_pairs(batches: Iterator[pa.RecordBatch], distance: int, wanted: np.ndarray | None):
    """Distinct (document, a, b) of terms a < b that stand in one stretch of ``distance``
    words; with ``wanted`` those pairs (a << 32 | b, sorted) only."""
    for batch in batches:
        row, place, term = _by_place(batch.column("held"))
        found = []
        for step in range(1, distance):
            near = np.flatnonzero((row[step:] == row[:-step]) & (place[step:] - place[:-step] < distance)
                                  & (term[step:] != term[:-step]))
            if not len(near):
                continue
            a, b = np.minimum(term[near], term[near + step]), np.maximum(term[near], term[near + step])
            if wanted is not None:
                key = a << 32 | b
                at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                some = wanted[at] == key
                near, a, b = near[some], a[some], b[some]
            found.append(np.stack([row[near], a, b]))
        told = np.unique(np.concatenate(found, 1), axis=1) if found else np.zeros((3, 0), np.int64)
        at = pa.array(told[0])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("doc_hash").take(at), pa.array(told[1]), pa.array(told[2])],
            names=[*KEYS, "a", "b"])


def _near(lists: list[np.ndarray], need: int, distance: int) -> bool:
    """Whether some stretch of ``distance`` words holds values of ``need`` lists.  The
    lists come rarest first."""
    spare = len(lists) - need
    if spare < 0:
        return False
    # A match has one of the first words.  Its other words are near that one: places
    # that lack more than ``spare`` words nearby are given up on the way.
    at = np.concatenate(lists[:spare + 1])
    lacks = np.zeros(len(at), np.int64)
    for own in lists:
        lacks += np.searchsorted(own, at + distance) == np.searchsorted(own, at - distance + 1)
        left = lacks <= spare
        if not left.all():
            at, lacks = at[left], lacks[left]
            if not len(at):
                return False
    starts = np.concatenate(lists)
    seen = np.zeros(len(starts), np.int64)
    for own in lists:
        seen += np.searchsorted(own, starts + distance) > np.searchsorted(own, starts)
    return bool((seen >= need).any())


def _holding(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """(document, window_id) of the candidate windows that have ``need`` of their terms
    in a stretch of ``distance`` words."""
    for batch in batches:
        rows, windows = [], []
        for i, (held, tried) in enumerate(zip(batch.column("held"), batch.column("tried").to_pylist())):
            lists = held.values.field("positions")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            parts = np.split(lists.flatten().to_numpy(zero_copy_only=False), ends[:-1])
            spots = dict(zip(held.values.field("term").to_pylist(), parts))
            for window in tried:
                if _near([spots[t] for t in window["terms"] if t in spots], window["need"], distance):
                    rows.append(i)
                    windows.append(window["window_id"])
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("doc_hash").take(at), pa.array(windows, pa.int64())],
            names=[*KEYS, "window_id"])


def _per_document(postings: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, held): a document's postings in one row, a repeated one once."""
    return postings.groupBy(*KEYS).agg(F.collect_set(F.struct("term", "positions")).alias("held"))


def proximity_matches(postings: DataFrame, ranked: DataFrame, exact: DataFrame,
                      distance: int = NEAR_SPAN, missing: int = NEAR_MISSING) -> DataFrame:
    """(doc_id, doc_hash, window_id) of documents with a stretch of ``distance`` words that
    holds all distinct words of a window but ``missing``.  The ``exact`` matches
    (doc_id, doc_hash, window_id) of windows no longer than the distance are among them
    without a second look.

    Two of a window's rarest words must be close: the postings of those words are put
    together per document and their close pairs looked up.  What is left is tested with all words."""
    wins = stored(near_windows(ranked, missing))
    held = postings.where("term >= 0").select(*KEYS, "term", "positions")
    longs = wins.select("window_id", F.col("rare").cast("array<bigint>").alias("rare"))
    pairs = stored(longs.select("window_id", F.explode("rare").alias("a"), "rare")
                   .select("window_id", "a", F.explode("rare").alias("b")).where("a < b"))
    distinct = pairs.select("a", "b").distinct()
    rare = stored(wins.select(F.explode("rare").alias("term")).distinct())
    wanted = None
    if rare.count() <= MAX_TERMS_IN_TASK:
        rare = F.broadcast(rare)
        highest = pairs.agg(F.max("b")).first()[0]
        if highest is not None and highest < 1 << 31 and distinct.count() <= MAX_TERMS_IN_TASK:
            wanted = np.sort(np.array([r.a << 32 | r.b for r in distinct.collect()], np.int64))
    kind = postings.schema["doc_id"].dataType.simpleString()
    close = _per_document(held.join(rare, "term", "left_semi")).mapInArrow(
        lambda batches: _close_pairs(batches, distance, wanted), f"doc_id {kind}, doc_hash bigint, a bigint, b bigint")
    met = stored(close.join(pairs, ["a", "b"]).select(*KEYS, "window_id").distinct())
    told = exact.join(wins.select("window_id"), "window_id", "left_semi").select(*KEYS, "window_id").distinct()
    tried = stored(_same_doc(met, told, "left_anti", extra=("window_id",)).join(
        wins.select("window_id", "need", "terms"), "window_id"))
    # Words that a document's candidates ask for, each read once.
    asked = tried.select(*KEYS, F.explode("terms").alias("term")).distinct()
    if tried.select(*KEYS).distinct().count() <= BROADCAST_DOCS:
        held = _same_doc(held, F.broadcast(tried.select(*KEYS).distinct()), "left_semi")
    lists = _per_document(_same_doc(held, by_shuffle(asked), "left_semi", extra=("term",)))
    candidates = tried.groupBy(*KEYS).agg(F.collect_list(F.struct("window_id", "need", "terms")).alias("tried"))
    near = _same_doc(by_shuffle(lists), candidates).mapInArrow(
        lambda batches: _holding(batches, distance), f"doc_id {kind}, doc_hash bigint, window_id bigint")
    return near.unionByName(told)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, near: bool = False) -> DataFrame:
    """(doc_id, doc_hash, n_words, n_hit, item_ids) per distinct (doc_id, text); with
    ``near`` also near_ids, the items with exact or proximity matches."""
    wins = stored(windows(items, size))
    postings, vocabulary = build_index(docs, wins)
    ranked = ranked_terms(wins, postings, vocabulary)
    if near:
        ranked = stored(ranked)
    matched = stored(phrase_matches(postings, ranked).distinct())
    # Words covered by the matched windows: merge their intervals per document.
    spans = matched.groupBy(*KEYS).agg(F.sort_array(F.collect_set(F.struct(
        F.col("start").alias("s"), (F.col("start") + F.col("size")).alias("e")))).alias("spans"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"),
                              (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0)))
                              .cast("long").alias("n")),
        lambda a: a["n"])
    found = matched.select(*KEYS, "window_id").distinct().join(
        wins.select("window_id", "item_id").distinct(), "window_id") \
        .groupBy(*KEYS).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string")))
                            .alias("item_ids"))
    counts = postings.where("term = -1").select(*KEYS, F.col("n").cast("long").alias("n_words"))
    hit = _same_doc(spans.select(*KEYS, covered.alias("n_hit")), found)
    none = F.array().cast("array<string>")
    out = _same_doc(counts, hit, "left").select(
        *KEYS, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", none).alias("item_ids"))
    if not near:
        return out
    close = proximity_matches(postings, ranked, matched.select(*KEYS, "window_id").distinct()) \
        .join(wins.select("window_id", "item_id"), "window_id").groupBy(*KEYS) \
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("close_ids"))
    return _same_doc(out, close, "left").withColumn("near_ids", F.array_sort(F.array_union(
        "item_ids", F.coalesce("close_ids", none)))).drop("close_ids")


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items, near=True).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_ids").cast("long").alias("n_near"),
        F.sha2(F.array_join("near_ids", ","), 256).alias("near_sha256"))


def clean_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = contamination(docs, items, size).where("n_hit > 0").select(*KEYS).distinct()
    b = bad.withColumnsRenamed({k: f"bad_{k}" for k in KEYS})
    return docs.join(b, F.xxhash64(docs["text"]).eqNullSafe(b["bad_doc_hash"])
                     & docs["doc_id"].eqNullSafe(b["bad_doc_id"]), "left_anti")
