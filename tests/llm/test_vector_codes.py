"""Product codes against plain Lloyd rounds, and the tree against a full search."""

import hashlib
import math
import random

import numpy as np
import pytest

from weekmart.llm import vector_codes as V
from weekmart.llm.gnat import Gnat, ceil_root, floor_root

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int"


def brute(rows, parts, entries, rounds):
    """{index of row: (code, error, label error)} and the codebooks' digest."""
    kept = [(i, k, e, lab) for i, (k, e, lab) in enumerate(rows)
            if e is not None and e and len(e) % parts == 0 and all(x is not None and math.isfinite(x) for x in e)]
    sizes = {}
    for r in kept:
        sizes[len(r[2])] = sizes.get(len(r[2]), 0) + 1
    if not sizes:
        return {}, None
    length = max(sizes, key=lambda n: (sizes[n], n))
    kept = [r for r in kept if len(r[2]) == length]
    size = length // parts
    ints = {r[0]: [math.floor(float(np.float32(x)) * 4096) for x in r[2]] for r in kept}
    start = sorted((r for r in kept if r[1] is not None), key=lambda r: (r[1], [float(x) for x in r[2]]))[:entries]
    books = [[ints[r[0]][p * size:(p + 1) * size] for r in start] for p in range(parts)]

    def assign(p, vector):
        part = vector[p * size:(p + 1) * size]
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in ints.values():
                groups.setdefault(assign(p, v)[0], []).append(v[p * size:(p + 1) * size])
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out, totals = {}, {}
    for i, _, _, lab in kept:
        found = [assign(p, ints[i]) for p in range(parts)]
        out[i] = ("".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found), lab)
        totals[lab] = totals.get(lab, 0) + out[i][1]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: (c, e, totals[lab]) for i, (c, e, lab) in out.items()}, digest


def compare(spark, rows, **sizes):
    df = spark.createDataFrame([(k, e, lab, "x", 1) for k, e, lab in rows], SCHEMA)
    got = V.code_report(df, **sizes).collect()
    want, digest = brute(rows, sizes.get("parts", 8), sizes.get("entries", 16), sizes.get("rounds", 6))
    fits = lambda x: x if x < 1 << 63 else None
    key = lambda t: repr(t)
    assert sorted([(r.vec_id, r.code, r.error) for r in got], key=key) == \
        sorted([(rows[i][0], c, fits(e)) for i, (c, e, _) in want.items()], key=key)
    if all(fits(e) for _, e, _ in want.values()):
        assert sorted([(r.vec_id, r.label_error) for r in got], key=key) == \
            sorted([(rows[i][0], t) for i, (_, _, t) in want.items()], key=key)
    assert all(r.codebooks_sha256 == digest for r in got)
    return got


def test_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert len(compare(spark, rows)) == len(rows)


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = [(i % 40, [rng.choice([-0.5, 0.25, 0.1, 0.0]) for _ in range(16)], rng.choice([1, 2, None]))
            for i in range(150)]
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [nan] * 16, 1), (902, [inf] * 16, 2), (903, [None] * 16, 2), (904, [], 1),
             (905, [0.5] * 8, 1), (906, [0.5] * 13, 1), (None, [0.125] * 16, None), (0, rows[0][1], 1), (0, rows[0][1], 1)]
    got = compare(spark, rows)
    assert {r.vec_id for r in got} >= {None, 0} and not {r.vec_id for r in got} & set(range(900, 907))


def test_few_rows_and_huge_components(spark):
    compare(spark, [(3, [0.5, 1.0, -2.0, 4.0], 1), (1, [0.25, 0.0, 0.0, 1.0], 1)], parts=2, entries=16)
    rng = random.Random(4)
    rows = [(i, [rng.choice([3e30, -1e20, 5e8, 1.5]) * rng.random() for _ in range(4)], 0) for i in range(30)]
    got = compare(spark, rows, parts=2, entries=4, rounds=3)
    assert any(r.error is None for r in got)
    assert V.code_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert V.code_report(spark.createDataFrame([(1, None, 1, "", 1)], SCHEMA)).count() == 0


def test_decoding_gives_the_entries(spark):
    rows = V.usable(spark.read.parquet(f"{SF}/embeddings.parquet"), 8)
    books = V.train(rows, 8, 16, 1)
    r = V.decode(V.encode(rows, books), books).first()
    want = [x for p in range(8) for x in books[p][int(r.code[2 * p:2 * p + 2], 16)]]
    assert r.decoded == want


@pytest.mark.parametrize("seed", range(8))
def test_tree_search_is_exact_and_drops_subtrees(seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-5, 6, (40, 3)) if seed % 2 else rng.integers(-4000, 4000, (200, 2))
    entries[7] = entries[3]                              # equal entries: the lower index wins
    queries = np.concatenate([rng.integers(-4000, 4000, (300, entries.shape[1])), entries])
    tree = Gnat(entries)
    index, best = tree.nearest(queries)
    full = ((queries[:, None].astype(np.int64) - entries[None]) ** 2).sum(2)
    assert (index == full.argmin(1)).all() and (best == full.min(1)).all()
    if seed % 2 == 0:
        assert tree.measured < 0.5 * full.size
    wide = Gnat(entries.astype(object))
    i2, b2 = wide.nearest(queries[:50].astype(object))
    assert (i2 == index[:50]).all() and (b2 == best[:50]).all()


def test_integer_roots():
    x = np.array([0, 1, 2, 3, 4, (1 << 31) ** 2 - 1, (1 << 31) ** 2, (1 << 31) ** 2 + 1], np.int64)
    assert floor_root(x).tolist() == [math.isqrt(int(v)) for v in x]
    assert ceil_root(x).tolist() == [math.isqrt(int(v)) + (math.isqrt(int(v)) ** 2 < v) for v in x]
