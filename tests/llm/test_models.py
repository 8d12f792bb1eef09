"""The pieces that run inside tasks, against plain statements of them."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.llm.conftest import SF
from weekmart.llm.fm_index import BitVector, FMIndex, WaveletTree
from weekmart.llm.secrets_crf import (
    FORBIDDEN, I, Model, O, Tagger, base_spans, tokenise, train,
)


def test_bit_vector_and_wavelet_tree():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 1000):
        bits = rng.integers(0, 2, n).astype(np.uint8)
        at = np.arange(n + 1)
        assert (BitVector(bits).rank1(at) == np.concatenate([[0], np.cumsum(bits)])).all()
        seq = rng.integers(0, 37, n)
        tree = WaveletTree(seq, 37)
        for c in (0, 5, 36):
            want = np.concatenate([[0], np.cumsum(seq == c)])
            assert (tree.rank(np.full(n + 1, c), at) == want).all()


@pytest.mark.parametrize("depth", [3, 4, 50])
def test_fm_index_finds_the_smallest_owner(depth):
    rng = np.random.default_rng(depth)
    base = rng.integers(1, 5, 400)
    passages = [base[a:a + depth + int(rng.integers(0, 20))] for a in rng.integers(0, 300, 60)]
    passages = [p for p in passages if len(p) >= depth]
    owner = rng.permutation(len(passages)).astype(np.int64)
    got = FMIndex(passages, owner, depth).matches(passages)
    first = {}
    for p, o in zip(passages, owner.tolist()):
        for i in range(len(p) - depth + 1):
            k = tuple(p[i:i + depth].tolist())
            first[k] = min(first.get(k, o), o)
    for p, g in zip(passages, got):
        assert g.tolist() == [first[tuple(p[i:i + depth].tolist())] for i in range(len(p) - depth + 1)]


def test_pruned_decoding_is_viterbi():
    rng = np.random.default_rng(4)
    for trial in range(300):
        moves = rng.normal(0, 2, (4, 3))
        moves[[O, 3], I] = FORBIDDEN
        tagger = Tagger(Model({"x": 0}, np.zeros((5, 1, 3)), moves))
        e = rng.normal(0, 3, (int(rng.integers(1, 40)), 3))
        e[:, O] += rng.choice([0, 6, 12])
        whole = tagger.viterbi(e, True, True)

        def score(tags):
            s = moves[3, tags[0]] + e[0, tags[0]]
            return s + sum(moves[a, b] + e[i + 1, b] for i, (a, b) in enumerate(zip(tags, tags[1:])))

        assert score(tagger.tags(e)) == pytest.approx(score(whole))


def test_held_out_secrets_are_found():
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    with_secret = [t for t in texts if base_spans(t)]
    model = train(with_secret[::2] + texts[:100:2])
    tagger = Tagger(model)
    hit = missed = 0
    for t in with_secret[1::2]:
        found = tagger.spans(t)
        for _, _, end, inner in base_spans(t):
            ok = any(s < end and e > inner for s, e in found)
            hit, missed = hit + ok, missed + (not ok)
    clean = [t for t in texts[1::2] if not base_spans(t)]
    false = sum(len(tagger.spans(t)) for t in clean)
    words = sum(len(tokenise(t)[0]) for t in clean)
    assert hit / (hit + missed) >= 0.95
    assert false / words < 1e-3
