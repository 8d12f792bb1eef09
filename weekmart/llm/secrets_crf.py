"""Secret scans with a linear-chain conditional random field.

Tokens are tagged begin / inside / outside of a secret.  The score of a tag adds
weights for the token's shape, length, characters and word, for the tokens one
and two before and one after, and for features of the whole text, plus tag
transitions; the best tag sequence is found by Viterbi.  The weights are
trained here by gradient ascent on the conditional likelihood, on a bounded
sample of documents whose tags come from the base patterns (``Training``).

Decoding is exact and fast: a token whose outside score leads by more than any
change of transitions could gain is outside on every best path, so Viterbi only
runs over the short stretches between such tokens.

Base patterns (fixed values below) give the base spans; spans of the random
field that meet no base span are added with kind ``crf``.

Defined cases: null text is empty and has no spans; very long texts are tokenised
whole; rows are handled one by one, so repeats and further columns do not matter;
without any document that holds a secret the model tags everything outside; an
empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns in their listed order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey", "key", "pwd", "pass",
            "auth", "bearer", "credential", "private", "access")

TOKEN = re.compile(r"""([^\s"'`:=,;()<>\[\]{}!?@#$%&*|\\^~]+|\S)""")
B, I, O = 0, 1, 2
FORBIDDEN = -20.0   # outside -> inside
CACHE = 500_000     # distinct tokens whose class a task remembers


@dataclass(frozen=True)
class Training:
    """The bounded sample: documents, tokens around a secret and iterations."""
    documents: int = 400
    segment: int = 24
    segments: int = 4000
    steps: int = 80
    rate: float = 0.5


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself), by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api_key", "apikey")):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)
                  if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def tokenise(text: str) -> tuple[list[str], np.ndarray]:
    """Tokens and their start offsets."""
    parts = TOKEN.split(text)
    starts = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    return parts[1::2], starts[0:-1:2]


_RUNS = (re.compile("[a-z]+"), re.compile("[A-Z]+"), re.compile("[0-9]+"))


def token_features(token: str) -> tuple[str, ...]:
    """Shape, length, characters and keyword of a token."""
    shape = token
    if len(token) <= 200:
        for run, sign in zip(_RUNS, "aA0"):
            shape = run.sub(sign, shape)
    length = sum(len(token) >= x for x in (2, 6, 10, 16, 20, 24, 32, 40))
    if re.fullmatch("[0-9a-f]+", token) and re.search("[0-9]", token) and re.search("[a-f]", token):
        chars = "hex"
    elif re.fullmatch("[A-Z0-9]+", token) and re.search("[0-9]", token) and re.search("[A-Z]", token):
        chars = "caps"
    elif re.fullmatch(r"[A-Za-z0-9+/_.\-]+", token):
        chars = "digits" if token.isdigit() else "mixed" if re.search("[0-9]", token) else "letters"
    else:
        chars = token if len(token) == 1 else "other"
    low = token.lower().strip("._-")
    return (f"s:{shape[:8]}", f"l:{length}", f"c:{chars}", f"cl:{chars}{length}",
            f"w:{low if low in KEYWORDS else '-'}")


def text_features(text: str, tokens: list[str]) -> tuple[str, ...]:
    """Features of the whole text: its density of assignment signs and length."""
    signs = (text.count("=") + text.count(":")) / max(1, len(tokens))
    return (f"f:{min(3, int(signs * 100))}", f"n:{min(5, len(tokens).bit_length() // 3)}")


@dataclass
class Model:
    """Weights by place (token, one before, two before, one after, text)."""
    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((5, 0, 3)))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((4, 3)))  # row 3: from the start

    def score(self, place: int, feats: tuple[str, ...]) -> np.ndarray:
        ids = [self.features[f] for f in feats if f in self.features]
        return self.weights[place, ids].sum(0) if ids else np.zeros(3)


class Tagger:
    """Decoding state of one task: token classes with their scores."""

    def __init__(self, model: Model):
        self.model, self.moves = model, model.moves
        self.classes: dict[tuple[str, ...], int] = {}
        self.seen: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, 4, 3))
        T = self.moves
        end = np.zeros(3)
        gain = lambda a, x, b: T[a, x] + (end[x] if b is None else T[x, b]) \
            - T[a, O] - (end[O] if b is None else T[O, b])
        # Most that a tag other than outside can gain by transitions, if the
        # next tag is not inside ...
        self.k1 = max(gain(a, x, b) for a in range(4) for x in (B, I) for b in (O, B, None))
        # ... and if it is: then the next token would begin a secret instead.
        self.k2 = max(T[a, x] + T[x, I] + (0 if c is None else T[I, c]) - T[a, O] - T[O, B]
                      - (0 if c is None else T[B, c])
                      for a in range(4) for x in (B, I) for c in (B, I, O, None))

    def _class(self, token: str) -> int:
        feats = token_features(token)
        number = self.classes.setdefault(feats, len(self.classes))
        if number == len(self.rows):
            self.rows.append(np.stack([self.model.score(p, feats) for p in range(4)]))
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[token] = number
        return number

    def emissions(self, text: str, tokens: list[str]) -> np.ndarray:
        seen = self.seen
        codes = np.fromiter((seen[t] if t in seen else self._class(t) for t in tokens),
                            np.int64, len(tokens))
        if len(self.table) < len(self.rows):
            self.table = np.stack(self.rows)
        t = self.table
        e = t[codes, 0]
        e[1:] += t[codes[:-1], 1]
        e[2:] += t[codes[:-2], 2]
        e[:-1] += t[codes[1:], 3]
        return e + self.model.score(4, text_features(text, tokens))

    def tags(self, e: np.ndarray) -> np.ndarray:
        """The best tag sequence."""
        n = len(e)
        out = np.full(n, O, np.int8)
        lead = e[:, O] - np.maximum(e[:, B], e[:, I])
        follow = np.zeros(n)
        follow[:-1] = e[1:, I] - e[1:, B]
        loose = np.flatnonzero((lead <= self.k1 + 1e-9) | (lead <= self.k2 + follow + 1e-9))
        if not len(loose):
            return out
        for run in np.split(loose, np.flatnonzero(np.diff(loose) > 1) + 1):
            a, b = int(run[0]), int(run[-1])
            out[a:b + 1] = self.viterbi(e[a:b + 1], first=a == 0, last=b == n - 1)
        return out

    def viterbi(self, e: np.ndarray, first: bool, last: bool) -> np.ndarray:
        """Best tags of a stretch between outside tokens or the text's ends."""
        T = self.moves.tolist()
        best = [T[3 if first else O][y] + s for y, s in enumerate(e[0].tolist())]
        back = []
        for row in e[1:].tolist():
            frm = [max(range(3), key=lambda x: best[x] + T[x][y]) for y in range(3)]
            best = [best[frm[y]] + T[frm[y]][y] + row[y] for y in range(3)]
            back.append(frm)
        if not last:
            best = [best[y] + T[y][O] for y in range(3)]
        tags = [max(range(3), key=best.__getitem__)]
        for frm in reversed(back):
            tags.append(frm[tags[-1]])
        return np.array(tags[::-1], np.int8)

    def spans(self, text: str) -> list[tuple[int, int]]:
        tokens, starts = tokenise(text)
        if not tokens or not self.model.features:
            return []
        tags = self.tags(self.emissions(text, tokens))
        inside = np.flatnonzero(tags != O)
        out: list[list[int]] = []
        for i in inside.tolist():
            end = int(starts[i]) + len(tokens[i])
            if tags[i] == I and out and out[-1][2] == i - 1:
                out[-1][1:] = [end, i]
            else:
                out.append([int(starts[i]), end, i])
        return [(s, t) for s, t, _ in out]


def _segments(texts: list[str], t: Training):
    """Padded training segments: feature ids by place, tags, lengths."""
    features: dict[str, int] = {}
    number = lambda f: features.setdefault(f, len(features))
    ids, tags, sizes = [], [], []
    for text in texts:
        tokens, starts = tokenise(text)
        if not tokens:
            continue
        gold = np.full(len(tokens), O, np.int64)
        for _, _, end, inner in base_spans(text):
            at = np.flatnonzero((starts >= inner) & (starts < end))
            gold[at] = I
            gold[at[:1]] = B
        hits = np.flatnonzero(gold == B).tolist()
        centres = [*hits, *range(t.segment, len(tokens), 7 * t.segment)]
        ft = [number(f) for f in text_features(text, tokens)]
        cache = {}
        feats = [cache.get(x) or cache.setdefault(x, [number(f) for f in token_features(x)])
                 for x in tokens]
        for c in centres:
            a = max(0, c - t.segment // 2)
            b = min(len(tokens), a + t.segment)
            if b - a < 2 or len(ids) >= t.segments:
                continue
            ids.append([(feats[i], feats[i - 1] if i else [], feats[i - 2] if i > 1 else [],
                         feats[i + 1] if i + 1 < len(tokens) else [], ft) for i in range(a, b)])
            tags.append(gold[a:b])
            sizes.append(b - a)
    return features, ids, tags, np.array(sizes, np.int64)


def train(texts: list[str], t: Training = Training()) -> Model:
    """Gradient ascent (AdaGrad) on the conditional log-likelihood."""
    if not any(base_spans(x) for x in texts):
        return Model()
    features, ids, tags, sizes = _segments(texts, t)
    n, L, V = len(ids), int(sizes.max()), len(features)
    seg, pos, place, feat = (np.array(x, np.int64) for x in zip(*(
        (s, p, k, f) for s, row in enumerate(ids) for p, places in enumerate(row)
        for k, fs in enumerate(places) for f in fs)))
    gold = np.full((n, L), O, np.int64)
    for s, y in enumerate(tags):
        gold[s, :len(y)] = y
    live = np.arange(L)[None, :] < sizes[:, None]
    w, moves = np.zeros((5, V, 3)), np.zeros((4, 3))
    moves[[O, 3], I] = FORBIDDEN
    free = np.ones((4, 3), bool)
    free[[O, 3], I] = False
    gw, gm = np.full_like(w, 1e-6), np.full_like(moves, 1e-6)
    flat = (place * V + feat).astype(np.int64)
    cell = seg * L + pos
    truth = np.eye(3)[gold] * live[..., None]
    true_moves = np.zeros((4, 3))
    np.add.at(true_moves, (np.full(n, 3), gold[:, 0]), 1)
    pair = live[:, 1:]
    np.add.at(true_moves, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) \
        + np.log(np.exp(x - m).sum(axis))
    for _ in range(t.steps):
        e = np.zeros((n * L, 3))
        wf = w.reshape(-1, 3)
        for y in range(3):
            e[:, y] = np.bincount(cell, wf[flat, y], n * L)
        e = e.reshape(n, L, 3)
        fwd, bwd = np.zeros((n, L, 3)), np.zeros((n, L, 3))
        fwd[:, 0] = moves[3] + e[:, 0]
        for i in range(1, L):
            step = lse(fwd[:, i - 1, :, None] + moves[None, :3], 1) + e[:, i]
            fwd[:, i] = np.where(live[:, i, None], step, fwd[:, i - 1])
        for i in range(L - 2, -1, -1):
            step = lse(moves[None, :3] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], 2)
            bwd[:, i] = np.where(live[:, i + 1, None], step, 0)
        z = lse(fwd[:, -1], 1)
        prob = np.exp(fwd + bwd - z[:, None, None]) * live[..., None]
        both = np.exp(fwd[:, :-1, :, None] + moves[None, None, :3]
                      + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
        est = np.zeros((4, 3))
        est[:3] = (both * pair[..., None, None]).sum((0, 1))
        est[3] = prob[:, 0].sum(0)
        err = (truth - prob).reshape(n * L, 3)
        grad = np.stack([np.bincount(flat, err[cell, y], 5 * V) for y in range(3)], 1) \
            .reshape(5, V, 3) / n - 1e-4 * w
        gmove = np.where(free, (true_moves - est) / n, 0)
        gw += grad ** 2
        gm += gmove ** 2
        w += t.rate * grad / np.sqrt(gw)
        moves += t.rate * gmove / np.sqrt(gm)
    return Model(features, w, moves)


def training_texts(docs: DataFrame, t: Training = Training()) -> list[str]:
    """The sample: the documents with the smallest id hashes among those that
    hold a base secret, and as many among all.

    Only documents below a hash bound take part, and the bound is raised until
    enough are found, so what the tasks send does not grow with their number."""
    suspect = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}"
               r"|[0-9a-f]{24}")
    scale = 1 << 30
    rows = docs.where("text is not null").select(
        "text", F.pmod(F.xxhash64("doc_id"), F.lit(scale)).alias("h"))
    n = max(1, docs.count())

    def smallest(share: float, wanted) -> list[str]:
        below = rows.where(F.col("h") < int(min(1.0, share) * scale)).where(wanted)
        return [r.text for r in below.orderBy("h", "text").limit(t.documents).collect()]

    share = 8 * t.documents / n
    some = smallest(share, F.col("text").rlike(suspect))
    while len(some) < t.documents and share < 1:
        share *= 8
        some = smallest(share, F.col("text").rlike(suspect))
    return some + smallest(2 * t.documents / n, F.lit(True))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, counts, base_sha256, spans) of every row."""
    def join(spans) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                body = text.as_py() or ""
                base = base_spans(body)
                # Both lists are in order of their starts: one walk finds overlaps.
                extra, at, reach = [], 0, -1
                for s, e in tagger.spans(body):
                    while at < len(base) and base[at][0] < e:
                        reach = max(reach, base[at][2])
                        at += 1
                    if reach <= s:
                        extra.append((s, 3, e))
                kinds = [k for _, k, *_ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(join(base).encode()).hexdigest(),
                             join(sorted([*(x[:3] for x in base), *extra]))))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
             "base_sha256 string, spans string")


def secret_report(docs: DataFrame, t: Training = Training()) -> DataFrame:
    return scan(docs, train(training_texts(docs, t), t))
