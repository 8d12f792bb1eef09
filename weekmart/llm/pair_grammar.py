"""Re-Pair over the ids of one shard: rules, expansion and a byte format with
random access (NumPy, used inside tasks).

A round counts all neighbouring pairs and replaces the frequent ones by new
symbols; a pair gives way to a more frequent one that overlaps it, and in a run
of one symbol every second place is taken.  Rounds start at high counts, so that
the most frequent pairs become rules first; the last count is repeated until a round
saves less than ``WORTH`` of the symbols.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"PGR1"
HEAD = "<4sIqqqqqI"                   # magic, crc of the rest, documents, ids, symbols, rules, base, bits
THRESHOLDS = (1024, 256, 64, 16, 4)  # occurrences a pair needs, round by round
LEAST = 4                            # replacements that pay for a rule
WORTH = 0.05                         # part of the symbols that a further round must save
SAMPLE = 64                          # symbols between stored positions


def _frequent(seq: np.ndarray, turn: int, least: int):
    """Places of frequent pairs, their bucket and how often each bucket is used.
    Pairs meet in hash buckets; a bucket serves one pair a round."""
    bits = min(max(10, int(len(seq)).bit_length() - 1), 31)
    odd = (0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * 2 * turn) & 0xFFFFFFFFFFFFFFFF
    symbols = seq.view(np.uint32)
    mixed = symbols[:-1] * np.uint32(odd >> 32 | 1)
    mixed += symbols[1:] * np.uint32(odd & 0xFFFFFFFF)
    mixed >>= np.uint32(32 - bits)
    bucket = mixed.astype(np.int64)
    # A table of bits stays in the processor's cache, one of counts does not.
    at = np.flatnonzero((np.bincount(bucket, minlength=1 << bits) >= least)[bucket])
    b = bucket[at]
    k = (seq[at].astype(np.int64) << 32) | seq[at + 1]
    holder = np.empty(1 << bits, np.int64)
    holder[b] = k
    mine = holder[b] == k
    at, b = at[mine], b[mine]
    count = np.bincount(b, minlength=1 << bits)[b]
    often = count >= least
    return at[often], b[often], count[often], holder, bits


def compress(ids: np.ndarray, base: int, thresholds=THRESHOLDS) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): symbol ``base + r`` stands for the pair ``rules[r]``
    (left << 32 | right); rules refer to earlier symbols only."""
    seq, rules, following = ids.astype(np.int32), [], base
    turn, before = 0, 0
    while len(seq) > 1 and (turn < len(thresholds) or len(seq) < (1 - WORTH) * before):
        least, before, turn = thresholds[min(turn, len(thresholds) - 1)], len(seq), turn + 1
        at, bucket, count, holder, bits = _frequent(seq, turn, least)
        if not len(at):
            continue
        own = (count << bits) | bucket
        # The pairs that overlap a pair stand beside it in ``at``.
        beside = at[1:] == at[:-1] + 1
        left, right = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        np.multiply(own[:-1], beside, out=left[1:])
        np.multiply(own[1:], beside, out=right[:-1])
        run = np.maximum.accumulate(np.where(left == own, 0, np.arange(len(at))))
        second = (np.arange(len(at)) - run) & 1
        wins = (second == 0) & (own >= left) & (own >= right)
        at, bucket = at[wins], bucket[wins]
        used = np.bincount(bucket, minlength=1 << bits) >= LEAST
        pays = used[bucket]
        at, bucket = at[pays], bucket[pays]
        made = np.flatnonzero(used)
        if not len(made):
            continue
        rules.append(holder[made])
        holder[made] = following + np.arange(len(made))
        following += len(made)
        seq[at] = holder[bucket]
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        seq = seq[stays]
    return seq.astype(np.int64), np.concatenate(rules) if rules else np.zeros(0, np.int64)


def lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule's symbol stands for."""
    out, todo = np.zeros(len(rules), np.int64), np.arange(len(rules))
    left, right = rules >> 32, rules & 0xFFFFFFFF
    while len(todo):
        size = np.zeros(len(todo), np.int64)
        known = np.ones(len(todo), bool)
        for side in (left[todo], right[todo]):
            part = np.where(side < base, 1, out[np.maximum(side - base, 0)])
            known &= part > 0
            size += part
        out[todo[known]] = size[known]
        todo = todo[~known]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    seq = symbols
    while True:
        nested = seq >= base
        if not nested.any():
            return seq
        sizes = nested + np.int64(1)
        place = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int64)
        out[place] = seq
        pair, place = rules[seq[nested] - base], place[nested]
        out[place], out[place + 1] = pair >> 32, pair & 0xFFFFFFFF
        seq = out


def expand_all(symbols: np.ndarray, rules: np.ndarray, span: np.ndarray, base: int) -> np.ndarray:
    """``expand`` for many symbols: each rule is expanded once, then looked up."""
    texts = np.concatenate([expand(base + np.arange(len(rules)), rules, base), np.arange(base)])
    size = np.concatenate([np.ones(base, np.int64), span.astype(np.int64)])
    start = np.concatenate([int(span.sum()) + np.arange(base), np.cumsum(size[base:]) - size[base:]])
    count = size[symbols]
    source = np.repeat(start[symbols] - (np.cumsum(count) - count), count)
    source += np.arange(len(source))
    return texts.astype(np.int32)[source]


def _pack(values: np.ndarray, bits: int) -> bytes:
    as_bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1,
                            count=bits, bitorder="little")
    return np.packbits(as_bits.ravel(), bitorder="little").tobytes()


def _unpack(packed: np.ndarray, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` values from value ``start`` (a multiple of 8) on."""
    rows = max(1, -(-count // 8))       # eight values fill ``bits`` whole bytes
    raw = np.zeros(rows * bits + 8, np.uint8)
    part = packed[start * bits // 8:start * bits // 8 + rows * bits]
    raw[:len(part)] = part
    out = np.empty((rows, 8), np.int64)
    for i in range(8):
        words = np.ndarray((rows,), "<u8", raw, i * bits // 8, (bits,))
        out[:, i] = (words >> np.uint64(i * bits % 8)) & np.uint64((1 << bits) - 1)
    return out.ravel()[:count]


def encode_shard(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, base: int) -> bytes:
    """The bytes of a shard: documents with their number of ids, rules with their
    expansion lengths, sampled positions, and the symbols at fixed width."""
    symbols, rules = compress(ids, base)
    span = lengths(rules, base)
    bits = max(1, int(base + len(rules)).bit_length())
    ends = np.cumsum(np.where(symbols < base, 1, span[np.maximum(symbols - base, 0)] if len(rules) else 1))
    starts = np.concatenate([[0], ends])[:-1][::SAMPLE]
    body = b"".join([
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), sizes.astype("<i8").tobytes(),
        rules.astype("<i8").tobytes(), span.astype("<u4").tobytes(),
        starts.astype("<i8").tobytes(), _pack(symbols, bits)])
    head = struct.pack(HEAD, MAGIC, 0, len(doc_ids), len(ids), len(symbols), len(rules), base, bits)
    return struct.pack(HEAD, MAGIC, zlib.crc32(body, zlib.crc32(head[8:])), *struct.unpack(HEAD, head)[2:]) + body


class Shard:
    """A shard's bytes, read in place; damaged bytes raise."""

    def __init__(self, data):
        data = memoryview(data)
        magic, crc, docs, self.n_ids, self.n_symbols, n_rules, self.base, self.bits = \
            struct.unpack_from(HEAD, data)
        if magic != MAGIC or zlib.crc32(data[8:]) != crc:
            raise ValueError("a token shard's bytes are damaged")
        at = struct.calcsize(HEAD)

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.has_id, self.doc_ids, self.sizes = take(np.uint8, docs), take("<i8", docs), take("<i8", docs)
        self.rules, self.span = take("<i8", n_rules), take("<u4", n_rules)
        self.samples = take("<i8", -(-self.n_symbols // SAMPLE))
        self.packed = np.frombuffer(data, np.uint8, -1, at)
        self.offsets = np.cumsum(self.sizes) - self.sizes

    def ids(self) -> np.ndarray:
        symbols = _unpack(self.packed, self.bits, 0, self.n_symbols)
        return expand_all(symbols, self.rules, self.span, self.base)

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` .. ``start + count`` without expanding the rest."""
        if count <= 0:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.samples, start, "right")) - 1
        b = int(np.searchsorted(self.samples, start + count, "left"))
        first, last = a * SAMPLE, min(b * SAMPLE, self.n_symbols)
        symbols = _unpack(self.packed, self.bits, first, last - first)
        size = np.ones(len(symbols), np.int64)
        nested = symbols >= self.base
        size[nested] = self.span[symbols[nested] - self.base]
        ends = np.cumsum(size) + self.samples[a]
        i = int(np.searchsorted(ends, start, "right"))
        j = int(np.searchsorted(ends, start + count, "left")) + 1
        skip = start - int(ends[i] - size[i])
        return expand(symbols[i:j], self.rules, self.base)[skip:skip + count]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.offsets[k]), int(self.sizes[k]))
