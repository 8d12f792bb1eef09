"""Plain Python statements of the queries' results, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def spaced(text):
    return SPACE.findall(text or "")


def simhash(docs):
    """doc rows (id, text) -> {index: (fingerprint hex, component id)}."""
    prints = []
    for _, text in docs:
        words = spaced((text or "").translate(LOWER))
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        ones = [0] * 64
        for g in grams:
            h = xxhash.xxh64_intdigest(g.encode(), 42)
            for b in range(64):
                ones[b] += h >> b & 1
        prints.append(sum(1 << b for b in range(64) if 2 * ones[b] > len(grams)))
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[root(i)].append(d)
    return [(f"{p:016x}", min((x for x in least[root(i)] if x is not None), default=None))
            for i, p in enumerate(prints)]


def decontaminate(docs, items, size=10):
    wins = defaultdict(set)
    for item, text in items:
        words = alnum(text)
        if words and item is not None:
            for i in range(max(1, len(words) - size + 1)):
                wins[tuple(words[i:i + size])].add(str(item))
    lengths = sorted({len(w) for w in wins})
    out = []
    for d, text in docs:
        words = alnum(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                w = tuple(words[i:i + n])
                if w in wins:
                    hit.update(range(i, i + n))
                    found |= wins[w]
        out.append((d, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def near_items(docs, items, size=10, span=20, missing=1, least=5):
    """Per document the items with an exact window, or with a window of ``least`` distinct
    words all but ``missing`` of which stand in a stretch of ``span`` words."""
    wins = defaultdict(set)
    for item, text in items:
        words = alnum(text)
        if words and item is not None:
            for i in range(max(1, len(words) - size + 1)):
                wins[tuple(words[i:i + size])].add(str(item))
    out = []
    for d, text in docs:
        words = alnum(text)
        found = set()
        stretches = [set(words[i:i + span]) for i in range(max(1, len(words)))]
        for w, ids in wins.items():
            if ids <= found:
                continue
            need = len(set(w)) - missing
            exact = any(tuple(words[i:i + len(w)]) == w for i in range(len(words) - len(w) + 1)) \
                if set(w) <= set(words) else False
            if exact or (len(set(w)) >= least and len(set(w) & set(words)) >= need
                         and any(len(s.intersection(w)) >= need for s in stretches)):
                found |= ids
        out.append((d, len(found), sha(",".join(sorted(found)))))
    return out


def substring(docs, size=50):
    first = {}
    for d, text in docs:
        w = spaced(text)
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    out = []
    for d, text in docs:
        w = spaced(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i:i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def quality(text):
    w = spaced(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    covered = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def licenses(text, phrases):
    w = alnum(text)
    places = [(i, label) for label, p in phrases for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in places})))


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in
             re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in
              re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and _luhn(d):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    found.sort()
    names = ("email", "ip", "card", "phone")
    return ([sum(k == i for _, k, _ in found) for i in range(4)],
            sha(",".join(f"{names[k]}:{s}:{e}" for s, k, e in found)))


def secrets(text):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.ASCII | re.IGNORECASE)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    names = ("assign", "access", "hex")
    return ([sum(k == i for _, k, _ in found) for i in range(3)],
            [f"{names[k]}:{s}:{e}" for s, k, e in found])


def warc(pages, least=1000):
    owner = {}
    for p, _, html in pages:
        b = (html or "").encode()
        if p is not None:
            owner[b] = max(owner.get(b, p), p)
    out = []
    for p, _, html in pages:
        b = (html or "").encode()
        revisit = len(b) >= least and b in owner and owner[b] != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response",
                    owner[b] if revisit else None))
    return out


def url(text, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", text or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, v)
    return host, path, best
