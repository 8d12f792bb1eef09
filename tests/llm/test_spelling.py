"""Near words and their groups against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weekmart.llm import spelling as S
from weekmart.llm.variant_index import VariantIndex

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def near_words(words):
    """Near words by one-wildcard and deletion keys."""
    near, wild = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            wild[w[:i], w[i + 1:]].add(w)
            d = w[:i] + w[i + 1:]
            if d in words and d != w:
                near[w].add(d)
                near[d].add(w)
    for group in wild.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near, form = near_words(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def report(df):
    return [tuple(r) for r in S.spelling_report(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_given_documents(docs, rows):
    got = report(docs.withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("run", F.lit(0)))
    want = brute(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] for r in got)


def test_groups_and_chains(spark, empty):
    rng = random.Random(1)
    text = []
    for base, count in [("abcdef", 5), ("abcdefg", 45), ("abcdefgh", 300), ("abcdéfgh", 5), ("aaaaaa", 6), ("aaaaaaa", 6),
                        ("aaaaaab", 30), ("baaaaaa", 30), ("short", 99), ("rare" * 3, 4), ("z" * 4000, 7), ("z" * 3999, 50)]:
        text += [base] * count
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::7])) for i in range(7)] + [(None, None), (8, ""), (None, "abcdef ABCDEF")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = report(df)
    assert set(got) == brute(rows) and len(got) == len(set(got))
    by = {r[0]: r for r in got}
    assert by["abcdef"][2] == "abcdefgh" and by["aaaaaaa"][1] == "aaaaaab"
    assert report(empty) == []


def test_hot_keys_are_sliced_without_loss(spark):
    rng = random.Random(3)
    words = sorted({"pre" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(500)}
                   | {"".join(rng.choice("abc") for _ in range(4)) + "ing" for _ in range(60)})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    want = {(a, b) for a, bs in near_words(set(words)).items() for b in bs}
    for hot in (40, 10_000):
        got = [(r.word, r.near) for r in S.near_pairs(df, hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    largest = S.dealt(df, F.substring("word", 1, 3), 40).where("indexed").groupBy("group", "i", "j").count()
    assert largest.where("group like '=%'").agg(F.max("count")).first()[0] < 80


@pytest.mark.parametrize("seed", range(10))
def test_index_finds_every_word_at_one_error(seed):
    rng = random.Random(seed)
    letters = "abé漢"[:rng.randint(1, 4)]
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(80)})
    index = VariantIndex(words)
    queries = words + ["zzzzz", "aaaaaaaz", "baab"]
    found = set()
    for second in (True, False):
        for q, w in zip(*(x.tolist() for x in index.search(queries, second))):
            if second:
                assert words[w].startswith(queries[q][:len(queries[q]) // 2])
            found.add((q, w))
    assert found == {(q, w) for q, a in enumerate(queries) for w, b in enumerate(words) if len(a) > 1 and one_apart(a, b)}
