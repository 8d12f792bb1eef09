"""The stop-word rule applies only where the list knows the language."""

from weekmart.llm import quality_rules


def test_other_languages_are_kept(spark):
    def clean(stem):
        return " ".join(f"{stem}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))

    russian, greek = clean("слово"), clean("λόγος")
    noise = clean("xq")
    rows = [(1, russian, "ru"), (2, greek, None), (3, clean("kelime"), "tr"), (4, noise, "en"),
            (5, noise, None), (6, noise, "EN-us"), (7, russian, ""), (8, noise + " the of and", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: True, 8: True}
    got = {r.doc_id: r.kept for r in quality_rules.quality_report(docs).collect()}
    assert got == want
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {d for d, k in want.items() if k}
    bare = quality_rules.quality_report(docs.drop("lang")).collect()
    assert {r.doc_id for r in bare if r.kept} == {1, 2, 7, 8}
