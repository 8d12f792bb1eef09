"""License spans are verified by their words, and templates may be long."""

from weekmart.llm import licenses

WORDING = {label: text for label, text in licenses.TEMPLATES}


def test_qualified_licenses(spark):
    gpl, cc = WORDING["gpl"], WORDING["cc-by"]
    texts = {
        1: (cc, "cc-by"), 2: (cc.replace("attribution", "Attribution-NonCommercial"), "cc-by-nc"),
        3: (cc.replace("attribution", "attribution non commercial"), ""), 4: (gpl, "gpl"),
        5: (gpl.replace("gnu", "gnu lesser"), "lgpl"), 6: (gpl.replace("gnu", "gnu affero"), "agpl"),
        7: (cc.replace("attribution", "attribution noncommercial sharealike"), "cc-by-nc-sa"),
        8: (gpl.replace("redistribute it", "redistribute all of it"), "gpl"),
        9: (" zz ".join(f"{a} {b}" for a, b in zip(cc.split(), cc.split()[1:])), ""),
        10: ("please note " + cc + " some words between " + gpl.replace("gnu", "gnu lesser"), "cc-by,lgpl"),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.base_labels, r.labels) for r in licenses.license_report(docs).collect()}
    for i, (_, want) in texts.items():
        base = set(got[i][0].split(",")) - {""}
        assert set(got[i][1].split(",")) - base - {""} == set(want.split(",")) - base - {""}, (i, got[i])


def test_long_template(spark):
    words = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(1, "a " + " ".join(words[:90] + ["x"] + words[90:])),
                                  (2, " ".join(words[:120]))], "doc_id long, text string")
    got = licenses.license_report(docs, templates=(("long", " ".join(words)),)).collect()
    assert {r.doc_id: r.labels for r in got} == {1: "long", 2: ""}
