import hashlib

from gradeloom.llm.license_digest import KNOWN, known_licenses, scan_licenses

SCHEMA = "doc_id long, text string, digest string, license int"
MIT = KNOWN["MIT"][3]


def run(spark, rows):
    found = scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r["doc_id"]: (r["text_license"], r["line_licenses"], r["n_license_lines"]) for r in found}


def test_equivalent_texts_meet(spark):
    texts = [
        MIT,
        "Copyright (c) 2020 Someone\n\n" + MIT.upper().replace(",", " ,\n"),
        MIT.replace("NONINFRINGEMENT", "non-infringement").replace("sublicense", "sub-license"),
        "LICENSED under the Apache Licence -- version 2.0",
        "Some prose here.\n  * licensed under the apache license, version 2.0 *\nMore prose.\nReleased under the MIT license",
        MIT.replace("free of charge", "for a fee"),
        "This is not under the MIT License or so.",
    ]
    found = run(spark, [(i, t, "clash", 0) for i, t in enumerate(texts)])
    assert [found[i][0] for i in range(7)] == ["MIT", "MIT", "MIT", "Apache-2.0", None, None, None]
    assert found[4][1:] == ("Apache-2.0,MIT", 2) and found[3][1:] == ("Apache-2.0", 1) and found[6][1:] == (None, 0)


def test_edges(spark):
    rows = [(1, None, "", 0), (2, "", "", 0), (3, "© 2020 A\nAll rights reserved.", "", 0), (4, "word " * 100_000, "", 0), (None, "MIT License", "", 0), (None, "MIT License", "", 0)]
    found = scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 6
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["doc_id"] for r in found if r["text_digest"] == empty} == {1, 2, 3}
    assert [r["text_license"] for r in found if r["doc_id"] is None] == ["MIT"] * 2
    assert run(spark, []) == {}


def test_a_text_under_two_names(spark):
    known = known_licenses(spark, {"A": ("some terms",), "B": ("Some TERMS.",)})
    found = scan_licenses(spark.createDataFrame([(1, "some terms", "", 0)], SCHEMA), known).first()
    assert found["text_license"] == "A,B"
