from pyspark.sql import functions as F

from harvestline.llm import licenses

from .helpers import docs, long_text

MIT = licenses.KNOWN[0][1]


def found_in(spark, rows, **how):
    found = licenses.find_licenses(docs(spark, rows), **how).collect()
    return sorted((str(r.doc_id), r.unit, r.line, r.license) for r in found)


def test_a_licence_is_known_in_other_dress(spark):
    dressed = (
        "/* Copyright (c) 2019 Some One\n * All rights reserved. */\n\n"
        + MIT.upper().replace("SUBLICENSE", "sub-licence").replace("\n", "\r\n * ")
    )
    british = "© 1999 A\n" + MIT.replace("copyright holders", "copyright owners")
    rows = [(1, dressed), (2, british), (3, MIT + " More."), (4, MIT), (4, MIT), (None, MIT)]
    assert found_in(spark, rows) == [
        *[(str(i), "text", -1, "MIT") for i in (1, 2, 4, 4)],
        ("None", "text", -1, "MIT"),
    ]


def test_notices_by_line(spark):
    rows = [
        (1, long_text(20) + "\n# licensed under the APACHE licence, version 2.0\nend"),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "We say: Licensed under CC BY-NC 4.0. So there."),
        (4, None),
        (5, ""),
        (6, "Copyright 2020 X\n--\n"),
        (7, long_text(60_000) + "\nReleased under the MIT License."),
    ]
    assert found_in(spark, rows) == [
        ("1", "line", 1, "Apache-2.0"),
        ("2", "line", 0, "CC-BY-NC-4.0"),
        ("2", "text", -1, "CC-BY-NC-4.0"),
        ("7", "line", 1, "MIT"),
    ]


def test_own_texts_clashing_columns_and_no_rows(spark):
    known = licenses.known_digests(spark, [("B", "Same Text"), ("A", "same text!"), ("C", "other")])
    frame = docs(spark, [(1, "same TEXT")]).withColumns({"license": F.lit(1), "digest": F.lit(2)})
    rows = licenses.find_licenses(frame, known).collect()
    got = sorted((r.doc_id, r.unit, r.license) for r in rows)
    assert got == [(1, "line", "A"), (1, "text", "A")]
    assert found_in(spark, []) == []
