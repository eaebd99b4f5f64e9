import re

from parcelmart.llm.licence_texts import LICENCE_FILES, LICENCE_TEXTS, MORE_NOTICES, NOTICES
from parcelmart.llm.license_scan import known_texts, scan_licences

SCHEMA = "doc_id long, text string, digest string, licence string, name string"


def scan(spark, rows, known=None):
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    texts = spark.createDataFrame(list(LICENCE_TEXTS.items()) if known is None else known, "name string, text string")
    return scan_licences(docs, texts)


def test_known_texts_in_other_dress(spark):
    mit, zlib = LICENCE_TEXTS["MIT"], LICENCE_TEXTS["Zlib"]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2020 A. N. Other\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENCE")),
        (3, "# © 1999-2001 Someone, all rights reserved\n# All rights reserved.\n" + mit.replace("\n", "\n# ")),
        (4, " ".join(zlib.replace("acknowledgment", "acknowledgement").replace("'", "“").split())),
        (5, mit + "\nAnd one more thing."),
        (6, mit[:-20]),
        (7, LICENCE_TEXTS["Unlicense"].replace("recognize", "recognise").replace("https", "http")),
    ]
    got = {r.doc_id: r.licence for r in scan(spark, rows).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: "Zlib", 5: None, 6: None, 7: "Unlicense"}


def test_copyright_notice_in_the_text_is_no_copyright_line(spark):
    rows = [(1, "copyright notice stays\nx"), (2, "x"), (3, "Copyright 2001 gone\nx")]
    digests = {r.doc_id: r.digest for r in scan(spark, rows).collect()}
    assert digests[2] == digests[3] != digests[1]


def test_notices(spark):
    rows = [(1, "text\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n"), (2, "it is Released under the MIT License."), (3, "released UNDER the mit license")]
    assert {r.doc_id: r.notices for r in scan(spark, rows).collect()} == {1: "CC-BY-NC-4.0,MIT", 2: "", 3: "MIT"}


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n!?"), (None, "word"), (4, "word"), (4, "word"), (5, "Wörter " * 50000)]
    got = [tuple(r) for r in scan(spark, rows).collect()]
    assert len(got) == len(rows)
    assert {i: d for i, d, _, _ in got if i in (1, 2, 3)} == {1: None, 2: None, 3: None}
    assert len({d for i, d, _, _ in got if i in (None, 4)}) == 1
    assert scan(spark, []).collect() == [] and scan(spark, rows, []).count() == len(rows)
    twice = [("b", "one text"), ("a", "One text!"), ("c", ""), (None, None)]
    assert [r.licence for r in scan(spark, [(1, "one  text")], twice).collect()] == ["a"]


def test_no_python_in_the_plan(spark):
    assert not re.search("Python|Arrow|Pandas", scan(spark, [(1, "x")])._jdf.queryExecution().executedPlan().toString())


def published(spark, rows, more=(), **options):
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    return {r.doc_id: r for r in scan_licences(docs, known_texts(spark, more), **options).collect()}


def test_long_texts_are_known(spark):
    files = sorted(LICENCE_FILES.glob("*.txt"))
    assert {"Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"} <= {f.stem for f in files}
    got = published(spark, [(k, re.sub(r"\blicense\b", "licence", f.read_text()).replace("\n", "\r\n")) for k, f in enumerate(files)])
    assert [got[k].licence for k in range(len(files))] == [f.stem for f in files]
    apache = (LICENCE_FILES / "Apache-2.0.txt").read_text()
    cut = apache[: apache.index("APPENDIX")]
    got = published(spark, [(1, cut), (2, apache[:5000]), (3, "House rules: ask first."), (4, "use it as you like")], [("House-1", "house rules ask first")], notices=NOTICES | {"Use it as you like.": "Own"})
    assert [got[k].licence for k in (1, 2, 3)] == ["Apache-2.0", None, "House-1"] and got[4].notices == "Own"


def test_more_notices(spark):
    lines = {**NOTICES, **MORE_NOTICES}
    got = published(spark, enumerate(lines))
    assert [got[k].notices for k in range(len(lines))] == list(lines.values())
    assert {r.notices for r in published(spark, enumerate(lines), notices={}).values()} == {""}


def test_published_files_with_titles_and_holders(spark):
    mit, isc, bsd, zlib = (LICENCE_TEXTS[k] for k in ("MIT", "ISC", "BSD-3-Clause", "Zlib"))
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 X\n\n" + mit),
        (2, "The MIT Licence (MIT)\r\n\r\nCopyright Foo Inc. and contributors\r\n\r\n" + mit),
        (3, "ISC License\n\nCopyright (c) 2004-2010 by X\nCopyright: The X Authors\n\n" + isc),
        (4, "BSD 3-Clause License\n\nCopyright contributors to the X project\nAll rights reserved.\n\n" + bsd),
        (5, "zlib License\n\n(C) 1995 Someone\n\n" + zlib),
        (6, "Some License\n\nCopyright (c) 2020 X\n\n" + mit),
        (7, "/* Copyright Foo Inc. */\n" + bsd.replace("1. ", " * ").replace("2. ", " * ").replace("3. ", " * ")),
        (8, (LICENCE_FILES / "CC0-1.0.txt").read_text().replace("Creative Commons Legal Code", "")),
    ]
    got = published(spark, rows)
    assert [got[k].licence for k in range(1, 9)] == ["MIT", "MIT", "ISC", "BSD-3-Clause", "Zlib", None, "BSD-3-Clause", "CC0-1.0"]


def test_lines_of_the_law_are_no_holder_lines(spark):
    kept = ["Copyright License grants", "Copyright Holder means", "Copyright and Related Rights", "COPYRIGHT HOLDERS BE LIABLE", "copyright x", "A Copyright Foo Inc."]
    got = published(spark, [(0, "x")] + [(k, line + "\nx") for k, line in enumerate(kept, 1)])
    assert len({r.digest for r in got.values()}) == len(kept) + 1


def test_notices_in_other_spellings(spark):
    rows = [(1, "Released under the MIT Licence."), (2, "Licensed under the Apache Licence, Version 2.0."), (3, "it is Released under the MIT Licence.")]
    got = published(spark, rows, notices=NOTICES | {"Under the House Offence Licence.": "House"})
    assert [got[k].notices for k in (1, 2, 3)] == ["MIT", "Apache-2.0", ""]
    assert published(spark, [(1, "under the house offense license")], notices={"Under the House Offence Licence.": "House"})[1].notices == "House"
