"""Licence scan: equal forms, entire texts only, and its SQL."""

from tidemark.llm import licenses
from tidemark.llm.queries import QUERIES, SQL

DOCS = "doc_id long, text string, digest string, whole string, row long"

MIT_WHOLE = "Permission is hereby granted, free of charge, to any person whilst they fulfil the licence.\nTHE SOFTWARE IS PROVIDED \"AS IS\"."


def scan(spark, rows, known=None):
    docs = spark.createDataFrame([(i, t, "x", "y", 3) for i, t in rows], DOCS)
    return sorted((tuple(r) for r in licenses.scan(docs, licenses.known_licenses(spark, known)).collect()), key=str)


def test_equal_forms(spark):
    same = ["Released under the MIT License.", "released under the mit licence", "  RELEASED under -- the 'MIT' License!!  ", "* Released\tunder the MIT License"]
    assert scan(spark, list(enumerate(same))) == [(i, "MIT", 1, True) for i in range(4)]
    whole = [MIT_WHOLE, "Copyright (c) 2020 Someone\n" + MIT_WHOLE.replace("whilst", "while").replace("licence", "LICENSE"), "// © 2021 A. B.\n\n" + MIT_WHOLE.upper().replace("FULFIL ", "FULFILL "),
             MIT_WHOLE.replace("free", "not free"), "Copyright law " + MIT_WHOLE]
    assert [r[3] for r in scan(spark, list(enumerate(whole)), [("X", MIT_WHOLE)])] == [True, True, True, False, False]


def test_lines_and_entire_texts(spark):
    rows = [(1, "Some text.\nAll rights reserved.\nMore text."), (2, "Some text. All rights reserved."), (3, "All rights reserved.\r\nALL RIGHTS RESERVED\nReleased under the MIT License."),
            (4, "Licensed under CC BY-NC 4.0.\n" + "word " * 50000), (5, "All rights reserved")]
    assert scan(spark, rows) == [(1, "ARR", 1, False), (2, "", 0, False), (3, "ARR,MIT", 2, False), (4, "CC-BY-NC-4.0", 1, False), (5, "ARR", 1, True)]


def test_odd_rows(spark):
    rows = [(None, "All rights reserved"), (1, None), (2, ""), (3, " \n . \n"), (4, "Copyright 2020 X"), (5, "All rights reserved"), (5, "All rights reserved")]
    got = scan(spark, rows)
    assert got == sorted([(None, "ARR", 1, True), (1, "", 0, False), (2, "", 0, False), (3, "", 0, False), (4, "", 0, False), (5, "ARR", 1, True), (5, "ARR", 1, True)], key=str)
    assert [r[1] for r in scan(spark, rows, [])] == [""] * 7
    assert scan(spark, []) == []


def test_documents_match_sql(spark):
    from oracle import compare, duck
    name, folder = "op5_license_scans", "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), folder, QUERIES[name], SQL[name]) is None
    df = QUERIES[name](spark, folder)
    assert df.where("n_lines > 0").count() > 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_full_texts_and_blocks(spark):
    texts = dict(reversed([(x, t) for x, t in licenses.licence_texts()]))
    mit, apache = texts["MIT"], texts["Apache-2.0"]
    commented = "".join(f" * {line}\n" for line in mit.splitlines())
    wrapped = "This project is licensed under\nthe terms of the MIT license."
    rows = [(1, "MIT License\n\nCopyright (c) 2020 Someone\n\n" + mit), (2, apache), (3, "int x;\n/*\n" + commented + " */\nint y;"), (4, f"Some text.\n\n{wrapped}\n\nMore text."),
            (5, f"x = 1\n# {wrapped.replace(chr(10), chr(10) + '# ')}\ny = 2"), (6, f"Read this.\n\n{mit}\n\nAnd this."), (7, f"Some text,\n{wrapped}\n\nMore text."), (8, "\n \n" * 20000)]
    got = scan(spark, rows)
    assert [(r[0], r[1], r[3]) for r in got] == [(1, "MIT", True), (2, "Apache-2.0", True), (3, "MIT", False), (4, "MIT", False), (5, "MIT", False), (6, "MIT", False), (7, "", False), (8, "", False)]
    ids = {"MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"}
    assert ids <= {x for x, _ in licenses.licence_texts()}
