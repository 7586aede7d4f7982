import re

from pyspark.sql import functions as F

from driftmend.llm.licenses import LICENSES, canonical, license_digests

MIT = dict(LICENSES)["MIT"]


def test_canonical_forms_agree(spark):
    same = [
        ("Licensed under the  Apache License, Version 2.0.", " * licenced UNDER the “Apache Licence”; version 2.0"),
        ("Copyright (c) 2020 Someone", ""),
        ("© 1999-2003 A. Author. All rights reserved.", ""),
        ("see https://example.org", "See HTTP example.org"),
        ("the copyright owner's favour", "The Copyright Holder s favor"),
    ]
    rows = spark.createDataFrame(same, "a string, b string").select(canonical(F.col("a")), canonical(F.col("b"))).collect()
    assert all(r[0] == r[1] for r in rows)
    kept = spark.createDataFrame([("The above copyright notice",)], "a string").select(canonical(F.col("a"))).first()[0]
    assert kept == "the above copyright notice"


def test_whole_texts_and_notices(spark, documents):
    other = "Copyright (c) 2024 Someone\n\n" + MIT.upper().replace(". ", ".\n").replace("LICENSE", "LICENCE")
    rows = [(1, MIT), (2, other), (2, other), (3, MIT + " and more"), (4, "text\nLicensed under CC BY-NC 4.0.\n\nReleased under the MIT licence"), (5, None), (6, ""), (None, "x")]
    found = sorted((str(r.doc_id), str(r.license), r.n_notices, r.notices) for r in license_digests(documents(rows)).collect())
    assert found == [
        ("1", "MIT", 0, ""), ("2", "MIT", 0, ""), ("2", "MIT", 0, ""), ("3", "None", 0, ""),
        ("4", "None", 2, "2:CC-BY-NC-4.0,4:MIT"), ("5", "None", 0, ""), ("6", "None", 0, ""), ("None", "None", 0, ""),
    ]


def test_every_known_text_is_found_and_none_twice(spark, documents):
    rows = list(enumerate(text for _, text in LICENSES))
    assert {r.doc_id: r.license for r in license_digests(documents(rows)).collect()} == {i: name for i, (name, _) in enumerate(LICENSES)}


def test_long_texts_empty_table_and_no_python(spark, documents):
    found = license_digests(documents([(1, "line of text\n" * 20_000 + "SPDX-License-Identifier: MIT")])).first()
    assert found.notices == "20001:MIT"
    result = license_digests(documents([]))
    assert result.collect() == []
    assert not re.search("Python|Pandas|Arrow", result._jdf.queryExecution().executedPlan().toString())


def test_long_licences_headers_and_tables_of_ones_own(spark, documents):
    from driftmend.llm.licenses import END, TEXTS

    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "Unlicense", "BSL-1.0"]
    texts = [(TEXTS / f"{name}.txt").read_text("utf-8") for name in names]
    header = '# Copyright 2020 Someone\n#\n# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file'
    rows = [*enumerate(texts), (100, "  " + texts[0].partition(END)[0].replace("\n", "\r\n") + END), (101, header)]
    found = {r.doc_id: r for r in license_digests(documents(rows)).collect()}
    assert [found[i].license for i in range(len(names))] == names
    assert found[100].license == "Apache-2.0" and found[101].notices == "3:Apache-2.0"
    known = spark.createDataFrame([(0, "Own-1.0", "Do  as you please."), (1, "Own-1.0", "Under Own 1.0"), (0, "Other", "do as you please")], "part int, license string, text string")
    found = license_digests(documents([(1, "Do as YOU please"), (2, "x\nunder own 1.0"), (3, texts[0])]), known).collect()
    assert sorted((r.doc_id, r.license, r.notices) for r in found if r.doc_id < 3) == [(1, "Other", ""), (2, None, "2:Own-1.0")]
    assert next(r for r in found if r.doc_id == 3).license is None
