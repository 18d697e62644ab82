import duckdb
import pytest

from lakemart.llm import license_scan
from lakemart.llm.queries import ORACLE, op7_licenses


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.execute(ORACLE["op7_licenses"]).fetchall()
    got = [tuple(r) for r in op7_licenses(spark, path).collect()]
    assert sorted(got) == sorted(want) and got


def test_every_template_is_found_anywhere(spark):
    texts = [
        (i * 10 + k, "lorem " * pad + text + " ipsum" * 7, name, True)
        for i, (name, text) in enumerate(license_scan.TEMPLATES.items()) for k, pad in enumerate((0, 3, 9, 29))]
    docs = spark.createDataFrame(texts, "doc_id long, text string, license string, template boolean")
    got = {(r.doc_id, r.license): r.containment for r in license_scan.scan(docs).collect()}
    assert all(got.get((t[0], t[2])) == 1.0 for t in texts)


def test_damaged_and_corner_cases(spark):
    long = license_scan.TEMPLATES["MIT-grant"]
    rows = [(1, long.replace("deal in", "handle"), 0), (2, long[: len(long) // 2], 0), (3, None, 0), (4, "", 0),
            (5, "license", 0), (None, "RELEASED under the mit-license!", 0), (6, long, 0), (6, long, 0),
            (7, "license " * 20_000 + license_scan.TEMPLATES["MIT"], 0)]
    got = sorted(((r.doc_id, r.license) for r in license_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string, license int")).collect()), key=str)
    assert got == sorted([(1, "MIT-grant"), (6, "MIT-grant"), (None, "MIT"), (7, "MIT")], key=str)
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_match_is_without_anchor():
    words = set(license_scan.anchors(license_scan.TEMPLATES, 3, 0.8))
    for text in license_scan.TEMPLATES.values():
        w = license_scan.tokens_of(text)
        every = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
        assert sum(words.isdisjoint(s) for s in every) < 0.2 * len(every)


def test_plan_is_native(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    plan = license_scan.scan(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_usual_wordings_reach_their_license(spark):
    wordings = {
        1: ("MIT", "Copyright 2020. This code is licensed under the MIT license, see LICENSE."),
        2: ("Apache-2.0", "You may use it: licensed under the Apache License 2.0 (see NOTICE)"),
        3: ("GPL-2.0", "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU"
            " General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n#"
            " (at your option) any later version."),
        4: ("AGPL-3.0", "licensed under the GNU Affero General Public License (version 3)"),
        5: ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby"
            " granted, provided that the above copyright notice and this permission notice appear in all copies."),
        6: ("MPL-2.0", "// SPDX-License-Identifier: MPL-2.0"),
        7: ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
            " promote products derived from this work without specific prior written permission."),
        8: ("Unlicense", "This is free and unencumbered software released into the public domain!"),
        9: ("CC-BY-NC-SA-4.0", "This article is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0"
            " International License."),
    }
    docs = spark.createDataFrame([(i, "lorem ipsum " * i + t) for i, (_, t) in wordings.items()], "doc_id long, text string")
    best = {}
    for r in license_scan.scan(docs).collect():
        best[r.doc_id] = max(best.get(r.doc_id, (0, "")), (r.containment, r.license))
    assert {i: name for i, (_, name) in best.items() if not name.startswith(wordings[i][0])} == {}
    assert set(best) == set(wordings)
    assert len(license_scan.TEMPLATES) >= 50
