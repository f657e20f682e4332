"""License blocks: every template finds itself, look-alikes are told apart, odd rows."""

import re

import pytest
from pyspark.sql import types as T

from journeyloom.llm.licenses import CUES, TEMPLATES, candidate_blocks, scan_block, scan_licenses, scan_licenses_of

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("license", T.StringType()), T.StructField("line", T.StringType())])


@pytest.mark.parametrize("name,text,_", TEMPLATES)
def test_every_template_finds_its_license(name, text, _):
    found = scan_block(f"{text[0].upper()}{text[1:]}.")
    assert found[0] == name and found[3] == ""


def test_wording_tells_licenses_apart():
    assert scan_block("This work is licensed under the GNU General Public License, version 2.")[0] == "GPL-2.0"
    assert scan_block("This work is licensed under the GNU General Public License, version 4.")[0] is None
    assert scan_block("Licensed under CC BY 4.0.")[0] == "CC-BY-4.0"
    assert scan_block("He lost his driving license and needs permission.")[0] is None
    text = next(t for n, t, _ in TEMPLATES if n == "ISC").replace("any purpose", "all good purposes")
    name, reduction, _, missing, added = scan_block(text)
    assert name == "ISC" and reduction > 0.5 and missing == "any purpose" and added == "all good purposes"


def test_blocks_join_near_lines():
    cues = re.compile(CUES)
    text = "a\nCopyright x\nb\nc\nlicense\n" + "d\n" * 5 + "SPDX-License-Identifier: MIT"
    assert [(i, b.count("\n")) for i, b in candidate_blocks(text, cues)] == [(1, 3), (10, 0)]


def test_table_and_odd_rows(spark):
    rows = [(1, None, "x", "y"), (2, "", None, None), (3, "hello\nReleased under the MIT License.\nbye", None, None), (3, "hello\nReleased under the MIT License.\nbye", None, None), (None, "all rights reserved " * 2000, None, None)]
    got = sorted((r.doc_id or 0, r.line, r.license or "") for r in scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got[1:] == [(3, 1, "MIT"), (3, 1, "MIT")] and got[0][:2] == (0, 0)
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {(r.doc_id, r.license) for r in scan_licenses(docs).collect() if r.license}
    statements = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved": "Proprietary"}
    want = {(r.doc_id, k) for r in docs.collect() for s, k in statements.items() if s in (r.text or "")}
    assert found == want and want


PROSE = "the old mill by the river has stood there since anyone in the village can remember and its wheel still turns every spring "


@pytest.mark.parametrize("name,text,_", TEMPLATES)
def test_statements_inside_a_long_line_are_found(name, text, _):
    for before, after in ((f"{PROSE[:60]} ", ""), (PROSE * 3, PROSE), ("", PROSE * 2)):
        assert name in {r[0] for r in scan_licenses_of(f"{before}{text}. {after}")}


def test_every_license_of_a_block_is_a_row(spark):
    text = "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."
    rows = scan_licenses(spark.createDataFrame([(1, text, "x", "y"), (2, PROSE + text.replace("\n", f" {PROSE}"), "x", "y")], SCHEMA)).collect()
    assert sorted((r.doc_id, r.license) for r in rows) == [(1, "Apache-2.0"), (1, "MIT"), (2, "Apache-2.0"), (2, "MIT")]
    assert scan_block(f"{PROSE}licensed under the GNU General Public License, version 4. {PROSE} 3")[0] is None
