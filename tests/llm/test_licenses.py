import collections
import re

from pyspark.sql import functions as F

from tablemargin.llm import licenses
from tablemargin.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
# The notices that the shared documents hold, and the families they name.
KNOWN = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
         "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
         "All rights reserved.": "all-rights-reserved"}


def test_query_against_a_search_for_the_notices(spark):
    got = {r.doc_id: r for r in QUERIES["op2_licenses"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    n = 0
    for d in docs:
        found = [KNOWN[x] for x in d.text.split("\n") if x in KNOWN]
        n += len(found)
        assert got[d.doc_id].licences == sorted(set(found)) and got[d.doc_id].n_licences == len(found), d.doc_id
    assert n > 10


def test_variants_and_ordinary_paragraphs(documents):
    lines = {1: ("Copyright 2019 A. Smith. Licensed under the Apache License, Version 2.0 (the License)", ["apache-2.0"]),
             2: ("Text is shared under the Creative Commons Attribution-ShareAlike 4.0 International License.", ["cc-by-sa"]),
             3: ("My driving license was renewed by the office.", []),
             4: ("We granted the museum permission to show the copies.", []),
             5: ("licensed under the gnu lesser general public license, version 2.1", ["lgpl"])}
    got = licenses.scan(documents([(i, t) for i, (t, _) in lines.items()]))
    assert {r.doc_id: r.licences for r in got.collect()} == {i: want for i, (_, want) in lines.items()}


def test_unknown_is_calibrated():
    model = licenses.Model()
    assert 0.2 < model.temperature < 5 and licenses.UNKNOWN in model.families
    anchors = set(licenses.ANCHORS)
    assert all(anchors & set(licenses.tokens(t)) for _, t in model.templates)


def test_odd_rows(documents):
    notice = "Released under the MIT License."
    docs = [(1, None), (2, ""), (3, notice), (3, notice), (4, f"x\n{notice}\n{notice}\nLicensed under CC BY-NC 4.0."), (5, "a b " * 30000 + "\n" + notice)]
    got = licenses.scan(documents(docs).withColumn("licences", F.lit("x"))).collect()
    count = collections.Counter((r.doc_id, tuple(r.licences), r.n_licences, r.lang) for r in got)
    assert count == {(1, (), 0, "en"): 1, (2, (), 0, "en"): 1, (3, ("mit",), 1, "en"): 2, (4, ("cc-by-nc", "mit"), 3, "en"): 1, (5, ("mit",), 1, "en"): 1}
    assert licenses.scan(documents([])).count() == 0


def test_no_python_in_the_plan(spark):
    df = licenses.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert not re.search(r"Python|Pandas|Arrow(?!ToRow)|CartesianProduct", df._jdf.queryExecution().executedPlan().toString())


def test_no_line_that_the_model_gives_a_family_is_dropped_before(documents):
    lines = ["Released under the MIT terms.", "the mit license", "Er kam mit dem Zug", "She read a book by the sea"]
    model = licenses.Model()
    got = {r.doc_id: r for r in licenses.scan(documents(list(enumerate(lines))), model=model).collect()}
    for i, line in enumerate(lines):
        z = model.weights[[*(model.vocabulary[g] for g in licenses.ngrams(licenses.tokens(line)) if g in model.vocabulary), -1]].sum(0)
        named = model.families[int(z.argmax())] != licenses.UNKNOWN
        assert got[i].n_licences + got[i].n_unconfirmed == named, line
    assert got[0].licences == ["mit"] and got[3].n_unconfirmed == 0


def test_notices_that_are_wrapped_over_lines(documents):
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
    third = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
    docs = {1: bsd, 2: third, 3: f"A title\n\n{bsd}\n \n* Item one\n\n{third}\n", 4: "Released under the MIT License.\nand more",
            5: "She read\na book\n\nby the sea", 6: bsd.split("\n")[0]}
    got = {r.doc_id: r for r in licenses.scan(documents(list(docs.items()))).collect()}
    assert {i: (r.licences, r.n_licences) for i, r in got.items()} == {
        1: (["bsd-3-clause"], 1), 2: (["bsd-3-clause"], 1), 3: (["bsd-3-clause"], 2), 4: (["mit"], 1), 5: ([], 0), 6: ([], 0)}
    assert got[6].unconfirmed == ["bsd-3-clause"] and got[6].n_unconfirmed == 1 and got[5].unconfirmed == [] and got[4].unconfirmed == []
    assert "bsd-3-clause" not in got[3].unconfirmed
