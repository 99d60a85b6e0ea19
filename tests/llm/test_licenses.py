import pytest

from tabloom.llm import licenses
from tabloom.llm.queries import op9_licence_paragraphs

from .common import CHECKED, ODD, documents, prose


@pytest.fixture(scope="module")
def classifier(spark):
    return licenses.train(documents(spark, [(i, prose(i, 80)) for i in range(300)]))


def test_query_finds_the_known_notices(spark):
    # The notices in the test data.
    known = {
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "All rights reserved.": "all-rights-reserved",
    }
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text").collect()}
    for row in op9_licence_paragraphs(spark, CHECKED).collect():
        lines = texts[row.doc_id].split("\n")
        expected = [f"{i}:{known[line]}" for i, line in enumerate(lines) if line in known]
        assert row.places == ",".join(expected)
        assert row.n_licences == len(expected)


def test_varied_notices_and_near_misses(spark, classifier):
    rows = [
        (1, "x\nThis library is licensed under the terms of the MIT License, see the file.\ny"),
        (2, "you may not use this file except in compliance with the License. You may obtain a copy of the License"),
        (3, "Redistribution and use in source and binary forms, with or without changes, are permitted provided that"),
        (4, "The driver showed a license, and the software was free of charge to the general public."),
        (5, "He reserved a table; all rights of way were free.\nA copy of this work"),
        (6, "It is subject to the terms of the Mozilla Public License, v. 2.0."),
    ]
    found = {r.doc_id: [(x.line, x.family) for x in r.licences] for r in licenses.scan(documents(spark, rows), classifier).collect()}
    assert found[1] == [(1, "mit")]
    assert found[2] == [(0, "apache-2.0")]
    assert found[3] == [(0, "bsd")]
    assert found[4] == found[5] == []
    assert found[6] == [(0, "mpl")]


def test_held_out_windows(spark, classifier):
    windows = licenses._windows(spark).where("size(words) >= 7 and family <> 'unknown'").withColumnRenamed("family", "label")
    judged = licenses.classify(windows, classifier).collect()
    right = sum(r.family == r.label for r in judged)
    assert right / len(judged) > 0.95


def test_anchors_pass_over_nothing_that_could_be_confirmed():
    for texts in licenses.NOTICES.values():
        for text in texts:
            for gram in licenses._grams(licenses._words(text)):
                assert not licenses._telling(gram) or set(gram.split(" ")) & set(licenses.ANCHORS)


def test_odd_rows(spark, classifier):
    docs = documents(spark, ODD)
    rows = licenses.scan(docs, classifier).collect()
    assert len(rows) == len(ODD) and all(r.licences == [] for r in rows)
    assert {r["count"] for r in rows} == {"theirs"}
    assert licenses.scan(docs.limit(0), classifier).count() == 0
    assert licenses.train(docs.limit(0)).temperature > 0
