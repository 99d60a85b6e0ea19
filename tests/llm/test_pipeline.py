import glob
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tabloom.sources import shared
from tabloom.sources.shared import materialize

from .common import CHECKED, documents, prose
from .test_packing import exact
from .test_quality import brute as base_rules
from .test_secrets import brute as base_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and result of every stage on the checked tables."""
    docs = spark.read.parquet(f"{CHECKED}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, CHECKED))
        found.append((name, docs, after))
        docs = after
    return found


def test_stages_and_columns(stages):
    assert [name for name, _, _ in stages] == ["quality rules", "line dedup", "near-dedup", "secret scan", "packing"]
    assert all(after.columns == COLUMNS for _, _, after in stages[:-1])


def test_quality_rules_reject_what_the_base_rules_do(stages, spark):
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    passed = {r.doc_id for r in before.collect() if not base_rules(r.text)[5]}
    assert kept <= passed
    good = {r.doc_id for r in spark.read.parquet(f"{CHECKED}/labels.parquet").where("quality = 1").collect()}
    assert len(kept & good) >= 0.97 * len(passed & good)


def test_line_dedup_only_takes_whole_lines(stages):
    _, before, after = stages[1]
    old = {r.doc_id: r for r in before.collect()}
    shorter = 0
    for row in after.collect():
        rest = iter(old[row.doc_id].text.split("\n"))
        assert all(any(line == candidate for candidate in rest) for line in row.text.split("\n"))
        shorter += len(row.text) < len(old[row.doc_id].text)
        assert 2 * len(row.text) >= len(old[row.doc_id].text)
        assert row.n_chars == len(row.text)
    assert shorter > 50


def test_near_dedup_keeps_one_of_equal_texts(stages):
    _, before, after = stages[2]
    texts = [r.text for r in after.collect()]
    assert len(set(texts)) == len(texts) < before.count()


def test_copies_of_the_texts_are_few_and_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda spark: f"{tmp_path}")
    docs = documents(spark, [(i, prose(i % 20, 200)) for i in range(40)]).select(*COLUMNS)
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.near_dedup):
        before = set(glob.glob(f"{tmp_path}/tabloom-*/table-*"))
        stage(spark, docs, CHECKED)
        tables = set(glob.glob(f"{tmp_path}/tabloom-*/table-*")) - before
        copies = [path for path in tables if "text" in spark.read.parquet(path).columns]
        assert len(copies) == 1
        assert all(part.endswith(".zstd.parquet") for part in glob.glob(f"{copies[0]}/part-*"))


def test_no_owner_specific_secret_is_left(stages):
    _, before, after = stages[3]
    old, new = ({r.doc_id: r.text for r in df.collect()} for df in (before, after))
    assert set(old) == set(new)
    for doc, text in new.items():
        spans = base_spans(old[doc])
        assert (text == old[doc]) or spans
        assert len(base_spans(text)) < len(spans) or not spans or text == old[doc]


def test_packing_covers_every_document_once(stages):
    _, before, after = stages[4]
    pieces = defaultdict(list)
    for row in after.collect():
        pieces[row.doc_id].append(row)
    for row in before.collect():
        ids, at = np.asarray(exact(row.text), dtype="<u4"), 0
        for piece in sorted(pieces[row.doc_id], key=lambda p: p.start):
            assert piece.start == at
            assert zlib.crc32(ids[at : at + piece.length].tobytes()) == piece.ids_crc32
            at += piece.length
        assert at == len(ids)


def test_odd_documents_pass_through_every_stage(spark):
    rows = [(1, None), (2, ""), (None, prose(1, 60)), (None, prose(1, 60)), (3, prose(3, 3000)), (3, prose(4, 50))]
    docs = documents(spark, rows).select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, CHECKED))
    # Of the repeated rows one is left; null and empty texts fail the first stage.
    starts = [r.doc_id for r in docs.where("start = 0").collect()]
    assert sorted(map(str, starts)) == ["3", "3", "None"]
    empty = documents(spark, rows).select(*COLUMNS).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, CHECKED))
    assert empty.isEmpty()


def test_run_equals_its_stages(spark, stages):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = sorted(map(tuple, corpus_pipeline.run(spark, CHECKED).select(names).collect()))
    assert found == sorted(map(tuple, stages[-1][2].select(names).collect()))
