import numpy as np

from tabloom.llm import language
from tabloom.llm.queries import op1_mixture_language

from .common import CHECKED, ODD, documents


def test_held_out_accuracy_of_the_query(spark):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op1_mixture_language(spark, CHECKED).collect()]
    assert len(rows) == len(labels)
    held_out = [r for r in rows if r.held_out]
    assert 100 < len(held_out) < 300
    assert sum(labels[r.doc_id] == r.lang_pred for r in held_out) / len(held_out) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_are_no_input_of_a_prediction(spark):
    docs = spark.read.parquet(f"{CHECKED}/documents.parquet")
    model = language.train(docs)
    plan = language.identify(docs, model)._jdf.queryExecution().optimizedPlan().toString()
    scan = [line for line in plan.split("\n") if "Relation" in line or "Project" in line]
    assert any("Project [doc_id" in line and "lang#" not in line for line in scan)


def test_mixture_shares_are_recovered(spark):
    docs = spark.read.parquet(f"{CHECKED}/documents.parquet")
    model = language.train(docs)
    texts = {l: " ".join(r.text for r in docs.where(f"lang = '{l}' and n_chars > 800").limit(4).collect())[:2500] for l in ("de", "fr")}
    mixed = documents(spark, [(1, texts["de"][:2000] + " " + texts["fr"][:1000]), (2, texts["fr"])])
    found = {r.doc_id: r.languages for r in language.identify(mixed, model).collect()}
    assert [x.lang for x in found[1]] == ["de", "fr"]
    assert abs(found[1][0].share - 2 / 3) < 0.06
    assert [x.lang for x in found[2]] == ["fr"]


def test_expectation_maximisation_never_lowers_the_likelihood():
    draw = np.random.default_rng(2)
    table = draw.dirichlet(np.ones(40), 3)
    counts = draw.integers(1, 9, 40).astype(float)
    shares, before = np.full(3, 1 / 3), -np.inf
    for _ in range(10):
        joint = shares[:, None] * table
        shares = joint @ (counts / joint.sum(axis=0)) / counts.sum()
        after = np.log(shares @ table) @ counts
        assert after >= before - 1e-9
        before = after
    found, score = language.mixture(table, counts, np.full(3, 1 / 3))
    assert abs(found.sum() - 1) < 1e-9 and score >= before - 0.1


def test_odd_rows(spark):
    docs = documents(spark, [*ODD, (9, "12 34 !!"), (10, "12 a")])
    model = language.train(documents(spark, [(1, "the cat and the dog", "en"), (2, "der hund", "de"), (3, "x", None)]))
    assert model[0] == ["de", "en"]
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(ODD) + 2
    none = {r.doc_id for r in rows if (r.lang_pred, r.score, r.languages) == ("und", 0.0, [])}
    assert none == {1, 2, 3, 9}
    assert language.identify(docs.limit(0), model).count() == 0
    untrained = language.identify(docs, language.train(docs.limit(0))).collect()
    assert {r.lang_pred for r in untrained} == {"und"}
