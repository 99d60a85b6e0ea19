import numpy as np
import pandas as pd

from tabloom.llm import embeddings
from tabloom.llm.queries import OP10_SQL, op10_rotation_codes
from tests.conftest import CHECKED
from tools.check_queries import compare, duckdb_on


def brute(vectors, threshold=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    label = np.arange(len(vectors))
    for _ in range(len(vectors)):
        fresh = np.array([label[row].min() for row in near])
        if (fresh == label).all():
            break
        label = fresh
    return near.sum(axis=1) - 1, label


def test_query_equals_all_pairs(spark):
    problem, rows = compare(spark, duckdb_on(CHECKED), CHECKED, "op10", op10_rotation_codes, OP10_SQL)
    assert problem is None and rows == 500


def test_recall_against_all_pairs_and_blocks(spark):
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((250, 32))
    near = np.concatenate([c + draw.standard_normal((4, 32)) * s for c, s in zip(centres, np.linspace(0.05, 0.6, 250))])
    hot = centres[0] + draw.standard_normal((300, 32)) * 0.05
    vectors = np.concatenate([near, hot, np.repeat(near[:1], 50, axis=0)])
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep string")
    found = embeddings.near_duplicates(df, cell_rows=50, block_rows=64).toPandas().sort_values("vec_id")
    links, label = brute(vectors)
    assert (found["n_links"].to_numpy() <= links).all()
    assert found["n_links"].sum() >= 0.99 * links.sum()
    assert (found["n_links"].to_numpy() == links).mean() > 0.97
    assert (found["component_id"].to_numpy() == label).mean() > 0.98


def near_and_far(seed, dim, pairs=400):
    """Unit vectors in pairs (2i, 2i + 1) that have inner products from 0.8 to 1."""
    draw = np.random.default_rng(seed)
    one = draw.standard_normal((pairs, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other = draw.standard_normal((pairs, dim))
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    product = np.linspace(0.8, 1, pairs)[:, None]
    return np.stack([one, product * one + np.sqrt(1 - product**2) * other], axis=1).reshape(2 * pairs, dim)


def codes_of(vectors, bits=4, tables=8, threshold=0.9):
    packed, factors = embeddings.encode(vectors, bits, tables)
    assert packed.shape[1] * 8 == embeddings.ROTATIONS * vectors.shape[1]
    return embeddings.Codes(packed, factors, vectors.shape[1], bits, tables, threshold)


def test_bounds_hold_and_estimates_are_unbiased():
    for dim in (16, 64, 256):
        vectors = near_and_far(5, dim)
        codes = codes_of(vectors)
        rows = slice(0, len(vectors))
        exact, off = vectors @ vectors.T, ~np.eye(len(vectors), dtype=bool)
        error = codes.estimates(rows) - exact
        assert abs(error[off].mean()) < 0.002
        close = off & (exact >= 0.9)
        share = error[close] / codes.deviations(rows)[close]
        assert close.sum() >= 390 and abs(share.mean()) < 0.2 and (share >= -embeddings.BOUND).all()
        at = off & (np.abs(exact - 0.9) < 0.02)  # the stated deviation is that of pairs at the threshold
        assert 0.8 < (error[at] / codes.deviations(rows)[at]).std() < 1.2


def test_undecided_pairs_hold_all_links_of_a_cell_once_and_few_others():
    vectors = near_and_far(6, 64)
    codes = codes_of(vectors)
    exact, met = vectors @ vectors.T, (codes.cells[:, None] == codes.cells[None]).any(axis=2)
    found = np.zeros(exact.shape, dtype=int)
    for table in range(codes.cells.shape[1]):
        for i, j in codes.undecided(table, np.zeros(len(vectors)), False):
            together = codes.cells[i, table] == codes.cells[j, table]
            found[i[together], j[together]] += 1
    links = np.triu(met & (exact >= 0.9), 1)
    assert links.sum() > 150 and (found[links] == 1).all() and found.max() == 1
    assert found[np.triu(exact < 0.5, 1)].sum() == 0


def test_vectors_are_fetched_only_where_a_pair_is_undecided():
    vectors = np.concatenate([near_and_far(8, 64, 200)[:1], near_and_far(8, 64, 200)[-2:]])
    packed, factors = embeddings.encode(vectors, 0, 1)
    frame = pd.DataFrame({
        "dim": 64, "t": 0, "cell": 0, "first": 0, "second": 0, "block": 0, "rep": [5, 6, 7],
        "code": [x.tobytes() for x in packed], "factors": [x.tobytes() for x in factors],
    })
    assert embeddings.to_fetch(frame, 0, 1, 0.9)["rep"].tolist() == [6, 7]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e-300, 1e-320]), (11, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*row, "theirs") for row in rows], "vec_id long, embedding array<double>, id string")
    found = sorted((tuple(r) for r in embeddings.near_duplicates(df).collect()), key=str)
    # 1, 2, 2 and 10 point the same way; all others are alone.
    expected = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (10, 3, 1, False), (None, 0, None, True)]
    expected += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)]
    assert found == sorted(expected, key=str)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
