import hashlib
import math

import numpy as np
import pytest

from tabloom.llm import codebooks
from tabloom.llm.queries import OP11_SQL, op11_grid_cell_codes
from tests.conftest import CHECKED
from tools.check_queries import compare, duckdb_on


def nearest(book, part):
    return min((sum((a - b) ** 2 for a, b in zip(entry, part)), at) for at, entry in enumerate(book))


def brute(rows, parts, entries, rounds, scale):
    """Codes and errors by comparing every entry, in Python's integers; and the codebooks."""
    rows = sorted(rows)
    whole = {key: [math.floor(scale * x) for x in v] for key, v in rows}
    size = len(rows[0][1]) // parts
    cut = {key: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for key, v in whole.items()}
    books = [[cut[key][p] for key, _ in rows[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for key in cut:
                members.setdefault(nearest(books[p], cut[key][p])[1], []).append(cut[key][p])
            for at, found in members.items():
                books[p][at] = tuple(sum(column) // len(found) for column in zip(*found))
    found = {key: [nearest(books[p], cut[key][p]) for p in range(parts)] for key in cut}
    return {key: ([at for _, at in f], sum(d for d, _ in f)) for key, f in found.items()}, books


def test_query_equals_all_entries_compared_in_sql(spark):
    problem, rows = compare(spark, duckdb_on(CHECKED), CHECKED, "op11", op11_grid_cell_codes, OP11_SQL)
    assert problem is None and rows == 500


@pytest.mark.parametrize("cache", [3, codebooks.CACHE_CELLS])
def test_cells_give_the_nearest_entry_and_the_lower_index_of_ties(monkeypatch, cache):
    monkeypatch.setattr(codebooks, "CACHE_CELLS", cache)
    draw = np.random.default_rng(1)
    for size, spread in ((1, 3), (2, 10), (4, 300)):
        book = draw.integers(-spread, spread + 1, (17, size))
        book[5] = book[2]
        find = codebooks.Nearest(book)
        for n in (40, 400):
            points = draw.integers(-2 * spread, 2 * spread + 1, (n, size))
            index, distance = find(points)
            want = [nearest(book.tolist(), point) for point in points.tolist()]
            assert [(d, i) for d, i in zip(distance.tolist(), index.tolist())] == want


def test_cells_leave_entries_out():
    draw = np.random.default_rng(2)
    book = draw.normal(0, 32, (64, 4)).astype(np.int64)
    find = codebooks.Nearest(book)
    find(draw.normal(0, 32, (5000, 4)).astype(np.int64))
    assert find.candidates[: len(find.known)].sum(axis=1).mean() < 32


def test_result_equals_brute_force_with_few_and_many_rows(spark):
    draw = np.random.default_rng(3)
    for n in (5, 90):
        rows = [(i * 3, draw.normal(0, 1, 8).round(2).tolist()) for i in range(n)]
        rows[1] = (rows[1][0], rows[0][1])
        df = spark.createDataFrame([(k, v, "x" if k % 2 else None) for k, v in rows], "vec_id long, embedding array<double>, label string")
        found, books = codebooks.compress(df.repartition(3), parts=4, entries=7, rounds=3, scale=10)
        want, want_books = brute(rows, 4, 7, 3, 10)
        got = found.collect()
        assert {r.vec_id: (list(r.code), r.error) for r in got} == want
        assert books.tolist() == [[list(entry) for entry in book] for book in want_books]
        for label in (None, "x"):
            total = sum(r.error for r in got if r.label == label)
            assert {r.label_error for r in got if r.label == label} <= {total}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, -2.0, 0.5, 0.25]
    rows = [
        (1, good, 1), (1, good, 1), (None, good, None), (2, None, 1), (3, [], 1), (4, [nan, 1.0, 1.0, 1.0], 1),
        (5, [None, 1.0, 1.0, 1.0], 1), (6, [inf, 1.0, 1.0, 1.0], 1), (7, good + good, 1), (8, good[:3], 1), (9, [0.0] * 4, None),
    ]
    schema = "vec_id long, embedding array<float>, label int, code string, vector string, key string"
    df = spark.createDataFrame([(*row, "theirs", "theirs", "theirs") for row in rows], schema)
    found, books = codebooks.compress(df, parts=2, entries=4)
    got = sorted(((r.vec_id, r.error, r.label, r.label_error) for r in found.collect()), key=str)
    assert got == [(1, 0, 1, 0), (1, 0, 1, 0), (9, 0, None, 0), (None, 0, None, 0)]
    empty, books = codebooks.compress(df.limit(0), parts=2)
    assert empty.count() == 0 and codebooks.books_digest(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="too large"):
        codebooks.compress(spark.createDataFrame([(1, [1e30, 0.0], 1)], "vec_id long, embedding array<double>, label int"), parts=2)
