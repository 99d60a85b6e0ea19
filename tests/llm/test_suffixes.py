import hashlib
import random

import numpy as np
import pytest

from tabloom.llm import suffixes
from tabloom.llm.queries import op13_front_coded_suffixes
from tabloom.sources.passengers import table
from tests.conftest import CHECKED

from .common import ODD, documents, prose


def brute(rows, span=50):
    """(key, bytes, removed, spans, kept) of every row, by looking at every string of ``span`` bytes."""
    last = float("inf")
    bodies = [(last if key is None else key, (text or "").encode()) for key, text in rows]
    least = {}
    for key, body in bodies:
        for at in range(len(body) - span + 1):
            string = body[at : at + span]
            least[string] = min(least.get(string, key), key)
    found = []
    for (name, _), (key, body) in zip(rows, bodies):
        gone = bytearray(len(body))
        for at in range(len(body) - span + 1):
            if least[body[at : at + span]] < key:
                gone[at : at + span] = b"\x01" * span
        spans = sum(1 for at, one in enumerate(gone) if one and (at == 0 or not gone[at - 1]))
        found.append((name, len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g)))
    return sorted(found, key=str)


def cut(df, **options):
    rows = suffixes.cut_repeats(df, **options).collect()
    for row in rows:
        assert row.n_removed == sum(row.ends) - sum(row.starts) and row.n_spans == len(row.starts)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows), key=str)


def mixture(seed, n):
    """Texts that share pieces of all lengths around the span, with copies and repeats within a text."""
    draw = random.Random(seed)
    pieces = [prose(1000 + seed * 50 + i, 60) for i in range(12)]
    rows = []
    for key in range(n):
        parts = [prose(seed * 7000 + key, draw.randint(0, 30))]
        for _ in range(draw.randint(0, 4)):
            piece = draw.choice(pieces)
            start, length = draw.randint(0, len(piece) - 1), draw.choice([20, 48, 49, 50, 51, 52, 75, 76, 77, 120, 300])
            parts += [piece[start : start + length], draw.choice(["", "x", prose(draw.randint(0, 9999), 3)])]
        rows.append((key, "".join(parts)))
    return rows + [(n + i, rows[i][1]) for i in range(0, n, 5)]


@pytest.mark.parametrize("options", [{}, {"run_bytes": 3000, "bucket_hashes": 50, "bucket_suffixes": 20}])
def test_result_equals_brute_force(spark, options):
    rows = mixture(1, 60)
    random.Random(2).shuffle(rows)
    assert cut(documents(spark, rows).repartition(5), **options) == brute(rows)


@pytest.mark.parametrize("span, gram", [(50, 50), (50, 12), (9, 3), (1, 1)])
def test_other_lengths(spark, span, gram):
    rows = mixture(3, 12)
    assert cut(documents(spark, rows), span=span, gram=gram, run_bytes=2000) == brute(rows, span)


def test_query_equals_brute_force_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, CHECKED, "documents").collect()]
    want = [(*row[:4], hashlib.sha256(row[4]).hexdigest()) for row in brute(rows)]
    got = [tuple(r) for r in op13_front_coded_suffixes(spark, CHECKED).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_odd_rows(spark):
    zeros = "\x00" * 120
    rows = [*ODD, (8, "a" * 300), (7, "a" * 299), (9, "ab" * 100), (9, "ab" * 100), (10, "ab" * 49 + "a"), (11, zeros), (12, "b" + zeros),
            (None, prose(6, 4000)), (None, prose(6, 4000)), (13, "é" * 40), (14, "xé" + "é" * 30), (-5, "漢字" * 20), (15, "字漢" * 20)]
    df = documents(spark, rows).withColumns({name: suffixes.F.lit("theirs") for name in ("run", "body", "keys", "kept", "n_bytes")})
    assert cut(df) == brute(rows)
    assert cut(df, run_bytes=500, bucket_suffixes=7) == brute(rows)
    assert suffixes.cut_repeats(df.limit(0)).count() == 0


def test_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 100_000)
    rows = [(2, prose(8, 150_000)), (1, prose(8, 150_000)[400_000:700_000]), (3, " " * 1_200_000)]
    got = {key: (size, removed, spans) for key, size, removed, spans, _ in cut(documents(spark, rows))}
    assert got[2] == (len(rows[0][1]), 300_000, 1) and got[1][1:] == (0, 0) and got[3] == (1_200_000, 0, 0)


def test_loser_tree_merges_with_common_prefixes():
    draw = np.random.default_rng(5)
    for count in (1, 2, 3, 7):
        runs = []
        for _ in range(count):
            rows = draw.integers(0, 3, (draw.integers(0, 200), 16)).astype(np.uint8)
            rows[:, :6] = rows[:, :6] // 2
            order = np.argsort(rows.view("S16").ravel(), kind="stable")
            runs.append(rows[order])
        lcps = [suffixes.common_prefixes(run) for run in runs]
        for run, lcp in zip(runs, lcps):
            back, prefix = suffixes.from_front_coded(suffixes.front_coded(run, lcp), len(run), 16)
            assert (back == run).all() and (prefix == lcp).all()
        order, lcp = suffixes.merged(runs, lcps)
        place, found = [0] * count, []
        for run in order:
            found.append(bytes(runs[run][place[run]]))
            place[run] += 1
        assert found == sorted(bytes(row) for run in runs for row in run)
        whole = np.frombuffer(b"".join(found), dtype=np.uint8).reshape(-1, 16)
        assert lcp == suffixes.common_prefixes(whole).tolist()
