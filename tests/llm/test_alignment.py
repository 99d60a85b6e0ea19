import random

import numpy as np
import pytest

from tabloom.llm import alignment


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


@pytest.mark.parametrize("followed", [0, 2, 64])
def test_distance_within_equals_brute_force(monkeypatch, followed):
    monkeypatch.setattr(alignment, "FOLLOWED", followed)
    draw = random.Random(followed)
    for _ in range(1500):
        size, letters = draw.randint(0, 25), draw.choice([2, 4, 30])
        a = [draw.randrange(letters) for _ in range(size)]
        b = list(a)
        for _ in range(draw.randint(0, 8)):
            at = draw.randint(0, len(b))
            b[at : at + draw.randint(0, 1)] = [draw.randrange(letters)] * draw.randint(0, 1)
        limit, expected = draw.randint(0, 12), distance(a, b)
        found = alignment.distance_within(np.array(a, dtype=int), np.array(b, dtype=int), limit)
        assert found == (expected if expected <= limit else None)


def test_long_sequences():
    a = np.arange(20_000) % 977
    b = np.delete(a, np.arange(100, 20_000, 50))
    assert alignment.distance_within(a, b, 4000) == 398
    assert alignment.distance_within(a, a[::-1].copy(), 4000) is None
