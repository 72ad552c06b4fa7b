"""Keys at places of the key order, against sorting."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from millrace.operators import selection, slices
from millrace.operators.selection import keys_at
from millrace.operators.splits import nth_key


def _rows(seed, n=3000):
    rng = random.Random(seed)
    # Half of the rows have one first column, and a fifth are copies of one key.
    rows = [(5 if rng.random() < 0.5 else rng.randrange(12), f"k{rng.randrange(200):03d}")
            for _ in range(n)]
    return rows + [(7, "k100")] * (n // 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_keys_at_any_place(spark, monkeypatch, seed):
    """Samples and rests so small that several rounds are needed; nothing is dealt in slices."""
    def refuse(*_):
        raise AssertionError("keys are not to be shuffled")

    monkeypatch.setattr(slices, "_slices", refuse)
    rows = _rows(seed)
    table = spark.createDataFrame(rows, "a int, b string").repartition(5)
    ordered = sorted(rows)
    places = [0, 1, len(rows) // 3, len(rows) // 2, ordered.index((7, "k100")) + 5, len(rows) - 1]
    found = keys_at(table, ["a", "b"], [*places, len(rows), -1], sample=400, few=450).collect()
    assert sorted(map(tuple, found)) == sorted((p, *ordered[p]) for p in set(places))
    assert tuple(nth_key(table, ["a", "b"], 17).first()) == ordered[17]
    assert nth_key(table, ["a", "b"], len(rows)).count() == 0
    assert keys_at(table.limit(0), ["a", "b"], [0]).count() == 0


def test_keys_of_other_types(spark):
    rows = [(datetime(2024, 1, 1 + k % 28, k % 24), bytes([k % 7, k % 5])) for k in range(900)]
    table = spark.createDataFrame(rows, "t timestamp_ntz, b binary")
    ordered = sorted(rows)
    found = keys_at(table, ["t", "b"], [400], sample=100, few=120).collect()
    assert [(r.t, bytes(r.b)) for r in found] == [ordered[400]]


def test_a_key_that_all_rows_share(spark):
    table = spark.createDataFrame([(1,)] * 500, "k long")
    assert [tuple(r) for r in keys_at(table, ["k"], [0, 250, 499], sample=40, few=50).collect()] == [
        (0, 1), (250, 1), (499, 1)] and selection.FEW > selection.SAMPLE


def test_two_keys_that_are_nearly_all_rows(spark):
    rows = [(1,)] * 600 + [(2,)] * 600 + [(0,), (3,)]
    table = spark.createDataFrame(rows, "k long").repartition(3)
    found = keys_at(table, ["k"], [0, 600, 601, 1201], sample=100, few=110).collect()
    assert sorted(map(tuple, found)) == [(0, 0), (600, 1), (601, 2), (1201, 3)]
