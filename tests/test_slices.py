"""Ordered computations against brute force, with a hot key and with copies."""

from __future__ import annotations

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from millrace.operators import slices as s


def _rows(seed: int) -> list[tuple]:
    """A third of the rows has one key, some values are null."""
    random.seed(seed)
    rows = []
    for n in range(600):
        key = 7 if n % 3 == 0 else random.randrange(60)
        rows.append((key, n, None if random.random() < 0.3 else random.randrange(100)))
    random.shuffle(rows)
    return rows


@pytest.fixture(params=[1, 5, 16])
def cut(request):
    return request.param


@pytest.fixture(params=[0, 50, s.HOT_ROWS], ids=["all hot", "some hot", "none hot"])
def heat(request):
    return request.param


def _by_key(rows):
    ordered = sorted(rows, key=lambda r: r[:2])
    return [list(group) for _, group in groupby(ordered, key=lambda r: r[0])]


def test_row_index(spark, cut):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(4)
    got = {(r.k, r.o): r.row_index for r in s.row_index(df, ["k", "o"], cut).collect()}
    assert got == {r[:2]: n for n, r in enumerate(sorted(rows, key=lambda r: r[:2]))}


def test_row_index_of_nothing(spark):
    df = spark.createDataFrame([], "k int")
    assert s.row_index(df, ["k"]).count() == 0


def test_rank_in_key(spark, cut, heat):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(4)
    got = {(r.k, r.o): r.rank for r in s.rank_in_key(
        df, ["k"], ["o"], slices=cut, hot_rows=heat).collect()}
    assert got == {r[:2]: n for group in _by_key(rows) for n, r in enumerate(group, 1)}


def test_rank_tells_copies_apart(spark, cut):
    rows = [(1, 1)] * 300 + [(1, 2), (2, 1)]
    df = spark.createDataFrame(rows, "k int, o int").repartition(16)
    ranked = s.rank_in_key(df, ["k"], ["o"], slices=cut, hot_rows=0)
    got = sorted((r.k, r.rank, r.o) for r in ranked.collect())
    assert got == [(1, n, 1) for n in range(1, 301)] + [(1, 301, 2), (2, 1, 1)]
    if cut == 16:
        sizes = s._slices(df, ["k", "o"], cut).groupBy(s.SLICE).count()
        assert sizes.agg(F.max("count")).first()[0] < 150


def test_previous_in_key(spark, cut, heat):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(4)
    linked = s.previous_in_key(df, ["k"], ["o"], "v", slices=cut, hot_rows=heat).collect()
    got = {(r.k, r.o): None if r.previous is None else (r.previous.value,) for r in linked}
    want = {}
    for group in _by_key(rows):
        want[group[0][:2]] = None
        want |= {row[:2]: (before[2],) for before, row in zip(group, group[1:])}
    assert got == want


def test_latest_in_key(spark, cut, heat):
    rows = [(k, o, v if random.Random(o).random() < 0.05 else None) for k, o, v in _rows(4)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(4)
    got = {(r.k, r.o): r.latest for r in
           s.latest_in_key(df, ["k"], ["o"], "v", slices=cut, hot_rows=heat).collect()}
    want = {}
    for group in _by_key(rows):
        seen = None
        for row in group:
            seen = seen if row[2] is None else row[2]
            want[row[:2]] = seen
    assert got == want


def test_hot_key_covers_many_slices(spark):
    df = spark.createDataFrame(_rows(5), "k int, o int, v int").repartition(4)
    sizes = s._slices(df, ["k", "o"], 12).groupBy(s.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] < 600 / 3


def test_null_keys_are_keys(spark):
    rows = [(None, n) for n in range(30)] + [(1, n) for n in range(5)]
    df = spark.createDataFrame(rows, "k int, o int").repartition(3)
    for heat in (0, 10, 100):
        ranked = s.rank_in_key(df, ["k"], ["o"], hot_rows=heat).collect()
        assert {(r.k, r.o): r.rank for r in ranked} == {(k, o): o + 1 for k, o in rows}


def test_row_at(spark, cut):
    rows = _rows(6)
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(4)
    ordered = sorted(r[:2] for r in rows)
    for n in (0, 1, 299, 599):
        assert [tuple(r) for r in s.row_at(df, ["k", "o"], n, cut).collect()] == [ordered[n]]
    assert s.row_at(df, ["k", "o"], 600, cut).count() == 0
