from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import splits as s
from millrace.sources import jdbc

KEY = ["a", "b"]
BATCH = 4


def _table(spark, n: int):
    # Composite key with a hot first column.
    rows = [(0 if i < n // 2 else i, f"b{i:03d}'s", i) for i in range(n)]
    return spark.createDataFrame(rows, "a int, b string, v int").repartition(3), rows


@pytest.mark.parametrize("n", [0, 1, BATCH, BATCH + 1, 2 * BATCH, 2 * BATCH + 1, 41])
def test_splits_cover_the_table_once(spark, n):
    df, rows = _table(spark, n)
    assigned = s.split_assignment(df, KEY, BATCH)
    points = s.split_points(assigned, KEY, BATCH)
    found = sorted((r.split_id, r.a, r.b) for r in points.collect())
    assert len(found) == max(0, (n - 1) // BATCH)
    assert [f[1:] for f in found] == [r[:2] for r in sorted(rows)[BATCH::BATCH]]

    ranges = sorted(s.split_ranges(points, KEY).collect(), key=lambda r: r.split_id)
    assert [r.split_id for r in ranges] == list(range(len(found) + 1))
    seen = []
    for r in ranges:
        lo, hi = (None if e is None else tuple(e) for e in (r.lo, r.hi))
        seen += [row.v for row in s.scan_split(df, KEY, lo, hi).collect()]
    assert sorted(seen) == list(range(n))

    kinds = s.split_ranges(points, KEY).withColumn(
        "kind", s.split_kind(F.col("lo"), F.col("hi")))
    kinds = [r.kind for r in kinds.orderBy("split_id").collect()]
    assert kinds == (["all"] if not found else
                     ["initial"] + ["middle"] * (len(found) - 1) + ["final"])


@pytest.mark.parametrize("size", [1, 3, 10, 11, 100])
def test_sql_ranges_cover_the_table_once(spark, size):
    df, _ = _table(spark, 41)
    points = s.split_points(s.split_assignment(df, KEY, BATCH), KEY, BATCH)
    found = list(jdbc.waves(points, KEY, size))
    assert len({name for name, _ in found}) == len(found) == -(-11 // size)
    predicates = [p for _, wave in found for p in wave]
    assert len(predicates) == 11
    ranges = [[row.v for row in df.where(p).collect()] for p in predicates]
    assert max(map(len, ranges)) == BATCH
    assert sorted(sum(ranges, [])) == list(range(41))


def test_sql_ranges_of_a_small_table(spark):
    df, _ = _table(spark, BATCH)
    points = s.split_points(s.split_assignment(df, KEY, BATCH), KEY, BATCH)
    assert list(jdbc.waves(points, KEY)) == [("r0", ["1 = 1"])]


def test_points_are_numbered_by_the_database():
    assert jdbc.point_query("or`ders", ["a", "b"], 100) == (
        "SELECT `a`, `b`, _place FROM (SELECT `a`, `b`, ROW_NUMBER() OVER (ORDER BY `a`, `b`) - 1 "
        "AS _place FROM `or``ders`) AS _keys WHERE _place > 0 AND MOD(_place, 100) = 0")


def test_sql_keys_are_numbers_or_text():
    assert jdbc.range_predicate(["a"], None, (5,)) == "`a` < 5"
    assert jdbc.range_predicate(["a"], ("it's",), None) == "NOT (`a` < 'it''s')"
    assert jdbc.range_predicate(["a"], (1.5,), None) == "NOT (`a` < 1.5)"
    assert jdbc.range_predicate(["a"], ("\\x",), None) == "NOT (`a` < _utf8mb4 X'5c78')"
    assert jdbc.range_predicate(["a"], (b"\x00\xff",), None) == "NOT (`a` < X'00ff')"
    with pytest.raises(TypeError):
        jdbc.range_predicate(["a"], (None,), None)


def test_progress(spark):
    df, rows = _table(spark, 12)
    assigned = s.split_assignment(df, KEY, BATCH)
    loaded = spark.createDataFrame([r[:2] for r in sorted(rows)[:6]], "a int, b string")
    states = s.split_progress(assigned, loaded, KEY).orderBy("split_id").collect()
    assert [(r.planned, r.loaded, r.state) for r in states] == [
        (4, 4, s.DONE), (4, 2, s.RUNNING), (4, 0, s.NOT_STARTED)]


def test_no_key_no_splits(spark):
    with pytest.raises(ValueError):
        s.split_assignment(spark.range(3), [], BATCH)


def test_jdbc_options():
    options = jdbc.JdbcOptions("db.example", "shop", "reader", "secret", batch_size=500)
    assert options.reader()["url"] == "jdbc:mysql://db.example:3306/shop"
    assert options.reader()["fetchsize"] == "500"
    assert "secret" not in repr(options)


def test_numbers_and_dates_bound_a_range():
    from datetime import date, datetime
    from decimal import Decimal

    from millrace.sources.jdbc import range_predicate
    assert range_predicate(["k"], (Decimal("1E+3"),), None) == "NOT (`k` < 1000)"
    assert range_predicate(["k"], None, (date(2024, 2, 29),)) == "`k` < '2024-02-29'"
    assert range_predicate(["k"], None, (datetime(2024, 2, 29, 1, 2, 3),)) == (
        "`k` < '2024-02-29 01:02:03'")
