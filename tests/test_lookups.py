from __future__ import annotations

import random
import re

import pytest

from millrace.operators import lookups as lk
from millrace.operators import deltas as d

LOG = "epoch int, filename string, offset bigint, seq int, table_id bigint, k int"
MAP = "epoch int, filename string, offset bigint, table_id bigint, db string, tbl string"


def _name(n):
    return f"bin.{n:06d}"


def _history(seed=3):
    """Files without a mapping, mappings in mid-file, repeated ones, a hot table."""
    rng = random.Random(seed)
    table_map = []
    for file in range(1, 8):
        if file == 4:
            continue
        for table_id in (1, 2):
            for offset in sorted(rng.sample(range(0, 2000, 100), rng.choice([0, 1, 3]))):
                table_map.append((0, _name(file), offset, table_id, "shop",
                                  rng.choice(["account", "session"])))
    table_map.append((1, _name(1), 0, 1, "shop", "newer"))
    log = [(rng.choice([0, 0, 0, 1]), _name(rng.randrange(1, 8)), rng.randrange(4, 2000, 7),
            n, rng.choice([1, 1, 1, 2, 99]), n) for n in range(400)]
    return log, table_map


def _in_force(log, table_map):
    found = {}
    for epoch, file, offset, _, table_id, k in log:
        earlier = [m for m in table_map if m[0] == epoch and m[3] == table_id
                   and (m[1], m[2]) <= (file, offset)]
        if earlier:
            found[k] = max(earlier, key=lambda m: (m[1], m[2]))[5]
    return found


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 3}, {"file_mappings": 1}])
def test_mapping_in_force(spark, limits):
    log, table_map = _history()
    log_df = spark.createDataFrame(log, LOG).repartition(4)
    map_df = spark.createDataFrame(table_map, MAP)
    got = lk.table_at(log_df, map_df, **limits)
    rows = got.collect()
    want = _in_force(log, table_map)
    assert len(rows) == len(want)
    assert {r.k: r.tbl for r in rows} == want
    lost = lk.orphans(log_df, map_df).collect()
    assert {r.k for r in lost} == {row[5] for row in log} - set(want)


def test_the_log_is_read_once(spark, tmp_path):
    """Rows before the first mapping of their file included; file names are read before."""
    log, table_map = _history()
    spark.createDataFrame(log, LOG).write.parquet(f"{tmp_path}/log")
    got = lk.table_at(spark.read.parquet(f"{tmp_path}/log"), spark.createDataFrame(table_map, MAP))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^]]*\bk#", plan)) == 1
    assert {r.k: r.tbl for r in got.collect()} == _in_force(log, table_map)
    mapped_files = {m[1] for m in table_map if m[0] == 0}
    assert any(row[1] not in mapped_files for row in log if row[0] == 0)


def test_copies_of_a_log_row_stay(spark):
    log, table_map = _history()
    map_df = spark.createDataFrame(table_map, MAP)
    twice = spark.createDataFrame(log + log, LOG).repartition(3)
    assert (lk.table_at(twice, map_df).count()
            == lk.table_at(twice, map_df, broadcast_rows=1).count()
            == 2 * len(_in_force(log, table_map)))


@pytest.mark.parametrize("limit", [{"broadcast_rows": 99}, {"broadcast_bytes": 1000}])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_large_lookup_gives_the_same_rows(spark, how, limit):
    rows = spark.createDataFrame([(0 if n % 3 else n, n) for n in range(300)], "k int, n int")
    rows = rows.repartition(7)
    lookup = spark.createDataFrame([(k, f"t{k}") for k in range(0, 200, 2)], "k int, t string")
    small = lk.lookup_join(rows, lookup, ["k"], how, broadcast_rows=100)
    large = lk.lookup_join(rows, lookup, ["k"], how, **limit)
    hints = ["strategy=broadcast" in df._jdf.queryExecution().optimizedPlan().toString()
             for df in (small, large)]
    assert hints == [True, False]
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert small.columns == large.columns


def test_tables_match_with_their_database(spark):
    source = spark.createDataFrame([("a", "t"), ("b", "t"), ("b", "u")], "db string, tbl string")
    sink = spark.createDataFrame([("a", "t"), ("a", "u")], source.schema)
    assert sorted(map(tuple, lk.missing_tables(source, sink).collect())) == [
        ("b", "t"), ("b", "u")]
    assert list(map(tuple, lk.existing_tables(source, sink).collect())) == [("a", "t")]


def test_with_table_when_the_map_is_large(spark):
    table_map = [(0, _name(f), 0, t, "shop", f"t{t}") for f in range(1, 5) for t in (1, 2)]
    log = [(0, _name(n % 4 + 1), n, 0, n % 2 + 1, n) for n in range(100)]
    log_df, map_df = spark.createDataFrame(log, LOG), spark.createDataFrame(table_map, MAP)
    small, large = (lk.with_table(log_df, map_df, **limit).select("k", "tbl").collect()
                    for limit in ({}, {"broadcast_rows": 2}))
    assert sorted(small) == sorted(large) == sorted((n, f"t{n % 2 + 1}") for n in range(100))


def test_row_events_and_unpacking(spark):
    events = spark.createDataFrame(
        [(1, "EXT_WRITE_ROWS", [10, 11, 12]), (2, "TABLE_MAP", []), (3, "EXT_DELETE_ROWS", [13]),
         (4, "EXT_UPDATE_ROWS", []), (5, "GTID", [1])],
        "id int, event_type string, rows array<int>")
    found = d.unpack_rows(d.row_events(events)).select("id", "op", "seq", "row").collect()
    assert [tuple(r) for r in found] == [(1, "I", 0, 10), (1, "I", 1, 11), (1, "I", 2, 12),
                                         (3, "D", 0, 13)]


@pytest.mark.parametrize("how", ["right", "full", "cross"])
def test_joins_that_keep_lookup_rows_are_refused(spark, how):
    rows = spark.range(3)
    with pytest.raises(ValueError, match="cannot be"):
        lk.lookup_join(rows, rows, ["id"], how)
