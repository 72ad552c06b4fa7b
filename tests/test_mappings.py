"""Table mappings carried from batch to batch, and raw events routed to many tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace import connect as c
from millrace.model import TableSpec
from millrace.operators import mappings as m
from millrace.operators import routing as ro
from millrace.plans.inputs import ACCOUNT
from millrace.sources import log as lg
from millrace.sources.log import RAW_EVENTS, TABLE_MAP
from millrace.sources.mappings import MappingState
from tests.test_log import _events, _map

ROWS = "epoch int, filename string, offset bigint, table_id bigint"


def brute_names(rows, mappings):
    """The name of the last mapping at or before each row."""
    def place(r):
        return len(r[1]), r[1], r[2]

    found = []
    for row in rows:
        before = [q for q in mappings if q[0] == row[0] and q[3] == row[3]
                  and place(q) <= place(row)]
        name = max(before, key=place)[4:] if before else (None, None)
        found.append((*row, *name))
    return sorted(found, key=str)


def _random_log(seed):
    rng = random.Random(seed)
    places = [(0, f"bin.{rng.choice([8, 9, 10, 999999, 1000000]):06d}", rng.randrange(40), t)
              for t in (1, 2) for _ in range(60)]
    mappings = [(*p, "d", rng.choice("ab")) for p in sorted(set(places))[::2]]
    rows = places + [(1, "bin.000001", 4, 1), (0, "bin.000009", 5, None), (0, "bin.000009", 5, 3)]
    return rng, rows, mappings


@pytest.mark.parametrize("limits", [{}, {"runs_per_table": 1}, {"broadcast_rows": 1}])
def test_names_of_mappings_that_land_in_any_order(spark, tmp_path, limits):
    """Late mappings fall into known runs, and some are delivered twice."""
    rng, rows, mappings = _random_log(3)
    rng.shuffle(mappings)
    folder = f"{tmp_path}/map"
    state = MappingState(spark, folder, f"{tmp_path}/state")
    table = spark.createDataFrame(rows, ROWS)
    for first in (0, 20, 40):
        known = mappings[:first + 20]
        for part in (mappings[first:first + 20], mappings[:first // 2 + 1]):
            spark.createDataFrame(part, TABLE_MAP).coalesce(1).write.mode("append").parquet(folder)
        state.refresh()
        found = state.names_at(table, **limits).collect()
        assert sorted(map(tuple, found), key=str) == brute_names(rows, known)


def test_runs_are_as_many_as_the_changes_of_names(spark, tmp_path):
    points = [(0, f"bin.{n // 100:06d}", n % 100, 1, "d", "a" if n < 700 else "b")
              for n in range(1000)]
    runs = m.merged_runs(m.file_runs(spark.createDataFrame(points, TABLE_MAP))).collect()
    assert sorted((r.filename, r.offset, r.last_filename, r.last_offset, r.tbl) for r in runs) == [
        ("bin.000000", 0, "bin.000006", 99, "a"), ("bin.000007", 0, "bin.000009", 99, "b")]


def test_a_refresh_reads_only_what_landed_since(spark, tmp_path):
    folder, root = f"{tmp_path}/map", f"{tmp_path}/state"
    state = MappingState(spark, folder, root)
    spark.createDataFrame([(0, "bin.000001", 4, 1, "d", "a")], TABLE_MAP).write.parquet(folder)
    state.refresh()
    seen = []
    state._merge = lambda batch, _: seen.extend(batch.collect())
    spark.createDataFrame([(0, "bin.000002", 4, 1, "d", "b")], TABLE_MAP).coalesce(1).write.mode(
        "append").parquet(folder)
    state.refresh()
    assert [r.tbl for r in seen] == ["b"]


def test_one_pass_gives_the_reasons_that_each_table_gives(spark):
    table = TableSpec("shop", "account", StructType([
        StructField("k", LongType()), StructField("v", StringType()),
        StructField("s", StringType())]), ("k",))
    changes = lg.row_changes(_events(spark))
    for spec in (table, ACCOUNT):
        want = {(r.offset, r.seq): r.reason for r in lg.table_changes(changes, _map(spark), spec)
                .collect()}
        runs = m.merged_runs(m.file_runs(_map(spark)))
        rows = ro.routed(m.names_at(ro.event_rows(_events(spark)), runs), [spec]).collect()
        ours = {(r.offset, r.seq): r.reason for r in rows if r.op and r.tbl}
        assert ours == want
        assert [r.offset for r in rows if r.route == ro.OTHER] == [400]
        assert [r.offset for r in rows if r.reason == "no table mapped"] == [700]


def test_a_batch_of_fifty_tables_is_read_once(spark, tmp_path):
    tables, per_table = 50, 40
    schema = StructType([StructField("k", LongType()), StructField("v", LongType())])
    specs = [TableSpec("d", f"t{n}", schema, ("k",)) for n in range(tables)]
    spark.createDataFrame([(0, "bin.000001", 4, n, "d", f"t{n}") for n in range(tables)],
                          TABLE_MAP).write.parquet(f"{tmp_path}/map")
    text = [str(k).encode() for k in range(per_table)]
    events = [(0, "bin.000001", 100 + n * per_table + k, "EXT_WRITE_ROWS", n, None, [True, True],
               [(None, [text[k], text[k] if k else b"?"])])
              for n in range(tables) for k in range(per_table)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame(events, RAW_EVENTS)
    batch = table.mapInArrow(counted, table.schema)
    source = c.RawLakeSource("d", {}, "", f"{tmp_path}/map", f"{tmp_path}/rejected")
    got = {}

    def keep(name):
        return lambda deltas, _: got.__setitem__(name, sorted(r.k for r in deltas.collect()))

    targets = [(spec, [keep(spec.name)]) for spec in specs]
    source.raw_processor(spark, "d", targets, f"{tmp_path}/state")(batch, 0)
    assert read.value == tables * per_table
    assert got == {f"t{n}": list(range(1, per_table)) for n in range(tables)}
    rejected = spark.read.parquet(f"{tmp_path}/rejected/rows")
    assert rejected.groupBy("reason").count().collect() == [("value not of its type", tables)]


def test_hot_tables_are_dealt_to_several_tasks(spark, tmp_path):
    """Names come by a broadcast join; then rows are dealt out by route, a hot one to many."""
    runs = m.merged_runs(m.file_runs(_map(spark)))
    rows = ro.routed(m.names_at(ro.event_rows(_events(spark)), runs), [ACCOUNT])
    plan = rows.hint("rebalance", "route")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    assert "BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()
    written = ro.write_routed(rows, f"{tmp_path}/routed")
    assert ro.routes_of(written) == {0, ro.REJECTED, ro.OTHER}
    assert written.where(F.col("route") == 0).count() == 4
