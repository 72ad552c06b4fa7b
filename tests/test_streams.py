"""Streams give what the batch jobs give, over restarts and repeats."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, ShortType, StructField, StructType

from millrace import connect as c
from millrace.model import TableSpec
from millrace.operators.deltas import backfill_deltas
from millrace.plans.inputs import ACCOUNT
from millrace.session import new_folder, shared_folder
from millrace.sinks.state import StateTable
from millrace.sinks.tables import append_rows, fan_out, read_appended, sink_table_name
from millrace.sources.log import stream_log
from millrace.streaming import runs as r
from tests.test_merge import SCHEMA, _history, delta, expected, rows_of


def _land(spark, path, *files):
    for deltas in files:
        spark.createDataFrame(deltas, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_restart_goes_on_where_it_was(spark, tmp_path):
    log, out, checkpoint = f"{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    batches = []

    def note(batch, batch_id):
        batches.append((batch_id, batch.count()))

    for n in range(3):
        _land(spark, log, [delta("I", k, n) for k in range(n + 1)])
        r.run(stream_log(spark, log, SCHEMA), [note], checkpoint)
    r.run(stream_log(spark, log, SCHEMA), [note], checkpoint)
    assert batches == [(0, 1), (1, 2), (2, 3)]
    r.write_stream(stream_log(spark, log, SCHEMA), out, f"{tmp_path}/other")
    assert spark.read.parquet(out).count() == 6


@pytest.mark.parametrize("copy_tasks", [1, 8])
def test_repeats_over_batches_and_within(spark, tmp_path, copy_tasks):
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"
    rows = [delta("U", k, n) for n, k in enumerate([1, 1, 2, 3])]
    copies = [delta("U", 9, 50)] * 40
    _land(spark, log, rows + copies, rows[1:] + copies, rows)
    stream = stream_log(spark, log, SCHEMA, files_per_batch=1)
    r.write_stream(r.without_repeats(stream, ["k"], copy_tasks), out, f"{tmp_path}/checkpoint")
    found = spark.read.parquet(out)
    assert found.count() == 5
    assert found.select("k", "offset").distinct().count() == 5


def test_counts_and_latest_over_batches(spark, tmp_path):
    log, backfill = _history(21)
    _land(spark, f"{tmp_path}/log", log[:70], backfill, log[70:])
    stream = stream_log(spark, f"{tmp_path}/log", SCHEMA, files_per_batch=1)

    counts = {}

    def keep(batch, _):
        counts.update({row.phase: row["count"] for row in batch.collect()})

    r.run(r.running_counts(stream), [keep], f"{tmp_path}/counts", "update")
    assert counts == {"backfill": len(backfill), "iterative": len(log)}

    state = {}

    def update(batch, _):
        state.update({row.k: row for row in batch.collect()})

    r.run(r.running_latest(stream, ["k"]), [update], f"{tmp_path}/latest", "update")
    live = sorted(tuple(row.after) for row in state.values() if row.op != "D")
    assert live == expected(log + backfill)


def test_fan_out_reads_a_batch_once(spark):
    seen = []
    batch = spark.range(5)
    fan_out([lambda df, n: seen.append((n, df.is_cached, df.count()))] * 2)(batch, 7)
    assert seen == [(7, True, 5)] * 2
    assert not batch.is_cached


def test_a_repeated_batch_is_appended_once(spark, tmp_path):
    rows = spark.createDataFrame([delta("I", 1, 1), delta("D", 2, 2)], SCHEMA)
    for batch_id in (0, 1, 1):
        append_rows(rows, f"{tmp_path}/out", batch_id)
    assert read_appended(spark, f"{tmp_path}/out", ACCOUNT.schema).count() == 2


def _specification(tmp_path, **lake):
    return {
        "importers": {"shop": {"type": "lake", "database": "shop", "tables": {
            "account": {"rows": f"{tmp_path}/rows", "log": f"{tmp_path}/log", **lake}}}},
        "exporters": {
            "now": {"type": "state", "warehouse": f"{tmp_path}/w", "dataset_id": "now",
                    "buckets": 3, "compact_every": 1},
            "all": {"type": "append", "warehouse": f"{tmp_path}/w", "dataset_id": "all"},
            "idle": {"type": "append", "warehouse": f"{tmp_path}/w", "dataset_id": "idle"},
        },
        "connections": {"a": {"in": "shop", "out": "now"}, "b": {"in": "shop", "out": "all"}},
    }


def test_run_and_run_again(spark, tmp_path):
    log, backfill = _history(22)
    spark.createDataFrame([d[5] for d in backfill], ACCOUNT.schema).write.parquet(
        f"{tmp_path}/rows")
    _land(spark, f"{tmp_path}/log", log[:50])
    specification = _specification(tmp_path, key=["k"])
    c.run(spark, specification, f"{tmp_path}/checkpoints")
    _land(spark, f"{tmp_path}/log", log[50:])
    sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
    assert rows_of(sinks["now"].state(ACCOUNT).rows()) == expected(log + backfill)
    appended = read_appended(spark, sinks["all"].path(ACCOUNT), ACCOUNT.schema)
    assert appended.count() == len(backfill) + sum(d[2] != "D" for d in log)


def test_a_table_without_a_key_is_only_appended(spark, tmp_path):
    spark.createDataFrame([(1, 1.0, "a")] * 3, ACCOUNT.schema).write.parquet(f"{tmp_path}/rows")
    specification = _specification(tmp_path)
    del specification["importers"]["shop"]["tables"]["account"]["log"]
    with pytest.raises(ValueError, match="no primary key"):
        c.run(spark, specification, f"{tmp_path}/checkpoints")
    del specification["connections"]["a"]
    sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
    keyless = TableSpec("shop", "account", ACCOUNT.schema)
    assert read_appended(spark, sinks["all"].path(keyless), ACCOUNT.schema).count() == 3


def test_sink_tables_are_created_and_checked(spark, tmp_path):
    database = "checked_" + new_folder(spark, "x")[-8:]
    rows = spark.createDataFrame([delta("I", 1, 1), delta("D", 2, 2)], SCHEMA)
    sink = c.AppendSink(f"{tmp_path}/w", "d", database=database)
    try:
        sink.open(spark)
        for batch_id in (-1, 0):
            sink.processor(ACCOUNT, "shop")(rows, batch_id)
        spark.catalog.refreshTable(f"{database}.shop__account")
        table = spark.table(f"{database}.shop__account")
        assert table.columns == ["k", "v", "s"] and table.count() == 2
        assert {column.description for column in spark.catalog.listColumns(
            f"{database}.shop__account")} == {"Automatically created for table shop.account"}
        small = TableSpec("a_b", "c", StructType([StructField("n", ShortType())]))
        other = TableSpec("a", "b_c", small.schema)
        for part in (small, other):
            values = spark.range(3).select(F.struct(F.col("id").cast("short").alias("n")).alias(
                "after"), F.lit("I").alias("op"))
            sink.processor(part, "shop")(values, 0)
            name = f"{database}.{sink_table_name(part)}"
            spark.catalog.refreshTable(name)
            assert spark.table(name).schema.simpleString() == "struct<n:bigint>"
            assert spark.table(name).count() == 3
        changed = StructType([*ACCOUNT.schema.fields[:2], StructField("s", LongType()),
                              StructField("new", LongType())])
        with pytest.raises(ValueError, match="drifted") as drift:
            sink.processor(TableSpec("shop", "account", changed, ("k",)), "shop")
        assert "'s': ('bigint', 'string')" in str(drift.value)
        assert "'new': ('bigint', None)" in str(drift.value)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_specifications(spark, tmp_path):
    good = _specification(tmp_path, key=["k"])
    as_json = tmp_path / "spec.json"
    as_json.write_text(json.dumps(good))
    assert c.load_specification(str(as_json)) == good
    as_yaml = tmp_path / "spec.yaml"
    as_yaml.write_text("""
importers:
  test: {type: mysql, host: localhost, port: 3306, user: root, password: test, database: shop,
         batch_size: 10000, epoch: 0, concurrent_full_imports: 5}
exporters:
  out: {type: state, application_name: Test, project_id: p, dataset_id: test, warehouse: /w}
connections:
  link: {in: test, out: out}
""")
    pytest.importorskip("yaml")
    sources, sinks, links = c.connect(c.load_specification(str(as_yaml)))
    assert (sources["test"].batch_size, sinks["out"].root, links) == (
        10000, "/w/p/test", [("test", "out")])
    assert "password" not in repr(sources["test"])
    for part, name, change in (("importers", "shop", {"type": "tape"}),
                               ("connections", "a", {"in": "shop", "out": "nowhere"})):
        with pytest.raises(ValueError):
            c.connect({**good, part: {**good[part], name: change}})


def test_scratch_is_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert new_folder(spark, "x").startswith(shared_folder(spark))
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_state_as_stream_sink(spark, tmp_path):
    log, backfill = _history(23)
    _land(spark, f"{tmp_path}/log", log[100:] + log[:40], log[:100])
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=3)
    r.run(stream_log(spark, f"{tmp_path}/log", SCHEMA, 1), [state.apply], f"{tmp_path}/cp")
    state.apply(spark.createDataFrame(backfill, SCHEMA), 99)
    assert rows_of(state.rows()) == expected(log + backfill)
    assert state.latest().agg(F.count("*")).first()[0] == 40


def test_two_sources_of_one_table_and_a_new_checkpoint(spark, tmp_path):
    for part, keys in (("a", (1, 2)), ("b", (3,))):
        spark.createDataFrame([(k, 1.0, part) for k in keys], ACCOUNT.schema).write.parquet(
            f"{tmp_path}/{part}")
    specification = _specification(tmp_path, key=["k"])
    shop = specification["importers"]["shop"]
    specification["importers"] = {part: {**shop, "tables": {"account": {
        "rows": f"{tmp_path}/{part}", "log": f"{tmp_path}/log", "key": ["k"]}}} for part in "ab"}
    specification["connections"] = {f"{s}{t}": {"in": s, "out": t} for s in "ab"
                                    for t in ("now", "all")}
    for checkpoint, key in (("one", 10), ("two", 11)):
        spark.createDataFrame([delta("I", key, key)], SCHEMA).write.mode("overwrite").parquet(
            f"{tmp_path}/log")
        sinks = c.run(spark, specification, f"{tmp_path}/{checkpoint}")
    assert {r.k for r in sinks["now"].state(ACCOUNT).rows().collect()} == {1, 2, 3, 10, 11}
    appended = read_appended(spark, sinks["all"].path(ACCOUNT), ACCOUNT.schema)
    assert {r.k for r in appended.collect()} == {1, 2, 3, 10, 11}


@pytest.mark.parametrize("compact_every", [None, 1])
def test_a_new_epoch_replaces_the_old_one(spark, tmp_path, compact_every):
    specification = _specification(tmp_path, key=["k"])
    shop, now = specification["importers"]["shop"], specification["exporters"]["now"]
    del shop["tables"]["account"]["log"]
    now["compact_every"] = compact_every
    for epoch, rows in ((0, [(1, 1.0, "a"), (2, 1.0, "a")]), (0, [(9, 9.0, "z")]),
                        (1, [(2, 2.0, "b"), (3, 2.0, "b")])):
        spark.createDataFrame(rows, ACCOUNT.schema).write.mode("overwrite").parquet(
            f"{tmp_path}/rows")
        shop["epoch"] = epoch
        sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
        found = {tuple(r)[0] for r in sinks["now"].state(ACCOUNT).rows().select("k").collect()}
        assert found == ({2, 3} if epoch else {1, 2})
    shop["epoch"] = 0
    with pytest.raises(ValueError, match="is over"):
        c.run(spark, specification, f"{tmp_path}/checkpoints")


def test_no_table_is_written_when_one_cannot_be(spark, tmp_path):
    spark.createDataFrame([(1, 1.0, "a")], ACCOUNT.schema).write.parquet(f"{tmp_path}/rows")
    specification = _specification(tmp_path, key=["k"])
    tables = specification["importers"]["shop"]["tables"]
    del tables["account"]["log"]
    tables["keyless"] = {"rows": f"{tmp_path}/rows"}
    with pytest.raises(ValueError, match="no primary key"):
        c.run(spark, specification, f"{tmp_path}/checkpoints")
    assert not (tmp_path / "w").exists()


def test_a_stopped_backfill_goes_on_with_its_part(spark, tmp_path, monkeypatch):
    reads, broken = [], [True]

    class Parts:
        """Ten rows in three parts; the second cannot be read at first."""

        def feeds(self, spark):
            def parts(folder):
                for n in range(3):
                    reads.append(n)
                    if n == 1 and broken:
                        raise OSError("gone")
                    rows = spark.range(10).where(f"id % 3 = {n}").selectExpr(
                        "id AS k", "CAST(id AS double) AS v", "'a' AS s")
                    yield f"r{n}", backfill_deltas(rows, ACCOUNT, 0)

            yield c.Feed(ACCOUNT, None, read_once=True, parts=parts)

    monkeypatch.setitem(c.SOURCES, "parts", Parts)
    specification = _specification(tmp_path)
    specification["importers"] = {"shop": {"type": "parts"}}
    with pytest.raises(OSError):
        c.run(spark, specification, f"{tmp_path}/checkpoints")
    broken.clear()
    for _ in range(2):
        sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
        assert read_appended(spark, sinks["all"].path(ACCOUNT), ACCOUNT.schema).count() == 10
        assert sinks["now"].state(ACCOUNT).rows().count() == 10
    assert reads == [0, 1, 0, 1, 2]  # parts are named again, but only read when they are new
