"""Raw log events to typed deltas, and key changes through a sink."""

from __future__ import annotations

import pytest
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from millrace import connect as c
from millrace.model import TableSpec
from millrace.operators import mappings as m
from millrace.plans.inputs import ACCOUNT
from millrace.sources import log as lg
from tests.test_merge import SCHEMA, delta, rows_of

MAP = "epoch int, filename string, offset bigint, table_id bigint, db string, tbl string"
ALL, FILE = [True] * 3, "bin.000001"


def _values(*values):
    return [None if v is None else bytearray(str(v), "utf-8") for v in values]


def _event(offset, kind, *rows, table_id=1, before=None, included=ALL):
    return 0, FILE, offset, kind, table_id, before, included, list(rows)


def _events(spark):
    one, two = _values(1, 1.5, "é"), _values(2, None, None)
    return spark.createDataFrame([
        _event(100, "EXT_WRITE_ROWS", (None, one), (None, two)),
        _event(200, "EXT_UPDATE_ROWS", (one, two), before=ALL),
        _event(300, "EXT_DELETE_ROWS", (two, None), before=ALL, included=None),
        _event(400, "QUERY", (None, one)),
        _event(500, "EXT_WRITE_ROWS", (None, one[:2])),
        _event(510, "EXT_WRITE_ROWS", (None, one), included=[True, True]),
        _event(520, "EXT_UPDATE_ROWS", (one, one), before=[True, False, True]),
        _event(530, "EXT_WRITE_ROWS", (None, _values("x", 1.0, "s"))),
        _event(540, "EXT_WRITE_ROWS", (None, _values(1, "much", "s"))),
        _event(550, "EXT_WRITE_ROWS", (None, [*_values(1, 1.0), bytearray(b"\xff\xfe")])),
        _event(600, "EXT_WRITE_ROWS", (None, one), table_id=2),
        _event(700, "EXT_WRITE_ROWS", (None, one), table_id=3),
        _event(900, "EXT_WRITE_ROWS", (None, one)),
    ], lg.RAW_EVENTS)


def _map(spark):
    return spark.createDataFrame([
        (0, FILE, 4, 1, "shop", "account"), (0, FILE, 4, 2, "shop", "session"),
        (0, FILE, 800, 1, "other", "account"), (0, FILE, 999, 3, "shop", "account")], MAP)


def test_typed_changes(spark):
    found = lg.table_changes(lg.row_changes(_events(spark)), _map(spark), ACCOUNT).collect()
    good = sorted((r.offset, r.seq, r.op, r.k, r.before and tuple(r.before),
                   r.after and tuple(r.after)) for r in found if r.reason is None)
    one, two = (1, 1.5, "é"), (2, None, None)
    assert good == [(100, 0, "I", 1, None, one), (100, 1, "I", 2, None, two),
                    (200, 0, "U", 2, one, two), (300, 0, "D", 2, two, None)]
    assert {r.offset: r.reason for r in found if r.reason} == {
        500: "wrong number of values", 510: "partial row image", 520: "partial row image",
        530: "value not of its type", 540: "value not of its type",
        550: "value not of its type"}


def test_unmapped_changes(spark):
    lost = lg.unmapped_changes(lg.row_changes(_events(spark)), _map(spark)).collect()
    assert [r.offset for r in lost] == [700]  # its mapping comes later


def test_a_key_change_reaches_the_state(spark, tmp_path):
    sink = c.StateSink(str(tmp_path), "d", buckets=2)
    sink.open(spark)
    process = sink.processor(ACCOUNT, "shop")
    process(spark.createDataFrame([delta("I", k, 0, file=0) for k in (1, 2)], SCHEMA),
            c.BACKFILL_BATCH)
    moved = delta("U", 3, 5, before=(1, 0.0, "I"), after=(3, 9.0, "moved"))
    for _ in range(2):
        process(spark.createDataFrame([moved], SCHEMA), 0)
    assert rows_of(sink.state(ACCOUNT).rows()) == [(2, 0.0, "I"), (3, 9.0, "moved")]


def test_raw_events_through_a_run(spark, tmp_path):
    """Good rows reach the state; bad bytes, unmapped tables and unknown events are set apart."""
    _events(spark).coalesce(1).write.parquet(f"{tmp_path}/events")
    _map(spark).write.parquet(f"{tmp_path}/map")
    spark.createDataFrame([(5, 5.0, "old")], ACCOUNT.schema).write.parquet(f"{tmp_path}/rows")
    specification = {
        "importers": {"shop": {
            "type": "raw", "database": "shop", "events": f"{tmp_path}/events",
            "table_map": f"{tmp_path}/map", "rejected": f"{tmp_path}/rejected",
            "tables": {"account": {"rows": f"{tmp_path}/rows", "key": ["k"]}}}},
        "exporters": {"now": {"type": "state", "warehouse": f"{tmp_path}/w", "dataset_id": "d"}},
        "connections": {"a": {"in": "shop", "out": "now"}},
    }
    for _ in range(2):
        sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
    # Key 1 became key 2, which was deleted.
    assert rows_of(sinks["now"].state(ACCOUNT).rows()) == [(5, 5.0, "old")]
    rejected = spark.read.parquet(f"{tmp_path}/rejected/rows").collect()
    assert sorted((r.offset, r.reason) for r in rejected) == [
        (500, "wrong number of values"), (510, "partial row image"), (520, "partial row image"),
        (530, "value not of its type"), (540, "value not of its type"),
        (550, "value not of its type"), (700, "no table mapped")]
    others = spark.read.parquet(f"{tmp_path}/rejected/events").select("event_type", "count")
    assert [tuple(r) for r in others.collect()] == [("QUERY", 1)]


def test_rows_are_read_by_the_schema_of_their_position(spark):
    """A column added, one dropped, one widened; images come in the columns of now."""
    def schema(*columns):
        return StructType([StructField(n, t) for n, t in columns])

    first = schema(("k", IntegerType()), ("gone", StringType()))
    second = schema(("k", LongType()), ("gone", StringType()), ("s", StringType()))
    now = schema(("k", LongType()), ("s", StringType()), ("v", DoubleType()))
    history = lg.SchemaHistory(TableSpec("shop", "account", now, ("k",)), (
        (first, (0, FILE, 200)), (second, (0, "bin.000002", 4))))

    def event(file, offset, *values):
        return 0, file, offset, "EXT_WRITE_ROWS", 1, None, [True] * len(values), [
            (None, _values(*values))]

    later = "bin.1000000"
    events = spark.createDataFrame([
        event(FILE, 100, 1, "x"), event(FILE, 200, 2, "x", "a"), event(FILE, 300, 3, "x"),
        event("bin.000002", 4, 4, "b", 1.5), event(later, 4, 5, None, None),
        event(later, 5, 6, "c", "y")], lg.RAW_EVENTS)
    mapped = spark.createDataFrame([(0, FILE, 4, 1, "shop", "account")], MAP)
    found = lg.typed_by_history(m.names_at(
        lg.row_changes(events), m.merged_runs(m.file_runs(mapped))), history).collect()
    assert sorted((r.filename, r.offset, r.reason or tuple(r.after)) for r in found) == sorted([
        (FILE, 100, (1, None, None)), (FILE, 200, (2, "a", None)),
        (FILE, 300, "partial row image"), ("bin.000002", 4, (4, "b", 1.5)),
        (later, 4, (5, None, None)), (later, 5, "value not of its type")])
    with pytest.raises(ValueError, match="added later"):
        lg.typed_by_history(mapped, lg.SchemaHistory(
            TableSpec("shop", "account", now, ("s",)), ((first, (0, FILE, 9)),)))
