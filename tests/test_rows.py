"""Texts, types, catalogs and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.functions import types as ty
from millrace.operators import checks as c
from millrace.operators import metrics as m
from millrace.operators.deltas import delta_kind
from millrace.sinks.tables import delta_lines, sink_schema
from millrace.sources import catalog as cat


def test_joined_text(spark):
    rows = spark.createDataFrame([(["a", None, "c"],), ([],), (["x"],), ([None],)],
                                 "v array<string>")
    assert [r[0] for r in rows.select(t.joined_text(F.col("v"), "--")).collect()] == [
        "a--null--c", "", "x", "null"]
    assert rows.select(t.row_text(F.col("v"))).first()[0] == "Row: a:null:c"
    assert rows.select(t.key_text(F.col("v"))).first()[0] == "Key: a:null:c"


def test_record_keeps_nulls(spark):
    row = spark.createDataFrame([(1, None)], "k int, s string")
    assert row.select(t.row_record("k", "s")).first()[0] == '{"k":1,"s":null}'


def test_delta_line(spark):
    row = spark.createDataFrame(
        [((1, None), None, 0, "bin.000001", 4)],
        "before struct<k:int,s:string>, after struct<k:int,s:string>, epoch int, filename string, "
        "offset bigint")
    assert delta_lines(row, F.lit("T"), ["k", "s"]).first().line == (
        "Got T: Row: 1:null -> null @ MySqlStreamPosition: (0:bin.000001:4)")


def test_text_of_log_bytes(spark):
    rows = spark.createDataFrame([(bytearray("é", "utf-8"),), (None,)], "b binary")
    assert [r[0] for r in rows.select(ty.read_text(F.col("b"))).collect()] == ["é", None]
    latin = spark.createDataFrame([(bytearray("é", "latin-1"),)], "b binary")
    assert latin.select(ty.read_text(F.col("b"), "ISO-8859-1")).first()[0] == "é"


def test_integers_outside_their_width_are_told(spark):
    rows = spark.createDataFrame([(127,), (128,), (None,)], "v bigint")
    found = rows.select(ty.read_int(F.col("v"), "TINYINT").alias("v"),
                        ty.fits(F.col("v"), "TINYINT").alias("fits")).collect()
    assert [tuple(r) for r in found] == [(127, True), (None, False), (None, True)]


def _catalog(spark):
    tables = spark.createDataFrame(
        [("d", "t", "BASE TABLE"), ("d", "v", "VIEW"), ("d", "bad", "BASE TABLE"),
         ("d", "nokey", "BASE TABLE"), ("e", "ghost", "BASE TABLE")],
        "db string, tbl string, table_type string")
    columns = spark.createDataFrame(
        [("d", "t", "id", 1, "INT", 11), ("d", "t", "name", 2, "VARCHAR", 40),
         ("d", "t", "big", 3, "BIGINT", 20), ("d", "bad", "at", 1, "DATETIME", 0),
         ("d", "nokey", "x", 1, "MEDIUMINT", 8), ("e", "ghost", "x", 1, "TINYINT", 4)],
        "db string, tbl string, column_name string, ordinal int, sql_type string, size int")
    indexes = spark.createDataFrame(
        [("d", "t", "PRIMARY", 2, "id"), ("d", "t", "PRIMARY", 1, "big"),
         ("d", "t", "other", 1, "name"), ("e", "ghost", "PRIMARY", 1, "y")],
        "db string, tbl string, index_name string, seq int, column_name string")
    return tables, columns, indexes


def test_catalog(spark):
    tables, columns, indexes = _catalog(spark)
    assert sorted(r.tbl for r in cat.base_tables(tables, "d").collect()) == ["bad", "nokey", "t"]
    keys = {r.tbl: r for r in cat.primary_keys(columns, indexes).collect()}
    assert (keys["t"].key, keys["t"].places, keys["t"].known) == (["big", "id"], [2, 0], True)
    assert keys["ghost"].known is False and "nokey" not in keys
    schemas = {r.tbl: r for r in cat.table_schemas(tables, columns, indexes).collect()}
    assert schemas["t"].schema_text == (
        "d.t, Cols: [id - INT(4), name - STRING(40), big - INT(8)], PK: [big, id]")
    assert schemas["nokey"].schema_text == "d.nokey, Cols: [x - INT(1)], PK: []"
    assert schemas["bad"].error == "unrecognized type DATETIME"
    assert schemas["ghost"].error == "unknown primary key column"


def test_sink_schema_has_comments(spark):
    _, columns, _ = _catalog(spark)
    wanted = cat.sink_columns_for(columns).where("tbl = 't'").orderBy("ordinal").collect()
    schema = sink_schema([(r.column_name, r.sink_type, r.comment) for r in wanted])
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "string", "bigint"]
    assert schema["id"].metadata["comment"] == "Automatically created for table d.t"


def test_images(spark):
    rows = spark.createDataFrame([([True, True],), ([True, False],), ([True],), (None,)],
                                 "i array<boolean>")
    good, bad = c.set_apart(rows, c.is_full_image(F.col("i"), 2))
    assert (good.count(), bad.count()) == (1, 3)


def test_kinds(spark):
    rows = spark.createDataFrame([(None, 1), (1, 2), (1, None)], "b int, a int")
    assert [r[0] for r in rows.select(delta_kind(F.col("b"), F.col("a"))).collect()] == [
        "I", "U", "D"]


def test_batch_hits_is_the_counting_loop(spark):
    for size in (1, 3, 10):
        for n in (1, 2, 3, 9, 10, 11, 30, 31):
            value = hits = 0
            for _ in range(n):
                if value >= size:
                    hits, value = hits + 1, 1
                else:
                    value += 1
            counts = spark.range(1).select(
                F.lit("d").alias("db"), F.lit("t").alias("tbl"), F.lit("backfill").alias("phase"),
                F.lit(n).cast("long").alias("count"))
            row = m.batch_hits(counts, size).first()
            assert tuple(row) == ("d.t-backfill", hits, value)


def test_drift(spark):
    source = spark.createDataFrame(
        [("d", "t", "a", "INTEGER"), ("d", "t", "b", "STRING"), ("d", "t", "c", "STRING"),
         ("e", "t", "a", "STRING")],
        "db string, tbl string, column_name string, sink_type string")
    sink = spark.createDataFrame(
        [("d", "t", "a", "STRING"), ("d", "t", "b", "STRING"), ("d", "t", "z", "FLOAT"),
         ("e", "t", "a", "STRING")], source.schema)
    assert {(r.db, r.column_name, r.drift) for r in c.schema_drift(source, sink).collect()} == {
        ("d", "a", "retyped"), ("d", "c", "missing"), ("d", "z", "extra")}


def test_catalogs_are_merged_and_not_broadcast(spark, tmp_path):
    """A catalog's columns are many more than its files' size tells, so none is broadcast."""
    stored = []
    for k, rows in enumerate(_catalog(spark)):
        rows.write.parquet(f"{tmp_path}/{k}")
        stored.append(spark.read.parquet(f"{tmp_path}/{k}"))
    for found in cat.primary_keys(*stored[1:]), cat.table_schemas(*stored):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
