"""Checks on log rows and schemas. Bad rows are set aside, not dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import lookup_join


def set_apart(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that pass, and those that do not (a null outcome does not)."""
    passed = F.coalesce(good, F.lit(False))
    return df.where(passed), df.where(~passed)


def has_width(values: Column, width: Column | int) -> Column:
    return F.size(values) == width


def is_full_image(included: Column, width: Column | int) -> Column:
    """Whether every one of ``width`` columns is in the row image."""
    return has_width(included, width) & F.forall(included, lambda x: x)


def column_counts(columns: DataFrame) -> DataFrame:
    return columns.groupBy("db", "tbl").agg(F.count("*").cast("int").alias("columns"))


def table_map_mismatch(table_map: DataFrame, columns: DataFrame) -> DataFrame:
    """Mappings whose ``width`` is not the number of columns in the catalog."""
    known = column_counts(columns)
    return lookup_join(table_map, known, ["db", "tbl"], "left").where(
        ~F.col("width").eqNullSafe(F.col("columns")))


def schema_drift(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Columns missing in the sink, extra there, or of another type.

    Both sides have ``db, tbl, column_name, sink_type``, the source's being the type
    the sink should have.
    """
    key = ["db", "tbl", "column_name"]
    expected = source.select(*key, F.col("sink_type").alias("expected"),
                             F.lit(1).alias("in_source"))
    found = sink.select(*key, F.col("sink_type").alias("found"), F.lit(1).alias("in_sink"))
    drift = (F.when(F.col("in_sink").isNull(), "missing")
             .when(F.col("in_source").isNull(), "extra")
             .when(~F.col("expected").eqNullSafe(F.col("found")), "retyped"))
    return (expected.join(found, key, "full").withColumn("drift", drift)
            .where(F.col("drift").isNotNull()).select(*key, "drift", "expected", "found"))
