"""Source catalogs: tables, columns and primary keys, as DataFrames.

``tables``   ``db, tbl, table_type``
``columns``  ``db, tbl, column_name, ordinal, sql_type, size``
``indexes``  ``db, tbl, index_name, seq, column_name``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import column_text, schema_text, table_comment, table_id
from ..functions.types import engine_length, engine_type, sink_type, spark_type

# Fixed values of the catalog.
BASE_TABLE = "BASE TABLE"
PRIMARY_INDEX = "PRIMARY"
TABLE = ["db", "tbl"]


def base_tables(tables: DataFrame, db: str | None = None) -> DataFrame:
    """The tables, without views, of one database or of all."""
    found = tables.where(F.col("table_type") == BASE_TABLE)
    return (found if db is None else found.where(F.col("db") == db)).select(*TABLE)


def typed_columns(columns: DataFrame) -> DataFrame:
    """The columns with engine type, length, and Spark type.

    ``supported`` is false, and the types null, for a source type outside the
    type map.
    """
    kind = F.col("sql_type")
    return columns.select(
        *TABLE, "column_name", "ordinal", "sql_type",
        engine_type(kind).alias("engine_type"),
        engine_length(kind, F.col("size")).alias("length"),
        spark_type(kind).alias("spark_type"),
        engine_type(kind).isNotNull().alias("supported"),
    )


def primary_keys(columns: DataFrame, indexes: DataFrame) -> DataFrame:
    """Per table its key columns and their zero-based places, in index order.

    ``known`` is false when the index names a column the table has not. A key has
    few columns, so gathering it per table is safe. The columns of a whole catalog are merged
    with the keys and never broadcast, however small they are taken to be.
    """
    primary = indexes.where(F.col("index_name") == PRIMARY_INDEX)
    place = columns.select(*TABLE, "column_name", (F.col("ordinal") - 1).alias("place"))
    parts = primary.join(place.hint("merge"), [*TABLE, "column_name"], "left").groupBy(*TABLE).agg(
        F.array_sort(F.collect_list(F.struct("seq", "column_name", "place"))).alias("parts"))
    return parts.select(
        *TABLE,
        F.col("parts.column_name").alias("key"),
        F.col("parts.place").alias("places"),
        F.forall("parts", lambda p: p["place"].isNotNull()).alias("known"),
    )


def table_schemas(tables: DataFrame, columns: DataFrame, indexes: DataFrame) -> DataFrame:
    """One row per base table: schema text, or the error that keeps it from loading.

    All of it is merged by table; nothing that grows with the catalog is broadcast.
    """
    typed = typed_columns(columns)
    text = column_text(F.col("column_name"), F.col("engine_type"), F.col("length"))
    described = typed.groupBy(*TABLE).agg(
        F.array_sort(F.collect_list(F.struct("ordinal", text.alias("text")))).alias("cols"),
        F.min(F.when(~F.col("supported"), F.col("sql_type"))).alias("bad_type"),
    )
    keys = primary_keys(columns, indexes)
    error = (F.when(F.col("bad_type").isNotNull(),
                    F.concat(F.lit("unrecognized type "), F.col("bad_type")))
             .when(F.col("known") == F.lit(False), "unknown primary key column"))
    key = F.coalesce("key", F.array().cast("array<string>"))
    full_text = schema_text(F.col("db"), F.col("tbl"), F.col("cols.text"), key)
    return (
        base_tables(tables).join(described.hint("merge"), TABLE)
        .join(keys.hint("merge"), TABLE, "left")
        .withColumn("error", error)
        .select(*TABLE, F.when(F.col("error").isNull(), full_text).alias("schema_text"), "error")
    )


def sink_columns_for(columns: DataFrame) -> DataFrame:
    """The columns a sink table gets for each source column of a supported type."""
    return typed_columns(columns).where("supported").select(
        *TABLE, "column_name", "ordinal",
        sink_type(F.col("engine_type")).alias("sink_type"),
        table_comment(table_id(F.col("db"), F.col("tbl"))).alias("comment"),
    )
