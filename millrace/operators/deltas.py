"""From rows and log events to deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import (BACKFILL_FILENAME, BACKFILL_OFFSET, DELETE, DELTA_ID, INSERT, UPDATE,
                     TableSpec)

# The log's event types and the operation each stands for.
EVENT_OPS = {"EXT_WRITE_ROWS": INSERT, "EXT_UPDATE_ROWS": UPDATE, "EXT_DELETE_ROWS": DELETE}
TABLE_MAP_EVENT = "TABLE_MAP"


def backfill_deltas(rows: DataFrame, table: TableSpec, epoch: int) -> DataFrame:
    """Every row as an insert at the epoch's backfill position."""
    columns = table.schema.fieldNames()
    return rows.select(
        F.lit(table.db).alias("db"),
        F.lit(table.name).alias("tbl"),
        F.lit(INSERT).alias("op"),
        *table.key,
        F.lit(None).cast(table.schema).alias("before"),
        F.struct(*columns).alias("after"),
        F.lit(epoch).alias("epoch"),
        F.lit(BACKFILL_FILENAME).alias("filename"),
        F.lit(BACKFILL_OFFSET).cast("long").alias("offset"),
        F.lit(0).alias("seq"),
    )


def operation(event_type: Column) -> Column:
    """``I``, ``U`` or ``D`` for a row event, null for any other event."""
    op = F.lit(None).cast("string")
    for name, code in EVENT_OPS.items():
        op = F.when(event_type == name, code).otherwise(op)
    return op


def row_events(events: DataFrame, event_type: str = "event_type") -> DataFrame:
    """The row events with their ``op``; all other events are left out."""
    return events.withColumn("op", operation(F.col(event_type))).where(F.col("op").isNotNull())


def unpack_rows(events: DataFrame, rows: str = "rows") -> DataFrame:
    """One row per element of the event's row array, ``seq`` being its place."""
    return events.select("*", F.posexplode(rows).alias("seq", "row")).drop(rows)


def inserts(log: DataFrame) -> DataFrame:
    return log.where(F.col("op") == INSERT)


def updates(log: DataFrame) -> DataFrame:
    return log.where(F.col("op") == UPDATE)


def deletes(log: DataFrame) -> DataFrame:
    return log.where(F.col("op") == DELETE)


def delta_kind(before: Column, after: Column) -> Column:
    """The operation, told from which side is null."""
    return F.when(after.isNull(), DELETE).when(before.isNull(), INSERT).otherwise(UPDATE)


def of_database(df: DataFrame, db: str) -> DataFrame:
    return df.where(F.col("db") == db)


def delta_id(key: Sequence[str]) -> list[str]:
    """The columns that identify a delta of a table with this key."""
    if not key:
        raise ValueError("copies of a keyless table's backfill rows cannot be told from rows")
    return [*DELTA_ID, *key]


def without_repeats(deltas: DataFrame, key: Sequence[str]) -> DataFrame:
    """One of each delivered delta. Copies are reduced before the shuffle."""
    return deltas.dropDuplicates(delta_id(key))


def fan_in(sources: dict[str, DataFrame]) -> DataFrame:
    """The deltas of several sources, each marked with its ``source``."""
    marked = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    merged = marked[0]
    for df in marked[1:]:
        merged = merged.unionByName(df)
    return merged


def generated_rows(ids: DataFrame, id_column: str) -> DataFrame:
    """Test rows ``(id, comment, user_id)``, one per id, the same on every run."""
    i = F.col(id_column)
    small = i % 2147483648  # keeps the products within a long
    return ids.select(
        ((small * 1103515245 + 12345) % 2147483648).alias("id"),
        F.concat(F.lit("Hello "), i.cast("string")).alias("comment"),
        ((small * 69069 + 1) % 2147483648).alias("user_id"),
    )
