"""Table mappings as runs: the stretches of the log in which a table id has one name.

A log repeats its mappings, so the runs of a table id are few where its mappings are many. A
run is ``epoch, table_id``, the position of its first mapping (``filename, offset``), that of its
last (``last_filename, last_offset``) and ``db, tbl``; it is in force until the next run's first
mapping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.position import position_columns
from ..session import BROADCAST_ROWS, stored
from .lookups import FILE_MAPPINGS, MAPPING, orphans, table_at

TABLE_KEY = ("epoch", "table_id")
RUNS = ("epoch int, table_id bigint, filename string, offset bigint, last_filename string, "
        "last_offset bigint, db string, tbl string")


def _place(filename: str, offset: str) -> Column:
    """A position within an epoch, in an order that structs are compared in."""
    return F.struct(F.length(filename).alias("length"), F.col(filename).alias("filename"),
                    F.col(offset).alias("offset"))


def _joined(points: DataFrame, key: Sequence[str]) -> DataFrame:
    """Neighbouring mappings of one name, in the order of each ``key``, as one run."""
    name = F.struct("db", "tbl")
    order = W.partitionBy(*key).orderBy(*position_columns()[1:], "db", "tbl")
    begins = ~F.lag(name).over(order).eqNullSafe(name)
    place = _place("filename", "offset")
    runs = points.withColumn("run", F.sum(begins.cast("long")).over(order)).groupBy(
        *key, "run", "db", "tbl").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    return runs.select(
        *TABLE_KEY, F.col("first.filename").alias("filename"),
        F.col("first.offset").alias("offset"), F.col("last.filename").alias("last_filename"),
        F.col("last.offset").alias("last_offset"), "db", "tbl")


def file_runs(table_map: DataFrame) -> DataFrame:
    """The runs within each file, which spread over tasks by file and table id."""
    return _joined(table_map.where("table_id IS NOT NULL"), MAPPING)


def _ends(runs: DataFrame) -> DataFrame:
    """A run's two ends as mappings; ``is_last`` marks the second, if there is one."""
    one = (F.col("filename") == F.col("last_filename")) & (F.col("offset") == F.col("last_offset"))
    first = F.struct("filename", "offset", F.lit(False).alias("is_last"))
    last = F.struct(F.col("last_filename").alias("filename"),
                    F.col("last_offset").alias("offset"), F.lit(True).alias("is_last"))
    return runs.select(*TABLE_KEY, "db", "tbl", F.explode(
        F.when(one, F.array(first)).otherwise(F.array(first, last))).alias("end")).select(
        *TABLE_KEY, "end.*", "db", "tbl")


def merged_runs(runs: DataFrame) -> DataFrame:
    """Runs that may repeat or touch each other as one set of runs; see ``torn`` for others."""
    return _joined(_ends(runs).drop("is_last"), TABLE_KEY)


def torn(runs: DataFrame) -> DataFrame:
    """The ``epoch, table_id`` that have a run with a mapping of another name inside it.

    Where in the run the old name came back is then no longer known: their mappings have to be
    read again.
    """
    name = F.struct("db", "tbl")
    order = W.partitionBy(*TABLE_KEY).orderBy(*position_columns()[1:], "db", "tbl")
    before = F.lag(name).over(order)
    return (_ends(runs).withColumn("other", F.col("is_last") & ~before.eqNullSafe(name))
            .where("other").select(*TABLE_KEY).distinct())


def _in_force(runs: DataFrame) -> DataFrame:
    """Each run with the positions from which and up to which it is in force."""
    place = _place("filename", "offset")
    order = W.partitionBy(*TABLE_KEY).orderBy(place)
    return runs.select(*TABLE_KEY, place.alias("from_place"),
                       F.lead(place).over(order).alias("to_place"), "db", "tbl")


def names_at(rows: DataFrame, runs: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
             runs_per_table: int = FILE_MAPPINGS) -> DataFrame:
    """``rows`` with the ``db, tbl`` in force at their positions, null where there is none.

    Few runs are one broadcast join, which leaves the rows where they are and reads them once.
    With more runs, the rows are written first and joined by the files they are in.
    """
    sizes = runs.groupBy(*TABLE_KEY).count().agg(
        F.sum("count").alias("all"), F.max("count").alias("most")).first()
    if (sizes["all"] or 0) > broadcast_rows or (sizes["most"] or 0) > runs_per_table:
        rows = stored(rows, "rows")
        starts = runs.select(*MAPPING, "offset", "db", "tbl")
        none = F.lit(None).cast("string")
        return table_at(rows, starts).unionByName(
            orphans(rows, starts).select("*", none.alias("db"), none.alias("tbl")))
    left, right = rows.alias("l"), F.broadcast(_in_force(runs)).alias("r")
    at = F.struct(F.length("l.filename").alias("length"), F.col("l.filename").alias("filename"),
                  F.col("l.offset").alias("offset"))
    holds = ((F.col("l.epoch") == F.col("r.epoch"))
             & (F.col("l.table_id") == F.col("r.table_id"))
             & (at >= F.col("r.from_place"))
             & (F.col("r.to_place").isNull() | (at < F.col("r.to_place"))))
    return left.join(right, holds, "left").select("l.*", "r.db", "r.tbl")
