"""Joining log rows with table mappings, and catalogs with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.position import position_columns, position_order
from ..model import POSITION
from ..session import BROADCAST_BYTES, BROADCAST_ROWS, has_at_most, is_small, stored
from .slices import latest_in_key, previous_in_key

# Mappings of one table in one file that a broadcast join may look through.
FILE_MAPPINGS = 64


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
                broadcast_rows: int = BROADCAST_ROWS,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a large, possibly skewed table with a lookup table of unique keys.

    A lookup of at most ``broadcast_rows`` rows and ``broadcast_bytes`` bytes is broadcast. A
    larger one is joined by shuffles, where adaptive execution splits the tasks that a hot
    key makes large. That holds for joins that keep no unmatched lookup rows; others
    are refused, whatever the size.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join cannot be {how}")
    if is_small(lookup, broadcast_rows, broadcast_bytes):
        lookup = F.broadcast(lookup)
    return rows.join(lookup, list(on), how)


MAPPING = ("epoch", "filename", "table_id")


def with_table(log: DataFrame, table_map: DataFrame, **limits) -> DataFrame:
    """Row events with the ``db, tbl`` their file maps the table id to.

    ``table_map`` has one mapping per file and table id.
    """
    names = table_map.select(*MAPPING, "db", "tbl")
    return lookup_join(log, names, MAPPING, **limits)


def orphans(log: DataFrame, table_map: DataFrame, **limits) -> DataFrame:
    """Row events whose table id is not mapped at or before their position."""
    first = table_map.groupBy("epoch", "table_id").agg(F.min(position_order()).alias("_first"))
    found = lookup_join(log, first, ["epoch", "table_id"], "left", **limits)
    unmapped = F.col("_first").isNull() | (position_order() < F.col("_first"))
    return found.where(unmapped).select(*log.columns)


def _changes(table_map: DataFrame, few: bool) -> DataFrame:
    """The mappings without those that repeat the one before them in their file."""
    name = F.struct("db", "tbl")
    if few:
        in_file = W.partitionBy(*MAPPING).orderBy("offset")
        linked = table_map.withColumn("_last", F.lag(name).over(in_file))
    else:
        named = table_map.withColumn("_name", name)
        linked = previous_in_key(named, MAPPING, ["offset"], "_name").withColumn(
            "_last", F.col("previous.value"))
    return linked.where(~name.eqNullSafe(F.col("_last"))).select(
        *MAPPING, "offset", "db", "tbl")


def _table_at_by_order(log: DataFrame, table_map: DataFrame) -> DataFrame:
    """The mapping in force by one sort of mappings and log rows together."""
    at = [c for c in POSITION if c != "epoch"]
    rows = log.select("epoch", "table_id", *at, F.struct(*log.columns).alias("row"),
                      F.lit(None).cast("struct<db:string,tbl:string>").alias("name"))
    mappings = table_map.select("epoch", "table_id", *at,
                                F.lit(None).cast(rows.schema["row"].dataType).alias("row"),
                                F.struct("db", "tbl").alias("name"))
    # At one position the mapping comes first.
    order = [*position_columns(), F.col("row").isNotNull()]
    found = latest_in_key(rows.unionByName(mappings), ["epoch", "table_id"], order, "name",
                          "mapped")
    return (found.where(F.col("row").isNotNull() & F.col("mapped").isNotNull())
            .select("row.*", "mapped.db", "mapped.tbl"))


def _in_files(changes: DataFrame, files: DataFrame) -> DataFrame:
    """For every file and table id, the ranges of offsets and the ``db, tbl`` in force there.

    A file takes over the last mapping of the files before it. One row per file and table
    id, and one per change.
    """
    ids = changes.select("epoch", "table_id").distinct()
    starts = files.join(F.broadcast(ids), "epoch").select(
        *MAPPING, F.lit(-1).cast("long").alias("offset"), F.lit(None).cast("string").alias("db"),
        F.lit(None).cast("string").alias("tbl"))
    points = starts.unionByName(changes.select(*MAPPING, "offset", "db", "tbl"))
    upto = W.partitionBy("epoch", "table_id").orderBy(F.length("filename"), "filename", "offset")
    name = F.last(F.when(F.col("tbl").isNotNull(), F.struct("db", "tbl")), ignorenulls=True)
    in_file = W.partitionBy(*MAPPING).orderBy("offset")
    return points.select(
        *MAPPING, F.col("offset").alias("from_offset"),
        F.lead("offset").over(in_file).alias("to_offset"), name.over(upto).alias("name"),
    ).where("name is not null").select(
        *MAPPING, "from_offset", "to_offset", "name.db", "name.tbl")


def table_at(log: DataFrame, table_map: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
             file_mappings: int = FILE_MAPPINGS) -> DataFrame:
    """Row events with the ``db, tbl`` in force at their position (as-of join).

    Table ids are mapped anew, so the latest mapping of the epoch at or before
    the row counts. The mapping that each file begins with is worked out from the file
    names, which are read first, so that one broadcast join leaves the log in place. With more
    files, table ids or mappings than the limits, log and mappings are sorted together. Row
    events without any earlier mapping are left out; see ``orphans``.
    """
    changes = stored(_changes(table_map, has_at_most(table_map, broadcast_rows)), "mappings")
    files = stored(log.select("epoch", "filename").distinct(), "files")
    per_file = changes.groupBy(*MAPPING).count().agg(F.max("count")).first()[0] or 0
    ids = changes.groupBy("epoch").agg(F.countDistinct("table_id").alias("ids"))
    starts = files.join(ids, "epoch").agg(F.sum("ids")).first()[0] or 0
    if starts + changes.count() > broadcast_rows or per_file > file_mappings:
        return _table_at_by_order(log, changes)
    left, right = log.alias("l"), F.broadcast(_in_files(changes, files)).alias("r")
    holds = (F.col("l.offset") >= F.col("r.from_offset")) & (
        F.col("r.to_offset").isNull() | (F.col("l.offset") < F.col("r.to_offset")))
    for c in MAPPING:
        holds = (F.col(f"l.{c}") == F.col(f"r.{c}")) & holds
    return left.join(right, holds).select("l.*", "r.db", "r.tbl")


TABLE = ["db", "tbl"]


def missing_tables(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Source tables the sink has not."""
    return source.join(sink.select(*TABLE).distinct(), TABLE, "left_anti")


def existing_tables(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Source tables the sink has, to be checked for drift."""
    return source.join(sink.select(*TABLE).distinct(), TABLE, "left_semi")


def connections(importers: DataFrame, exporters: DataFrame, links: DataFrame) -> DataFrame:
    """Each connection with the types of its two ends; both must be known."""
    sources = importers.select(F.col("name").alias("source"), F.col("type").alias("source_type"))
    sinks = exporters.select(F.col("name").alias("sink"), F.col("type").alias("sink_type"))
    both = lookup_join(lookup_join(links, sources, ["source"]), sinks, ["sink"])
    return both.select("name", "source", "source_type", "sink", "sink_type")
