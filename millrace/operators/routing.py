"""Raw log events to the tables they are for, in one pass over the events.

Every row gets a ``route``: the number of its table, or one of those below 0. What a table's
rows must look like is data, a lookup table of the tables' widths and types, so the pass is as
wide for a thousand tables as for one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import read_text
from ..model import TableSpec
from .checks import has_width, is_full_image
from .deltas import TABLE_MAP_EVENT, operation
from .lookups import lookup_join

# Routes of rows that no table gets: those that cannot be loaded, and events that are neither
# row changes nor mappings.
REJECTED, OTHER = -1, -2

ROUTED = """table_id bigint, op string, epoch int, filename string, offset bigint, seq int,
event_type string, before array<binary>, after array<binary>, db string, tbl string,
reason string, route int"""


def event_rows(events: DataFrame) -> DataFrame:
    """One row per row change of the raw events, and one for each event of another kind.

    Mappings are left out, and so are changes without rows.
    """
    kind = F.col("event_type")
    op = operation(kind)
    return (events.where(~kind.eqNullSafe(F.lit(TABLE_MAP_EVENT))).withColumn("op", op)
            .select("*", F.posexplode_outer(F.when(F.col("op").isNotNull(), F.col("rows")))
                    .alias("seq", "row"))
            .where("op IS NULL OR seq IS NOT NULL")
            .select("table_id", "op", "epoch", "filename", "offset", "seq", "event_type",
                    "row.before", "row.after", "included_before", "included"))


def route_table(spark: SparkSession, tables: Sequence[TableSpec]) -> DataFrame:
    """``db, tbl, number, types`` of the tables in their order."""
    return spark.createDataFrame(
        [(t.db, t.name, n, [f.dataType.simpleString() for f in t.schema])
         for n, t in enumerate(tables)],
        "db string, tbl string, number int, types array<string>")


def _holds(value: Column, kind: Column, kinds: Sequence[str]) -> Column:
    """Whether a log value, as bytes, is one of its column's type; NULL is of any."""
    text, found = read_text(value), F.lit(False)
    for name in kinds:
        found = F.when(kind == name, text.try_cast(name).isNotNull()).otherwise(found)
    return value.isNull() | found


def _reason(kinds: Sequence[str]) -> Column:
    """Why a row of a known table cannot be loaded, null if it can."""
    types = F.col("types")
    width = F.size(types)

    def sides(check) -> Column:
        passes = [F.col(values).isNull() | check(F.col(values), F.col(included))
                  for values, included in (("before", "included_before"), ("after", "included"))]
        return F.coalesce(passes[0] & passes[1], F.lit(False))

    def readable(values: Column, _: Column) -> Column:
        return F.forall(F.zip_with(values, types, lambda v, t: _holds(v, t, kinds)), lambda ok: ok)

    return (F.when(~sides(lambda _, included: is_full_image(included, width)),
                   "partial row image")
            .when(~sides(lambda values, _: has_width(values, width)), "wrong number of values")
            .when(~sides(readable), "value not of its type"))


def routed(rows: DataFrame, tables: Sequence[TableSpec]) -> DataFrame:
    """``event_rows`` with their ``db, tbl``, each with its ``reason`` and ``route``.

    A row that has a reason goes to ``REJECTED``. Rows of tables that are not among ``tables``
    are left out; a table without a mapping is a reason.
    """
    kinds = sorted({f.dataType.simpleString() for t in tables for f in t.schema})
    lookup = route_table(rows.sparkSession, tables)
    known = lookup_join(rows, lookup, ["db", "tbl"], "left")
    reason = (F.when(F.col("op").isNull(), F.lit(None))
              .when(F.col("tbl").isNull(), "no table mapped")
              .when(F.col("number").isNotNull(), _reason(kinds)))
    route = (F.when(F.col("op").isNull(), OTHER).when(F.col("reason").isNotNull(), REJECTED)
             .otherwise(F.col("number")))
    return (known.withColumn("reason", reason).withColumn("route", route)
            .where("route IS NOT NULL")
            .select("table_id", "op", "epoch", "filename", "offset", "seq", "event_type",
                    "before", "after", "db", "tbl", "reason", "route"))


def write_routed(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``routed`` rows once, in a folder for each route; returns them as read from there.

    The rows are dealt out by route, and a table with very many rows to several tasks, so
    there are few files and no hot one.
    """
    rows.hint("rebalance", "route").write.partitionBy("route").parquet(folder)
    return rows.sparkSession.read.schema(ROUTED).parquet(folder)


def routes_of(written: DataFrame) -> set[int]:
    """The routes that have rows, told from the folders."""
    return {int(file.rpartition("/route=")[2].partition("/")[0]) for file in written.inputFiles()}
