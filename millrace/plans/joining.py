"""Table mappings, catalogs against each other, unions and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import deltas as d
from ..operators import lookups as lk
from ..operators import metrics as m
from ..sources.catalog import base_tables, sink_columns_for
from ..sources.log import (SchemaHistory, row_changes, table_changes, typed_by_history,
                           unmapped_changes)
from . import inputs as i
from .registry import query

LOG_SQL = (i.CHANGELOG_SQL, i.MULTI_LOG_SQL, i.TABLE_MAP_SQL)
NAMED = 'db, tbl, op, k, epoch, filename, "offset", seq, table_id'.split(", ")


def _named(df: DataFrame) -> DataFrame:
    return df.select(*[c.strip('"') for c in NAMED])


# Every file maps its table ids once, so the mapping in force is the file's own.
NAMED_SQL = i.with_(*LOG_SQL) + f"""SELECT {', '.join(NAMED)} FROM multi_log
JOIN (SELECT epoch, filename, table_id, db, tbl FROM table_map) USING (epoch, filename, table_id)"""


@query("join_table_map", NAMED_SQL)
def join_table_map(spark: SparkSession, sf: str) -> DataFrame:
    return _named(lk.with_table(i.multi_log(spark, sf), i.table_map(spark, sf)))


@query("asof_table_map", i.with_(*LOG_SQL) + """, ranges AS (
  SELECT *, lead((filename, "offset")) OVER (PARTITION BY epoch, table_id
                                             ORDER BY filename, "offset") AS until
  FROM table_map)
SELECT r.db, r.tbl, g.op, g.k, g.epoch, g.filename, g."offset", g.seq, g.table_id
FROM multi_log g JOIN ranges r ON g.epoch = r.epoch AND g.table_id = r.table_id
 AND (g.filename, g."offset") >= (r.filename, r."offset")
 AND (r.until IS NULL OR (g.filename, g."offset") < r.until)""")
def asof_table_map(spark: SparkSession, sf: str) -> DataFrame:
    return _named(lk.table_at(i.multi_log(spark, sf), i.table_map(spark, sf)))


@query("orphan_events", i.with_(*LOG_SQL) + """SELECT k, epoch, filename, "offset", seq, table_id
FROM multi_log g WHERE NOT EXISTS (
  SELECT 1 FROM table_map t WHERE t.epoch = g.epoch AND t.table_id = g.table_id
  AND (t.filename, t."offset") <= (g.filename, g."offset"))""")
def orphan_events(spark: SparkSession, sf: str) -> DataFrame:
    lost = lk.orphans(i.multi_log(spark, sf), i.table_map(spark, sf))
    return lost.select("k", "epoch", "filename", "offset", "seq", "table_id")


ACCOUNT_CHANGES_SQL = i.with_(i.RAW_SQL, i.TABLE_MAP_SQL) + """, ours AS (
  SELECT r.* FROM raw_changes r JOIN table_map m USING (epoch, filename, table_id)
  WHERE m.tbl = 'account')
"""


def _account_changes(spark: SparkSession, sf: str) -> DataFrame:
    changes = row_changes(i.raw_events(spark, sf))
    return table_changes(changes, i.table_map(spark, sf), i.ACCOUNT)


@query("raw_log_deltas", ACCOUNT_CHANGES_SQL + """
SELECT 'shop' AS db, 'account' AS tbl, op, k, CASE WHEN op <> 'I' THEN k END AS before_k,
       CASE WHEN op <> 'I' THEN v END AS before_v, CASE WHEN op <> 'I' THEN s END AS before_s,
       CASE WHEN op <> 'D' THEN k END AS after_k, CASE WHEN op <> 'D' THEN v END AS after_v,
       CASE WHEN op <> 'D' THEN s END AS after_s, epoch, filename, "offset",
       CAST(0 AS INTEGER) AS seq
FROM ours WHERE reason IS NULL""")
def raw_log_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(_account_changes(spark, sf).where(F.col("reason").isNull()).drop("reason"))


@query("raw_log_rejected", ACCOUNT_CHANGES_SQL
       + """SELECT op, epoch, filename, "offset", reason FROM ours WHERE reason IS NOT NULL""")
def raw_log_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return _account_changes(spark, sf).where(F.col("reason").isNotNull()).select(
        "op", "epoch", "filename", "offset", "reason")


@query("schema_at", i.with_(i.RAW_SQL, i.TABLE_MAP_SQL) + f""", middle AS (
  SELECT printf('bin.%06d', max(event_id) // 2 // {i.EVENTS_PER_FILE} + 1) AS name FROM events),
ours AS (SELECT r.*, r.filename < name AS early, CASE WHEN r.filename >= name
    OR r.reason = 'value not of its type' THEN r.reason END AS fault
  FROM raw_changes r JOIN table_map m USING (epoch, filename, table_id), middle
  WHERE m.tbl = 'account')
SELECT op, CASE WHEN fault IS NULL THEN k END AS k,
       CASE WHEN fault IS NULL AND op <> 'D' THEN v END AS v,
       CASE WHEN fault IS NULL AND op <> 'D' AND NOT early THEN s END AS s, epoch, filename,
       "offset", fault AS reason
FROM ours""")
def schema_at(spark: SparkSession, sf: str) -> DataFrame:
    """Row changes of a table that got its third column in the middle of the log."""
    last = i.table(spark, sf, "events").agg(F.max("event_id")).first()[0] or 0
    since = (i.EPOCH, f"bin.{last // 2 // i.EVENTS_PER_FILE + 1:06d}", 0)
    two = StructType(list(i.ACCOUNT.schema)[:2])
    early = F.col("filename") < since[1]

    def cut(values: Column) -> Column:
        return F.when(early, F.slice(values, 1, 2)).otherwise(values)

    events = i.raw_events(spark, sf)
    for name in ("included_before", "included"):
        events = events.withColumn(name, cut(F.col(name)))
    events = events.withColumn("rows", F.transform("rows", lambda row: F.struct(
        cut(row["before"]).alias("before"), cut(row["after"]).alias("after"))))
    mapped = lk.table_at(row_changes(events), i.table_map(spark, sf))
    found = typed_by_history(mapped, SchemaHistory(i.ACCOUNT, ((two, since),)))
    good = F.col("reason").isNull()
    values = {"k": F.col("k"), "v": F.col("after.v"), "s": F.col("after.s")}
    return found.select("op", *[F.when(good, c).alias(name) for name, c in values.items()],
                        "epoch", "filename", "offset", "reason")


@query("raw_log_unmapped", i.with_(i.RAW_SQL)
       + """SELECT op, epoch, filename, "offset", table_id FROM raw_changes WHERE table_id = 99""")
def raw_log_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    changes = row_changes(i.raw_events(spark, sf))
    return unmapped_changes(changes, i.table_map(spark, sf)).select(
        "op", "epoch", "filename", "offset", "table_id")


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return base_tables(i.cat_tables(spark, sf)), i.sink_columns(spark, sf)


BASE_SQL = "SELECT db, tbl FROM cat_tables WHERE table_type = 'BASE TABLE' AND (db, tbl) "


@query("missing_tables", i.with_(i.CATALOG_SQL) + BASE_SQL
       + "NOT IN (SELECT db, tbl FROM sink_columns)")
def missing_tables(spark: SparkSession, sf: str) -> DataFrame:
    return lk.missing_tables(*_sides(spark, sf)).select("db", "tbl")


@query("existing_tables", i.with_(i.CATALOG_SQL) + BASE_SQL
       + "IN (SELECT db, tbl FROM sink_columns)")
def existing_tables(spark: SparkSession, sf: str) -> DataFrame:
    return lk.existing_tables(*_sides(spark, sf)).select("db", "tbl")


@query("create_sink_schema", i.with_(i.CATALOG_SQL) + """
SELECT db, tbl, column_name, ordinal, sink_type,
       'Automatically created for table ' || db || '.' || tbl AS comment
FROM sink_wanted JOIN cat_tables USING (db, tbl)
WHERE table_type = 'BASE TABLE' AND (db, tbl) NOT IN (SELECT db, tbl FROM sink_columns)""")
def create_sink_schema(spark: SparkSession, sf: str) -> DataFrame:
    new = lk.missing_tables(*_sides(spark, sf))
    wanted = sink_columns_for(i.cat_columns(spark, sf))
    return wanted.join(new, ["db", "tbl"], "left_semi")


@query("connections", """SELECT 'link_' || s_suppkey AS name, 'source_' || s_suppkey AS source,
  'mysql' AS source_type, 'sink_' || n_nationkey AS sink,
  CASE WHEN n_regionkey = 0 THEN 'append' ELSE 'state' END AS sink_type
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def connections(spark: SparkSession, sf: str) -> DataFrame:
    # One source per supplier, one sink per nation, connected by the supplier's nation.
    def name(prefix: str, key: str):
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    suppliers, nations = i.table(spark, sf, "supplier"), i.table(spark, sf, "nation")
    importers = suppliers.select(name("source_", "s_suppkey").alias("name"),
                                 F.lit("mysql").alias("type"))
    kind = F.when(F.col("n_regionkey") == 0, "append").otherwise("state")
    exporters = nations.select(name("sink_", "n_nationkey").alias("name"), kind.alias("type"))
    links = suppliers.select(name("link_", "s_suppkey").alias("name"),
                             name("source_", "s_suppkey").alias("source"),
                             name("sink_", "s_nationkey").alias("sink"))
    return lk.connections(importers, exporters, links)


@query("union_phases", i.with_(*i.ALL_DELTAS_SQL) + f"SELECT {i.DELTA} FROM deltas")
def union_phases(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(i.all_deltas(spark, sf))


@query("fan_in", i.with_(i.CHANGELOG_SQL, i.BACKFILL_SQL)
       + f"SELECT {i.DELTA}, 'full' AS source FROM backfill "
       + f"UNION ALL SELECT {i.DELTA}, 'log' FROM changelog")
def fan_in(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(d.fan_in({"full": i.backfill(spark, sf).drop("before"),
                            "log": i.changelog(spark, sf)}))


@query("dedup_deliveries", i.with_(*i.ALL_DELTAS_SQL) + f"SELECT {i.DELTA} FROM deltas")
def dedup_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill and log, delivered twice."""
    return i.flat(d.without_repeats(i.delivered_twice(i.all_deltas(spark, sf)), i.ACCOUNT.key))


@query("count_by_phase", i.with_(*i.ALL_DELTAS_SQL) + """SELECT db, tbl,
  CASE WHEN "offset" = 0 THEN 'backfill' ELSE 'iterative' END AS phase, count(*) AS count
FROM deltas GROUP BY ALL""")
def count_by_phase(spark: SparkSession, sf: str) -> DataFrame:
    return m.count_by_phase(i.all_deltas(spark, sf))


BATCH = 1000


@query("batch_hits", i.with_(*i.ALL_DELTAS_SQL) + f""", counts AS (
  SELECT db || '.' || tbl || '-' || CASE WHEN "offset" = 0 THEN 'backfill' ELSE 'iterative' END
         AS counter, count(*) AS n FROM deltas GROUP BY ALL)
SELECT counter, (n - 1) // {BATCH} AS hits, (n - 1) % {BATCH} + 1 AS value FROM counts""")
def batch_hits(spark: SparkSession, sf: str) -> DataFrame:
    return m.batch_hits(m.count_by_phase(i.all_deltas(spark, sf)), BATCH)


@query("count_by_op", i.with_(*i.ALL_DELTAS_SQL) + """SELECT db, tbl,
  count(*) FILTER (WHERE op = 'I') AS inserts, count(*) FILTER (WHERE op = 'U') AS updates,
  count(*) FILTER (WHERE op = 'D') AS deletes FROM deltas GROUP BY db, tbl""")
def count_by_op(spark: SparkSession, sf: str) -> DataFrame:
    return m.count_by_op(i.all_deltas(spark, sf))


@query("high_water", i.with_(*i.ALL_DELTAS_SQL) + """
SELECT db, tbl, epoch, filename, "offset", seq FROM deltas QUALIFY row_number() OVER (
  PARTITION BY db, tbl ORDER BY epoch DESC, filename DESC, "offset" DESC, seq DESC) = 1""")
def high_water(spark: SparkSession, sf: str) -> DataFrame:
    return m.high_water(i.all_deltas(spark, sf))
