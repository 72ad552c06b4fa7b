"""Current state, tombstones, histories, and the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..connect import StateSink, run
from ..operators import merge as g
from ..session import new_folder
from ..sinks.state import StateTable
from ..sinks.tables import append_rows, catalog_columns, create_table, read_appended
from . import inputs as i
from .registry import query

KEY = list(i.ACCOUNT.key)


@query("latest_delta", i.with_(*i.LATEST_SQL) + "SELECT * FROM latest")
def latest_delta(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(g.latest_delta(i.all_deltas(spark, sf), KEY))


@query("current_state", i.CURRENT_STATE_SQL)
def current_state(spark: SparkSession, sf: str) -> DataFrame:
    return g.current_state(i.all_deltas(spark, sf), KEY)


@query("tombstones", i.with_(*i.LATEST_SQL)
       + """SELECT k, epoch, filename, "offset", seq FROM latest WHERE op = 'D'""")
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    latest = g.latest_delta(i.all_deltas(spark, sf), KEY)
    return g.tombstones(latest).select(*KEY, "epoch", "filename", "offset", "seq")


def new_state(spark: SparkSession) -> StateTable:
    return StateTable(spark, new_folder(spark, "state"), i.ACCOUNT)


@query("merge_batches", i.CURRENT_STATE_SQL)
def merge_batches(spark: SparkSession, sf: str) -> DataFrame:
    # One batch per event type, so their positions interleave; the backfill, which has
    # the lowest positions, comes last.
    state = new_state(spark)
    log = i.changelog(spark, sf, "event_type")
    for batch, kind in enumerate(("view", "error", "signup", "click", "purchase")):
        state.apply(log.where(F.col("event_type") == kind), batch)
        if kind == "signup":
            state.compact()
    state.apply(i.backfill(spark, sf), 5, reduce=False)
    return state.rows()


MOVED = 1_000_000


@query("split_key_updates", i.with_(i.CHANGELOG_SQL) + f""", moves AS (
  SELECT *, op = 'U' AND before_k IS NOT NULL AND event_type = 'purchase' AS moved FROM changelog)
SELECT k, op, before_k, before_v, before_s,
       CASE WHEN event_type = 'purchase' THEN after_k + {MOVED} ELSE after_k END AS after_k,
       after_v, after_s, epoch, filename, "offset", seq * 2 AS seq FROM moves WHERE NOT moved
UNION ALL
SELECT before_k, 'D', before_k, before_v, before_s, NULL, NULL, NULL, epoch, filename, "offset",
       seq * 2 FROM moves WHERE moved
UNION ALL
SELECT after_k + {MOVED}, 'I', NULL, NULL, NULL, after_k + {MOVED}, after_v, after_s, epoch,
       filename, "offset", seq * 2 + 1 FROM moves WHERE moved""")
def split_key_updates(spark: SparkSession, sf: str) -> DataFrame:
    # A purchase moves the account to another key.
    moved = F.col("after").withField("k", F.col("after.k") + MOVED)
    after = F.when(F.col("event_type") == "purchase", moved).otherwise(F.col("after"))
    log = i.full_log(spark, sf).withColumn("after", after).drop("event_type", "db", "tbl")
    return i.flat(g.split_key_updates(log, KEY))


@query("changed_columns", i.with_(i.CHANGELOG_SQL) + """, both_images AS (
  SELECT * FROM changelog WHERE before_k IS NOT NULL AND after_k IS NOT NULL),
changes AS (
  SELECT k, op, epoch, filename, "offset", seq, 'k' AS column_name,
         CAST(before_k AS VARCHAR) AS old_value, CAST(after_k AS VARCHAR) AS new_value
  FROM both_images
  UNION ALL
  SELECT k, op, epoch, filename, "offset", seq, 'v', CAST(before_v AS VARCHAR),
         CAST(after_v AS VARCHAR) FROM both_images
  UNION ALL
  SELECT k, op, epoch, filename, "offset", seq, 's', before_s, after_s FROM both_images)
SELECT * FROM changes WHERE old_value IS DISTINCT FROM new_value""")
def changed_columns(spark: SparkSession, sf: str) -> DataFrame:
    log = i.full_log(spark, sf).drop("event_type", "db", "tbl")
    return g.changed_columns(log, i.ACCOUNT.schema.fieldNames())


@query("image_breaks", i.with_(i.CHANGELOG_SQL) + """, linked AS (
  SELECT *, lag(k) OVER account AS previous_k, lag(after_k) OVER account AS expected_k,
         lag(after_v) OVER account AS expected_v, lag(after_s) OVER account AS expected_s
  FROM changelog WINDOW account AS (PARTITION BY k ORDER BY epoch, filename, "offset", seq))
SELECT k, op, before_k, before_v, before_s, expected_k, expected_v, expected_s, epoch, filename,
       "offset", seq FROM linked
WHERE previous_k IS NOT NULL AND (before_k IS DISTINCT FROM expected_k OR
  before_v IS DISTINCT FROM expected_v OR before_s IS DISTINCT FROM expected_s)""")
def image_breaks(spark: SparkSession, sf: str) -> DataFrame:
    log = i.full_log(spark, sf).drop("event_type", "db", "tbl")
    return i.flat(g.image_breaks(log, KEY).drop("after"))


# --- sinks ----------------------------------------------------------------------

APPENDED_SQL = i.with_(*i.ALL_DELTAS_SQL) + (
    "SELECT after_k AS k, after_v AS v, after_s AS s FROM deltas WHERE op <> 'D'")


@query("sink_append", APPENDED_SQL)
def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "appended")
    append_rows(i.backfill(spark, sf), path, -1)
    append_rows(i.changelog(spark, sf), path, 0)
    return read_appended(spark, path, i.ACCOUNT.schema)


CATALOG_TABLES = ("customer", "orders", "part")


@query("sink_catalog", """SELECT 'customer' AS tbl, u.column_name, CAST(u.ordinal AS INTEGER)
  AS ordinal, u.spark_type, (SELECT count(*) FROM customer) AS "rows"
FROM (VALUES ('c_custkey', 1, 'bigint'), ('c_name', 2, 'string'), ('c_nationkey', 3, 'int'),
  ('c_acctbal', 4, 'double'), ('c_mktsegment', 5, 'string')) AS u(column_name, ordinal, spark_type)
UNION ALL
SELECT 'orders', u.*, (SELECT count(*) FROM orders)
FROM (VALUES ('o_orderkey', 1, 'bigint'), ('o_custkey', 2, 'bigint'),
  ('o_orderstatus', 3, 'string'), ('o_totalprice', 4, 'double'),
  ('o_orderdate', 5, 'timestamp_ntz'), ('o_orderpriority', 6, 'string')) AS u
UNION ALL
SELECT 'part', u.*, (SELECT count(*) FROM part)
FROM (VALUES ('p_partkey', 1, 'bigint'), ('p_name', 2, 'string'), ('p_brand', 3, 'string'),
  ('p_type', 4, 'string'), ('p_size', 5, 'int'), ('p_retailprice', 6, 'double')) AS u""")
def sink_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The sink's tables after loading three source tables, with their row counts."""
    root = new_folder(spark, "warehouse")
    database = "sink_" + root[-32:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    sizes = []
    for name in CATALOG_TABLES:
        rows, path = i.table(spark, sf, name), f"{root}/tables/{name}"
        create_table(spark, database, name, rows.schema, path)
        rows.write.mode("append").parquet(path)
        sizes.append(spark.read.schema(rows.schema).parquet(path).agg(F.count("*").alias("rows"))
                     .select(F.lit(name).alias("tbl"), "rows"))
    columns = catalog_columns(spark, database)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return columns.join(sizes[0].unionByName(sizes[1]).unionByName(sizes[2]), "tbl")


@query("connected_run", i.CURRENT_STATE_SQL)
def connected_run(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.landed(spark, sf, "account-rows",
                    lambda: i.account_rows(i.table(spark, sf, "customer")))
    folder = new_folder(spark, "connected")
    sinks = run(spark, {
        "importers": {"shop": {
            "type": "lake", "database": i.ACCOUNT.db, "epoch": i.EPOCH, "tables": {
                i.ACCOUNT.name: {"rows": rows, "log": i.full_log_folder(spark, sf), "key": KEY}},
        }},
        "exporters": {
            "current": {"type": "state", "warehouse": folder, "dataset_id": "current"},
            "history": {"type": "append", "warehouse": folder, "dataset_id": "history"},
        },
        "connections": {
            "shop_to_current": {"in": "shop", "out": "current"},
            "shop_to_history": {"in": "shop", "out": "history"},
        },
    }, f"{folder}/checkpoints")
    return sinks["current"].state(i.ACCOUNT).rows()


@query("connected_fan_in", "SELECT c_custkey AS k, 'now' AS sink FROM customer "
       "UNION ALL SELECT c_custkey, 'all' FROM customer")
def connected_fan_in(spark: SparkSession, sf: str) -> DataFrame:
    """One table that two sources hold a part of each, in a state and an appending sink."""
    folder = new_folder(spark, "fan-in")
    rows = i.account_rows(i.table(spark, sf, "customer"))
    importers = {}
    for part in (0, 1):
        path = f"{folder}/rows-{part}"
        rows.where(F.pmod("k", F.lit(2)) == part).write.parquet(path)
        importers[f"shop_{part}"] = {"type": "lake", "database": i.ACCOUNT.db, "epoch": i.EPOCH,
                                     "tables": {i.ACCOUNT.name: {"rows": path, "key": KEY}}}
    sinks = run(spark, {
        "importers": importers,
        "exporters": {
            "now": {"type": "state", "warehouse": folder, "dataset_id": "now"},
            "all": {"type": "append", "warehouse": folder, "dataset_id": "all"},
        },
        "connections": {f"{source}_{sink}": {"in": source, "out": sink}
                        for source in importers for sink in ("now", "all")},
    }, f"{folder}/checkpoints")
    now = sinks["now"].state(i.ACCOUNT).rows().select("k", F.lit("now").alias("sink"))
    appended = read_appended(spark, sinks["all"].path(i.ACCOUNT), i.ACCOUNT.schema)
    return now.unionByName(appended.select("k", F.lit("all").alias("sink")))


@query("reload_epoch", """SELECT sink, c_custkey AS k, 2 * c_acctbal AS v, c_mktsegment AS s
FROM customer, (VALUES ('plain'), ('compacted')) AS sinks(sink) WHERE c_custkey % 5 <> 0""")
def reload_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """A source read anew with rows changed, added and removed, into two kinds of state."""
    folder = new_folder(spark, "reload")
    rows = i.account_rows(i.table(spark, sf, "customer"))
    versions = (rows.where("k % 3 <> 0"),
                rows.where("k % 5 <> 0").withColumn("v", 2 * F.col("v")))
    exporters = {name: {"type": "state", "warehouse": folder, "dataset_id": name,
                        "compact_every": every}
                 for name, every in (("plain", None), ("compacted", 1))}
    for epoch, version in enumerate(versions):
        path = f"{folder}/rows-{epoch}"
        version.write.parquet(path)
        sinks = run(spark, {
            "importers": {"shop": {"type": "lake", "database": i.ACCOUNT.db, "epoch": epoch,
                                   "tables": {i.ACCOUNT.name: {"rows": path, "key": KEY}}}},
            "exporters": exporters,
            "connections": {name: {"in": "shop", "out": name} for name in exporters},
        }, f"{folder}/checkpoints")
    states = [sinks[name].state(i.ACCOUNT).rows().select(F.lit(name).alias("sink"), "*")
              for name in exporters]
    return states[0].unionByName(states[1])


# Late rows of epoch 0 behind the reload: accounts 0, 1 and 2 of five update, are new, and go.
# Of epoch 1's log, every seventh account is updated.
LATE_EPOCH_SQL = """SELECT sink, c_custkey AS k,
  CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE 2 * c_acctbal END AS v, c_mktsegment AS s
FROM customer, (VALUES ('plain'), ('compacted'), ('compacted later')) AS sinks(sink)
WHERE c_custkey % 5 <> 0"""


def _late_epoch_log(rows: DataFrame) -> DataFrame:
    """Log rows in the columns of a landed log: old ones of epoch 0 and a few of epoch 1."""
    late = F.pmod("k", F.lit(5))
    op = F.when(late == 0, "U").when(late == 1, "I").when(late == 2, "D")
    image = F.struct("k", "v", "s")
    none = F.lit(None).cast(i.ACCOUNT.schema)

    def log(kind: Column, after: Column, epoch: int) -> DataFrame:
        return rows.select(
            F.lit(i.ACCOUNT.db).alias("db"), F.lit(i.ACCOUNT.name).alias("tbl"),
            kind.alias("op"), "k", F.when(kind != "I", image).alias("before"),
            F.when(kind != "D", after).otherwise(none).alias("after"),
            F.lit(epoch).alias("epoch"), F.lit("bin.000009").alias("filename"),
            (4 + F.col("k")).alias("offset"), F.lit(0).alias("seq")).where(kind.isNotNull())

    newer = F.when((F.pmod("k", F.lit(7)) == 0) & (late != 0), "U")
    return log(op, image, 0).unionByName(
        log(newer, F.struct("k", (F.col("v") + 1).alias("v"), "s"), 1))


@query("reload_epoch_late", LATE_EPOCH_SQL)
def reload_epoch_late(spark: SparkSession, sf: str) -> DataFrame:
    """A reload in a new epoch, and then log rows of the old epoch that land behind it.

    They would update accounts that are gone, bring in others and delete some that are there.
    """
    folder = new_folder(spark, "reload-late")
    rows = i.account_rows(i.table(spark, sf, "customer"))
    versions = (rows, rows.where("k % 5 <> 0").withColumn("v", 2 * F.col("v")))
    exporters = {name: {"type": "state", "warehouse": folder, "dataset_id": name.replace(" ", "_"), "compact_every": every}
                 for name, every in (("plain", None), ("compacted", 1),
                                     ("compacted later", None))}
    log = _late_epoch_log(rows)
    log.limit(0).write.parquet(f"{folder}/log")

    def load(epoch: int) -> dict:
        return run(spark, {
            "importers": {"shop": {"type": "lake", "database": i.ACCOUNT.db, "epoch": epoch,
                                   "tables": {i.ACCOUNT.name: {
                                       "rows": f"{folder}/rows-{epoch}",
                                       "log": f"{folder}/log", "key": KEY}}}},
            "exporters": exporters,
            "connections": {name: {"in": "shop", "out": name} for name in exporters},
        }, f"{folder}/checkpoints")

    for epoch, version in enumerate(versions):
        version.write.parquet(f"{folder}/rows-{epoch}")
        load(epoch)
    log.write.mode("append").parquet(f"{folder}/log")
    sinks = load(1)
    sinks["compacted later"].state(i.ACCOUNT).compact()
    states = [sinks[name].state(i.ACCOUNT).rows().select(F.lit(name).alias("sink"), "*")
              for name in exporters]
    return states[0].unionByName(states[1]).unionByName(states[2])


RAW_RUN_SQL = i.with_(i.RAW_SQL, i.TABLE_MAP_SQL, i.BACKFILL_SQL) + """, ours AS (
  SELECT r.* FROM raw_changes r JOIN table_map m USING (epoch, filename, table_id)
  WHERE m.tbl = 'account')
"""


def _raw_run(spark: SparkSession, sf: str) -> tuple[StateSink, str]:
    """A run over the backfill and the raw log, and the folder of what it rejected."""
    folder = new_folder(spark, "raw-run")
    rows = i.landed(spark, sf, "account-rows",
                    lambda: i.account_rows(i.table(spark, sf, "customer")))
    events = i.landed(spark, sf, "raw-events", lambda: i.raw_events(spark, sf))
    sinks = run(spark, {
        "importers": {"shop": {
            "type": "raw", "database": i.ACCOUNT.db, "epoch": i.EPOCH, "events": events,
            "table_map": i.table_map_folder(spark, sf), "rejected": f"{folder}/rejected",
            "tables": {i.ACCOUNT.name: {"rows": rows, "key": KEY}}}},
        "exporters": {"now": {"type": "state", "warehouse": folder, "dataset_id": "now"}},
        "connections": {"shop_to_now": {"in": "shop", "out": "now"}},
    }, f"{folder}/checkpoints")
    return sinks["now"], f"{folder}/rejected"


@query("raw_connected_run", RAW_RUN_SQL + """SELECT k, v, s FROM (
  SELECT * FROM (
    SELECT 'I' AS op, after_k AS k, after_v AS v, after_s AS s, epoch, filename, "offset"
    FROM backfill
    UNION ALL SELECT op, k, v, s, epoch, filename, "offset" FROM ours WHERE reason IS NULL)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY epoch DESC, filename DESC,
                             "offset" DESC) = 1)
WHERE op <> 'D'""")
def raw_connected_run(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_run(spark, sf)[0].state(i.ACCOUNT).rows()


@query("raw_connected_rejected", RAW_RUN_SQL + """
SELECT op, epoch, filename, "offset", reason FROM ours WHERE reason IS NOT NULL
UNION ALL SELECT op, epoch, filename, "offset", 'no table mapped' FROM raw_changes
WHERE table_id = 99""")
def raw_connected_rejected(spark: SparkSession, sf: str) -> DataFrame:
    rejected = spark.read.parquet(f"{_raw_run(spark, sf)[1]}/rows")
    return rejected.select("op", "epoch", "filename", "offset", "reason")
