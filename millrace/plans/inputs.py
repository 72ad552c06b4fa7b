"""Source tables, change logs and catalogs made from the given tables.

Each is written twice, as a DataFrame and as a SQL common table expression, side
by side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType)

from ..connect import log_schema
from ..model import TableSpec
from ..operators.deltas import backfill_deltas
from ..operators.slices import previous_in_key
from ..session import new_folder
from ..sources.log import TABLE_MAP, read_log

ACCOUNT = TableSpec("shop", "account", StructType([
    StructField("k", LongType()),
    StructField("v", DoubleType()),
    StructField("s", StringType()),
]), ("k",))
ACCOUNT_TEXT = "shop.account, Cols: [k - INT(8), v - FLOAT(8), s - STRING(10)], PK: [k]"
EPOCH = 0
EVENTS_PER_FILE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream, be it one file or a folder of files."""
    as_pattern = f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(as_pattern)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def flat(df: DataFrame) -> DataFrame:
    """Struct columns spread out as ``struct_field``."""
    columns: list[Column] = []
    for field in df.schema:
        if isinstance(field.dataType, StructType):
            columns += [F.col(field.name)[f].alias(f"{field.name}_{f}")
                        for f in field.dataType.fieldNames()]
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


# --- the change log: one delta per event, three at each position ---------------

CHANGELOG_SQL = f"""changelog AS (
  SELECT 'shop' AS db, 'account' AS tbl,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         user_id AS k,
         CASE WHEN event_type <> 'signup' THEN lag(user_id) OVER user_log END AS before_k,
         CASE WHEN event_type <> 'signup' THEN lag(value) OVER user_log END AS before_v,
         CASE WHEN event_type <> 'signup' THEN lag(event_type) OVER user_log END AS before_s,
         CASE WHEN event_type <> 'error' THEN user_id END AS after_k,
         CASE WHEN event_type <> 'error' THEN value END AS after_v,
         CASE WHEN event_type <> 'error' THEN event_type END AS after_s,
         CAST({EPOCH} AS INTEGER) AS epoch,
         printf('bin.%06d', event_id // {EVENTS_PER_FILE} + 1) AS filename,
         4 + 100 * ((event_id % {EVENTS_PER_FILE}) // 3) AS "offset",
         CAST((event_id % {EVENTS_PER_FILE}) % 3 AS INTEGER) AS seq,
         event_id, event_type
  FROM events WINDOW user_log AS (PARTITION BY user_id ORDER BY event_id))"""
DELTA = 'db, tbl, op, k, after_k, after_v, after_s, epoch, filename, "offset", seq'
DELTA_WITH_BEFORE = ('db, tbl, op, k, before_k, before_v, before_s, after_k, after_v, after_s, '
                     'epoch, filename, "offset", seq')


def _image(kind: str) -> Column:
    return F.struct(F.col("user_id").alias("k"), F.col("value").alias("v"),
                    F.col(kind).alias("s"))


def _file_name(number: Column) -> Column:
    digits = number.cast("string")
    return F.concat(F.lit("bin."), F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), "0"))


def event_deltas(events: DataFrame, *extra: str | Column) -> DataFrame:
    """Events, at rest or streaming, as deltas without a ``before``."""
    kind = F.col("event_type")
    in_file = F.expr(f"event_id % {EVENTS_PER_FILE}")
    return events.select(
        F.lit(ACCOUNT.db).alias("db"),
        F.lit(ACCOUNT.name).alias("tbl"),
        F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("op"),
        F.col("user_id").alias("k"),
        F.when(kind != "error", _image("event_type")).alias("after"),
        F.lit(EPOCH).alias("epoch"),
        _file_name(F.expr(f"event_id div {EVENTS_PER_FILE} + 1")).alias("filename"),
        F.expr(f"4 + 100 * ((event_id % {EVENTS_PER_FILE}) div 3)").alias("offset"),
        (in_file % 3).cast("int").alias("seq"),
        *extra,
    )


def changelog(spark: SparkSession, sf_dir: str, *extra: str | Column) -> DataFrame:
    return event_deltas(table(spark, sf_dir, "events"), *extra)


# Written logs, once per application and input, as a landed log would be there.
_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    """The folder with what ``build`` gives, written on first use."""
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _landed:
        path = new_folder(spark, name)
        build().write.parquet(path)
        _landed[place] = path
    return _landed[place]


def _with_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    linked = previous_in_key(events.withColumn("image", _image("event_type")), ["user_id"],
                             ["event_id"], "image")
    before = F.when(F.col("event_type") != "signup", F.col("previous.value")).alias("before")
    columns = log_schema(ACCOUNT).fieldNames()
    return event_deltas(linked, before, "event_type").select(*columns, "event_type")


def full_log_folder(spark: SparkSession, sf_dir: str) -> str:
    return landed(spark, sf_dir, "full-log", lambda: _with_before(spark, sf_dir))


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log with both images, and the event type it came from."""
    schema = StructType([*log_schema(ACCOUNT), StructField("event_type", StringType())])
    return read_log(spark, full_log_folder(spark, sf_dir), schema)


# --- the backfill: the account rows are the customers --------------------------

BACKFILL_SQL = f"""backfill AS (
  SELECT 'shop' AS db, 'account' AS tbl, 'I' AS op, c_custkey AS k,
         c_custkey AS after_k, c_acctbal AS after_v, c_mktsegment AS after_s,
         CAST({EPOCH} AS INTEGER) AS epoch, '' AS filename, CAST(0 AS BIGINT) AS "offset",
         CAST(0 AS INTEGER) AS seq
  FROM customer)"""


def account_rows(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"),
                            F.col("c_mktsegment").alias("s"))


def customer_deltas(customers: DataFrame) -> DataFrame:
    return backfill_deltas(account_rows(customers), ACCOUNT, EPOCH)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_deltas(table(spark, sf_dir, "customer"))


ALL_DELTAS_SQL = (CHANGELOG_SQL, BACKFILL_SQL,
                  f"deltas AS (SELECT {DELTA} FROM backfill "
                  f"UNION ALL SELECT {DELTA} FROM changelog)")
LATEST_SQL = (*ALL_DELTAS_SQL, """latest AS (
  SELECT k, op, after_k, after_v, after_s, epoch, filename, "offset", seq FROM deltas
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY epoch DESC, filename DESC, "offset" DESC,
                             seq DESC) = 1)""")
CURRENT_STATE_SQL = with_(*LATEST_SQL) + (
    "SELECT after_k AS k, after_v AS v, after_s AS s FROM latest WHERE op <> 'D'")


def all_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill and log together, without ``before``."""
    return backfill(spark, sf_dir).drop("before").unionByName(changelog(spark, sf_dir))


def delivered_twice(log: DataFrame) -> DataFrame:
    """The log as a reader sees it that starts over from the beginning once."""
    return log.unionByName(log)


# --- a log of two tables, whose ids are bound anew in every file ----------------

TABLE_MAP_SQL = f"""files AS (
  SELECT DISTINCT event_id // {EVENTS_PER_FILE} + 1 AS file_number FROM events),
table_map AS (
  SELECT CAST({EPOCH} AS INTEGER) AS epoch, printf('bin.%06d', file_number) AS filename,
         CAST(0 AS BIGINT) AS "offset", table_id, 'shop' AS db,
         CASE WHEN (file_number + table_id) % 2 = 0 THEN 'account' ELSE 'session' END AS tbl
  FROM files, (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) AS ids(table_id))"""
MULTI_LOG_SQL = """multi_log AS (
  SELECT op, k, after_v, after_s, epoch, filename, "offset", seq,
         CASE WHEN event_id % 500 = 499 THEN 99 ELSE k % 2 + 1 END AS table_id
  FROM changelog)"""


def table_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = table_map_folder(spark, sf_dir)
    return read_log(spark, folder, TABLE_MAP)


def table_map_folder(spark: SparkSession, sf_dir: str) -> str:
    return landed(spark, sf_dir, "table-map", lambda: _table_map(spark, sf_dir))


def _table_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "events").select(
        F.expr(f"event_id div {EVENTS_PER_FILE} + 1").alias("file_number")).distinct()
    ids = files.withColumn("table_id", F.explode(F.array(
        F.lit(1).cast("long"), F.lit(2).cast("long"))))
    even = (F.col("file_number") + F.col("table_id")) % 2 == 0
    return ids.select(
        F.lit(EPOCH).alias("epoch"),
        _file_name(F.col("file_number")).alias("filename"),
        F.lit(0).cast("long").alias("offset"),
        "table_id",
        F.lit("shop").alias("db"),
        F.when(even, "account").otherwise("session").alias("tbl"),
    )


def multi_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_id = F.expr("CASE WHEN event_id % 500 = 499 THEN 99 ELSE user_id % 2 + 1 END")
    return changelog(spark, sf_dir, table_id.alias("table_id")).select(
        "op", "k", F.col("after.v").alias("after_v"), F.col("after.s").alias("after_s"), "epoch",
        "filename", "offset", "seq", "table_id")


# --- the same log as raw events, with faults --------------------------------------

# Cheap clicks come without the last column's value, dear ones a value short, and
# those between with a key that is no number.
RAW_SQL = f"""raw_changes AS (
  SELECT CAST({EPOCH} AS INTEGER) AS epoch,
         printf('bin.%06d', event_id // {EVENTS_PER_FILE} + 1) AS filename,
         4 + 100 * (event_id % {EVENTS_PER_FILE}) AS "offset",
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         CASE WHEN event_id % 500 = 499 THEN 99 ELSE user_id % 2 + 1 END AS table_id,
         user_id AS k, value AS v, event_type AS s,
         CASE WHEN event_type <> 'click' THEN NULL WHEN value < 5 THEN 'partial row image'
              WHEN value > 30 THEN 'wrong number of values'
              WHEN value BETWEEN 10 AND 15 THEN 'value not of its type' END AS reason
  FROM events WHERE event_type <> 'view')"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    click = kind == "click"
    name = (F.when(kind == "signup", "EXT_WRITE_ROWS").when(kind == "error", "EXT_DELETE_ROWS")
            .when(kind == "view", "QUERY").otherwise("EXT_UPDATE_ROWS"))
    key = F.when(click & value.between(10, 15), "?").otherwise(F.col("user_id").cast("string"))
    whole = F.array(*[F.encode(v, "UTF-8") for v in (key, value.cast("string"), kind)])
    values = F.when(click & (value > 30), F.slice(whole, 1, 2)).otherwise(whole)
    yes = F.lit(True)
    included = F.when(click & (value < 5), F.array(yes, yes, F.lit(False))).otherwise(
        F.array(yes, yes, yes))
    row = F.struct(F.when(kind != "signup", values).alias("before"),
                   F.when(kind != "error", values).alias("after"))
    return table(spark, sf_dir, "events").select(
        F.lit(EPOCH).alias("epoch"),
        _file_name(F.expr(f"event_id div {EVENTS_PER_FILE} + 1")).alias("filename"),
        F.expr(f"4 + 100 * (event_id % {EVENTS_PER_FILE})").alias("offset"),
        name.alias("event_type"),
        F.expr("CASE WHEN event_id % 500 = 499 THEN 99 ELSE user_id % 2 + 1 END").alias(
            "table_id"),
        F.when(kind != "signup", included).alias("included_before"),
        F.when(kind != "error", included).alias("included"),
        F.array(row).alias("rows"),
    )


# --- a catalog: one source table per part, its name in two databases ---------------------------------------

CATALOG_SQL = """cat_tables AS (
  SELECT lower(replace(p_brand, '#', '_')) || CASE p_partkey % 2 WHEN 1 THEN '_b' ELSE '' END
           AS db, 't' || p_partkey // 2 AS tbl,
         CASE WHEN p_type = 'SMALL' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
         p_partkey, p_size, p_type
  FROM part),
cat_columns AS (
  SELECT db, tbl, p_size, 'c' || ordinal AS column_name, CAST(ordinal AS INTEGER) AS ordinal,
         CASE WHEN p_size = 13 AND ordinal = 2 THEN 'DATETIME'
              ELSE ['TINYINT', 'SMALLINT', 'MEDIUMINT', 'INT', 'BIGINT', 'VARCHAR'][
                   CAST((p_partkey + ordinal) % 6 AS INTEGER) + 1] END AS sql_type,
         p_size * 5 AS size
  FROM cat_tables, unnest(range(1, 3 + p_size % 5)) AS u(ordinal)),
cat_indexes AS (
  SELECT db, tbl, 'PRIMARY' AS index_name, CAST(1 AS INTEGER) AS seq,
         CASE WHEN p_size = 17 THEN 'ghost' WHEN p_type = 'ECONOMY' THEN 'c2' ELSE 'c1' END
           AS column_name
  FROM cat_tables WHERE p_type <> 'PROMO'
  UNION ALL
  SELECT db, tbl, 'PRIMARY', 2, 'c1' FROM cat_tables WHERE p_type = 'ECONOMY'
  UNION ALL
  SELECT db, tbl, 'by_c2', 1, 'c2' FROM cat_tables),
typed AS (
  SELECT *,
         CASE WHEN sql_type IN ('TINYINT', 'SMALLINT', 'MEDIUMINT', 'INT', 'BIGINT') THEN 'INT'
              WHEN sql_type = 'VARCHAR' THEN 'STRING' END AS engine_type,
         CAST(CASE sql_type WHEN 'TINYINT' THEN 1 WHEN 'SMALLINT' THEN 1 WHEN 'MEDIUMINT' THEN 1
              WHEN 'INT' THEN 4 WHEN 'BIGINT' THEN 8 WHEN 'VARCHAR' THEN size END AS INTEGER)
           AS length,
         CASE sql_type WHEN 'TINYINT' THEN 'tinyint' WHEN 'SMALLINT' THEN 'smallint'
              WHEN 'MEDIUMINT' THEN 'int' WHEN 'INT' THEN 'int' WHEN 'BIGINT' THEN 'bigint'
              WHEN 'VARCHAR' THEN 'string' END AS spark_type
  FROM cat_columns),
sink_wanted AS (
  SELECT db, tbl, column_name, ordinal, p_size, sql_type,
         CASE engine_type WHEN 'INT' THEN 'INTEGER' ELSE 'STRING' END AS sink_type
  FROM typed WHERE engine_type IS NOT NULL),
sink_columns AS (
  SELECT db, tbl, column_name,
         CASE WHEN sql_type = 'SMALLINT' THEN 'STRING' ELSE sink_type END AS sink_type
  FROM sink_wanted WHERE p_size <= 40 AND sql_type <> 'TINYINT'
  UNION ALL
  SELECT db, tbl, 'loaded_at', 'FLOAT' FROM cat_tables WHERE p_size <= 40)"""


def _catalog_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))),
                 F.when(F.col("p_partkey") % 2 == 1, "_b").otherwise("")).alias("db"),
        F.concat(F.lit("t"), F.expr("p_partkey div 2").cast("string")).alias("tbl"),
        F.when(F.col("p_type") == "SMALL", "VIEW").otherwise("BASE TABLE").alias("table_type"),
        "p_partkey", "p_size", "p_type")


def cat_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_parts(spark, sf_dir).select("db", "tbl", "table_type", "p_size")


def cat_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("TINYINT", "SMALLINT", "MEDIUMINT", "INT", "BIGINT",
                                         "VARCHAR")])
    kind = F.element_at(kinds, ((F.col("p_partkey") + F.col("ordinal")) % 6 + 1).cast("int"))
    unsupported = (F.col("p_size") == 13) & (F.col("ordinal") == 2)
    return (
        _catalog_parts(spark, sf_dir)
        .withColumn("ordinal", F.explode(F.sequence(F.lit(1), 2 + F.col("p_size") % 5)))
        .select("db", "tbl", F.concat(F.lit("c"), F.col("ordinal").cast("string")).alias(
            "column_name"), "ordinal",
            F.when(unsupported, "DATETIME").otherwise(kind).alias("sql_type"),
            (F.col("p_size") * 5).alias("size"), "p_size")
    )


def cat_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    economy = F.col("p_type") == "ECONOMY"
    first = (F.when(F.col("p_size") == 17, "ghost").when(economy, "c2").otherwise("c1"))

    def entry(name: str, seq: int, column: Column) -> Column:
        return F.struct(F.lit(name).alias("index_name"), F.lit(seq).alias("seq"),
                        column.alias("column_name"))

    entries = F.array_compact(F.array(
        F.when(F.col("p_type") != "PROMO", entry("PRIMARY", 1, first)),
        F.when(economy, entry("PRIMARY", 2, F.lit("c1"))),
        entry("by_c2", 1, F.lit("c2")),
    ))
    return (_catalog_parts(spark, sf_dir).select("db", "tbl", F.explode(entries).alias("e"))
            .select("db", "tbl", "e.*"))


def sink_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that has drifted: tables and columns missing, extra, and retyped."""
    # The sink's own record of types: everything but text is an integer.
    kind = F.col("sql_type")
    sink_kind = F.when(kind.isin("VARCHAR", "SMALLINT"), "STRING").otherwise("INTEGER")
    present = F.col("p_size") <= 40
    kept = cat_columns(spark, sf_dir).where(present & ~kind.isin("TINYINT", "DATETIME")).select(
        "db", "tbl", "column_name", sink_kind.alias("sink_type"))
    extra = cat_tables(spark, sf_dir).where(present).select(
        "db", "tbl", F.lit("loaded_at").alias("column_name"), F.lit("FLOAT").alias("sink_type"))
    return kept.unionByName(extra)
