"""Scans and sources; key comparison and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import tuple_ge, tuple_lt
from ..functions.position import after_position
from ..operators import deltas as d
from ..operators.selection import keys_at
from ..operators.splits import nth_key, scan_split, split_assignment, split_points
from ..sources.catalog import base_tables, primary_keys, table_schemas, typed_columns
from . import inputs as i
from .registry import query


@query("src_tables", i.with_(i.CATALOG_SQL)
       + "SELECT db, tbl FROM cat_tables WHERE table_type = 'BASE TABLE'")
def src_tables(spark: SparkSession, sf: str) -> DataFrame:
    return base_tables(i.cat_tables(spark, sf))


@query("src_columns", i.with_(i.CATALOG_SQL)
       + "SELECT db, tbl, column_name, ordinal, engine_type, length, spark_type FROM typed")
def src_columns(spark: SparkSession, sf: str) -> DataFrame:
    return typed_columns(i.cat_columns(spark, sf)).drop("sql_type", "supported")


KEYS_SQL = """key_parts AS (
  SELECT x.db, x.tbl, x.seq, x.column_name, c.ordinal - 1 AS place
  FROM cat_indexes x LEFT JOIN cat_columns c USING (db, tbl, column_name)
  WHERE x.index_name = 'PRIMARY'),
keys AS (
  SELECT db, tbl, string_agg(column_name, ', ' ORDER BY seq) AS key,
         string_agg(coalesce(CAST(place AS VARCHAR), 'null'), ', ' ORDER BY seq) AS places,
         bool_and(place IS NOT NULL) AS known
  FROM key_parts GROUP BY db, tbl)"""


@query("src_primary_key", i.with_(i.CATALOG_SQL, KEYS_SQL) + "SELECT * FROM keys")
def src_primary_key(spark: SparkSession, sf: str) -> DataFrame:
    keys = primary_keys(i.cat_columns(spark, sf), i.cat_indexes(spark, sf))
    places = F.transform("places", lambda p: F.coalesce(p.cast("string"), F.lit("null")))
    return keys.select("db", "tbl", F.array_join("key", ", ").alias("key"),
                       F.array_join(places, ", ").alias("places"), "known")


@query("schema_text", i.with_(i.CATALOG_SQL, KEYS_SQL, """described AS (
  SELECT db, tbl,
         string_agg(column_name || ' - ' || engine_type || '(' || length || ')', ', '
                    ORDER BY ordinal) AS cols,
         min(CASE WHEN engine_type IS NULL THEN sql_type END) AS bad_type
  FROM typed GROUP BY db, tbl),
checked AS (
  SELECT t.db, t.tbl, cols, key,
         CASE WHEN bad_type IS NOT NULL THEN 'unrecognized type ' || bad_type
              WHEN NOT known THEN 'unknown primary key column' END AS error
  FROM cat_tables t JOIN described USING (db, tbl) LEFT JOIN keys USING (db, tbl)
  WHERE table_type = 'BASE TABLE')""") + """
SELECT db, tbl, error, CASE WHEN error IS NULL THEN
       db || '.' || tbl || ', Cols: [' || cols || '], PK: [' || coalesce(key, '') || ']'
       END AS schema_text FROM checked""")
def schema_text(spark: SparkSession, sf: str) -> DataFrame:
    return table_schemas(i.cat_tables(spark, sf), i.cat_columns(spark, sf),
                         i.cat_indexes(spark, sf))


@query("scan_all", "SELECT * FROM orders")
def scan_all(spark: SparkSession, sf: str) -> DataFrame:
    return scan_split(i.table(spark, sf, "orders"), ["o_orderkey"])


# The three kinds of bounded scan together read the table: it is cut in thirds.
CONVERSATION_KEY = ["conv_id", "turn"]
THIRDS_SQL = """indexed AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_index,
         CAST(ceil(count(*) OVER () / 3.0) AS BIGINT) AS third
  FROM conversations),
lo AS (SELECT conv_id AS lo_conv, turn AS lo_turn FROM indexed WHERE row_index = third),
hi AS (SELECT conv_id AS hi_conv, turn AS hi_turn FROM indexed WHERE row_index = 2 * third)"""


def _thirds(spark: SparkSession, sf: str) -> tuple[DataFrame, list[tuple]]:
    rows = i.table(spark, sf, "conversations")
    third = -(-rows.count() // 3)
    assigned = split_assignment(rows, CONVERSATION_KEY, third)
    points = split_points(assigned, CONVERSATION_KEY, third).orderBy("split_id").collect()
    return rows, [(p.conv_id, p.turn) for p in points]


@query("scan_initial", i.with_(THIRDS_SQL) + """SELECT conversations.* FROM conversations, hi, lo
WHERE (conv_id, turn) < (lo_conv, lo_turn)""")
def scan_initial(spark: SparkSession, sf: str) -> DataFrame:
    rows, (lo, _) = _thirds(spark, sf)
    return scan_split(rows, CONVERSATION_KEY, hi=lo)


@query("scan_middle", i.with_(THIRDS_SQL) + """SELECT conversations.* FROM conversations, hi, lo
WHERE (conv_id, turn) >= (lo_conv, lo_turn) AND (conv_id, turn) < (hi_conv, hi_turn)""")
def scan_middle(spark: SparkSession, sf: str) -> DataFrame:
    rows, (lo, hi) = _thirds(spark, sf)
    return scan_split(rows, CONVERSATION_KEY, lo, hi)


@query("scan_final", i.with_(THIRDS_SQL) + """SELECT conversations.* FROM conversations, hi
WHERE (conv_id, turn) >= (hi_conv, hi_turn)""")
def scan_final(spark: SparkSession, sf: str) -> DataFrame:
    rows, (_, hi) = _thirds(spark, sf)
    return scan_split(rows, CONVERSATION_KEY, lo=hi)


MIDDLE_SQL = """indexed AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_index,
         count(*) OVER () // 2 AS middle
  FROM conversations),
bound AS (SELECT conv_id AS b_conv, turn AS b_turn FROM indexed WHERE row_index = middle)"""


@query("tuple_compare", i.with_(MIDDLE_SQL) + """
SELECT conv_id, turn, (conv_id, turn) < (b_conv, b_turn) AS below,
       (conv_id, turn) >= (b_conv, b_turn) AS not_below FROM conversations, bound""")
def tuple_compare(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.table(spark, sf, "conversations")
    bound = tuple(nth_key(rows, CONVERSATION_KEY, rows.count() // 2).first())
    return rows.select(*CONVERSATION_KEY, tuple_lt(CONVERSATION_KEY, bound).alias("below"),
                       tuple_ge(CONVERSATION_KEY, bound).alias("not_below"))


@query("nth_key", """SELECT o_orderkey FROM orders ORDER BY o_orderkey
LIMIT 1 OFFSET (SELECT count(*) // 2 FROM orders)""")
def nth_key_(spark: SparkSession, sf: str) -> DataFrame:
    orders = i.table(spark, sf, "orders")
    return nth_key(orders, ["o_orderkey"], orders.count() // 2)


@query("nth_keys", """WITH placed AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS place,
         count(*) OVER () AS n FROM conversations)
SELECT place, conv_id, turn FROM placed WHERE place IN (0, n // 4, n // 2, 3 * n // 4, n - 1)""")
def nth_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The keys at the quarters of a table, and the first and the last one."""
    rows = i.table(spark, sf, "conversations")
    n = rows.count()
    return keys_at(rows, CONVERSATION_KEY, [0, n // 4, n // 2, 3 * n // 4, n - 1])


@query("project_columns",
       "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    customers = i.table(spark, sf, "customer")
    return customers.select(*customers.schema.fieldNames())


@query("project_key", "SELECT conv_id AS key_conv_id, turn AS key_turn FROM conversations")
def project_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.table(spark, sf, "conversations")
    return i.flat(rows.select(F.struct(*CONVERSATION_KEY).alias("key")))


@query("database_filter", i.with_(i.CATALOG_SQL)
       + "SELECT db, tbl, table_type FROM cat_tables WHERE db = 'brand_7'")
def database_filter(spark: SparkSession, sf: str) -> DataFrame:
    return d.of_database(i.cat_tables(spark, sf), "brand_7").select("db", "tbl", "table_type")


@query("backfill_inserts", i.with_(i.BACKFILL_SQL) + f"""
SELECT {i.DELTA}, CAST(NULL AS BIGINT) AS before_k, CAST(NULL AS DOUBLE) AS before_v,
       CAST(NULL AS VARCHAR) AS before_s FROM backfill""")
def backfill_inserts(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(i.backfill(spark, sf))


def _log_sql(op: str) -> str:
    return i.with_(i.CHANGELOG_SQL) + (
        f"SELECT {i.DELTA_WITH_BEFORE} FROM changelog WHERE op = '{op}'")


@query("log_inserts", _log_sql("I"))
def log_inserts(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(d.inserts(i.full_log(spark, sf).drop("event_type")))


@query("log_updates", _log_sql("U"))
def log_updates(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(d.updates(i.full_log(spark, sf).drop("event_type")))


@query("log_deletes", _log_sql("D"))
def log_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(d.deletes(i.full_log(spark, sf).drop("event_type")))


@query("unpack_rows", """SELECT event_id, CAST(0 AS INTEGER) AS seq, user_id AS k, value AS v
FROM events UNION ALL SELECT event_id, 1, user_id + 1000000, value FROM events""")
def unpack_rows(spark: SparkSession, sf: str) -> DataFrame:
    def row(k):
        return F.struct(k.alias("k"), F.col("value").alias("v"))

    k = F.col("user_id")
    packed = i.table(spark, sf, "events").select(
        "event_id", F.array(row(k), row(k + 1000000)).alias("rows"))
    return d.unpack_rows(packed).select("event_id", "seq", "row.*")


@query("log_table_map", i.with_(i.TABLE_MAP_SQL)
       + 'SELECT epoch, filename, "offset", table_id, db, tbl FROM table_map')
def log_table_map(spark: SparkSession, sf: str) -> DataFrame:
    return i.table_map(spark, sf)


@query("log_from_position", i.with_(i.CHANGELOG_SQL) + f"""SELECT {i.DELTA} FROM changelog
WHERE (epoch, filename, "offset") > (0, 'bin.000003', 1004)""")
def log_from_position(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(i.changelog(spark, sf).where(after_position(0, "bin.000003", 1004)))


@query("log_known_events", """SELECT event_id, CASE event_type WHEN 'signup' THEN 'I'
       WHEN 'error' THEN 'D' ELSE 'U' END AS op
FROM events WHERE event_type IN ('signup', 'error', 'purchase')""")
def log_known_events(spark: SparkSession, sf: str) -> DataFrame:
    # Clicks and views stand for events that carry no rows.
    kind = F.col("event_type")
    name = (F.when(kind == "signup", "EXT_WRITE_ROWS").when(kind == "error", "EXT_DELETE_ROWS")
            .when(kind == "purchase", "EXT_UPDATE_ROWS").when(kind == "view", d.TABLE_MAP_EVENT)
            .otherwise("QUERY"))
    events = i.table(spark, sf, "events").select("event_id", name.alias("event_type"))
    return d.row_events(events).select("event_id", "op")


@query("generate_rows", """SELECT (o_orderkey * 1103515245 + 12345) % 2147483648 AS id,
       'Hello ' || o_orderkey AS comment, (o_orderkey * 69069 + 1) % 2147483648 AS user_id
FROM orders""")
def generate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return d.generated_rows(i.table(spark, sf, "orders"), "o_orderkey")
