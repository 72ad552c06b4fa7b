"""Primary-key ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import splits as s
from . import inputs as i
from .registry import query

ORDER_KEY, ORDER_BATCH = ["o_orderkey"], 1000
CONVERSATION_KEY, CONVERSATION_BATCH = ["conv_id", "turn"], 100

ORDERS_SQL = f"""indexed AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders),
assigned AS (
  SELECT o_orderkey, row_index, row_index // {ORDER_BATCH} AS split_id FROM indexed),
points AS (
  SELECT split_id, o_orderkey FROM assigned
  WHERE row_index > 0 AND row_index % {ORDER_BATCH} = 0),
ids AS (SELECT unnest(range(0, (SELECT count(*) + 1 FROM points))) AS split_id),
ranges AS (
  SELECT ids.split_id, lo.o_orderkey AS lo_o_orderkey, hi.o_orderkey AS hi_o_orderkey
  FROM ids LEFT JOIN points lo ON lo.split_id = ids.split_id
           LEFT JOIN points hi ON hi.split_id = ids.split_id + 1)"""


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return s.split_assignment(i.table(spark, sf, "orders"), ORDER_KEY, ORDER_BATCH)


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return s.split_points(_assigned(spark, sf), ORDER_KEY, ORDER_BATCH)


@query("split_points", i.with_(ORDERS_SQL) + "SELECT split_id, o_orderkey FROM points")
def split_points(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf)


@query("split_points_composite", f"""WITH indexed AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS n FROM conversations)
SELECT n // {CONVERSATION_BATCH} AS split_id, conv_id, turn FROM indexed
WHERE n > 0 AND n % {CONVERSATION_BATCH} = 0""")
def split_points_composite(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.table(spark, sf, "conversations")
    assigned = s.split_assignment(rows, CONVERSATION_KEY, CONVERSATION_BATCH)
    return s.split_points(assigned, CONVERSATION_KEY, CONVERSATION_BATCH)


@query("split_ranges", i.with_(ORDERS_SQL) + "SELECT * FROM ranges")
def split_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(s.split_ranges(_points(spark, sf), ORDER_KEY))


@query("split_kinds", i.with_(ORDERS_SQL) + """SELECT split_id,
  CASE WHEN lo_o_orderkey IS NULL AND hi_o_orderkey IS NULL THEN 'all'
       WHEN lo_o_orderkey IS NULL THEN 'initial' WHEN hi_o_orderkey IS NULL THEN 'final'
       ELSE 'middle' END AS kind FROM ranges""")
def split_kinds(spark: SparkSession, sf: str) -> DataFrame:
    ranges = s.split_ranges(_points(spark, sf), ORDER_KEY)
    return ranges.select("split_id", s.split_kind(F.col("lo"), F.col("hi")).alias("kind"))


@query("split_assign", i.with_(ORDERS_SQL) + "SELECT o_orderkey, split_id FROM assigned")
def split_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select("o_orderkey", "split_id")


@query("split_counts", i.with_(ORDERS_SQL) + """SELECT split_id, count(*) AS "rows",
  min(o_orderkey) AS first_o_orderkey, max(o_orderkey) AS last_o_orderkey
FROM assigned GROUP BY split_id""")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(s.split_counts(_assigned(spark, sf), ORDER_KEY))


@query("split_progress", i.with_(ORDERS_SQL) + """, audited AS (
  SELECT split_id, count(*) AS planned,
         count(*) FILTER (WHERE o_orderkey < (SELECT max(o_orderkey) // 2 FROM orders)) AS loaded
  FROM assigned GROUP BY split_id)
SELECT split_id, planned, loaded, CASE WHEN loaded = 0 THEN 'NOT_STARTED'
  WHEN loaded < planned THEN 'RUNNING' ELSE 'DONE' END AS state FROM audited""")
def split_progress(spark: SparkSession, sf: str) -> DataFrame:
    # A load that stopped halfway through the keys.
    orders = i.table(spark, sf, "orders")
    reached = orders.agg(F.max("o_orderkey")).first()[0] // 2
    loaded = orders.where(F.col("o_orderkey") < reached)
    return s.split_progress(_assigned(spark, sf), loaded, ORDER_KEY)
