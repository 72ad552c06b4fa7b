"""Column functions on rows and positions, row and schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import position as p
from ..functions import text as t
from ..functions import types as ty
from ..model import POSITION
from ..operators import checks as c
from ..operators import deltas as d
from ..operators.slices import rank_in_key
from ..sinks.tables import delta_lines
from ..sources.catalog import sink_columns_for, typed_columns
from . import inputs as i
from .registry import query

def _position() -> list[Column]:
    return [F.col(c) for c in POSITION]


HEX_SQL = ("""lower(printf('%08x', epoch) || hex(filename) || printf('%016x', "offset"))""")


@query("position_encode", i.with_(*i.ALL_DELTAS_SQL)
       + f'SELECT k, seq, {HEX_SQL} AS position FROM deltas')
def position_encode(spark: SparkSession, sf: str) -> DataFrame:
    return i.all_deltas(spark, sf).select(
        "k", "seq", F.lower(F.hex(p.encode_position(*_position()))).alias("position"))


@query("position_decode", i.with_(*i.ALL_DELTAS_SQL) + f"""
SELECT k, seq, CASE WHEN op = 'D' THEN left({HEX_SQL}, 22) ELSE {HEX_SQL} END AS position,
       CASE WHEN op <> 'D' THEN epoch END AS epoch,
       CASE WHEN op <> 'D' THEN filename END AS filename,
       CASE WHEN op <> 'D' THEN "offset" END AS "offset" FROM deltas""")
def position_decode(spark: SparkSession, sf: str) -> DataFrame:
    # The positions of deletes are cut short, so that they cannot be decoded.
    whole = p.encode_position(*_position())
    position = F.when(F.col("op") == "D", F.substring(whole, 1, 11)).otherwise(whole)
    return i.all_deltas(spark, sf).select("k", "seq", position.alias("position")).select(
        "k", "seq", F.lower(F.hex("position")).alias("position"),
        p.decode_position(F.col("position")).alias("at")).select("k", "seq", "position", "at.*")


@query("position_text", i.with_(*i.ALL_DELTAS_SQL) + """SELECT k, seq,
  'MySqlStreamPosition: (' || epoch || ':' || filename || ':' || "offset" || ')' AS position
FROM deltas""")
def position_text(spark: SparkSession, sf: str) -> DataFrame:
    return i.all_deltas(spark, sf).select(
        "k", "seq", p.position_text(*_position()).alias("position"))


@query("position_rank", i.with_(*i.ALL_DELTAS_SQL) + """
SELECT k, epoch, filename, "offset", seq, row_number() OVER (
  PARTITION BY k ORDER BY epoch, filename, "offset", seq) AS rank FROM deltas""")
def position_rank(spark: SparkSession, sf: str) -> DataFrame:
    at = i.all_deltas(spark, sf).select("k", "epoch", "filename", "offset", "seq")
    return rank_in_key(at, ["k"], p.delta_columns())


CUSTOMER_VALUES = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers; the BUILDING segment stands for NULL."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    return i.table(spark, sf, "customer").select(*CUSTOMER_VALUES[:-1], segment)


SEGMENT_SQL = "nullif(c_mktsegment, 'BUILDING')"


@query("mk_string", f"""SELECT c_custkey, c_custkey || ',' || c_name || ',' || c_acctbal || ',' ||
  coalesce({SEGMENT_SQL}, 'null') AS joined FROM customer""")
def mk_string(spark: SparkSession, sf: str) -> DataFrame:
    values = F.array(*[F.col(v).cast("string") for v in CUSTOMER_VALUES])
    return _customers(spark, sf).select("c_custkey", t.joined_text(values, ",").alias("joined"))


@query("row_key_text", f"""SELECT 'Row: ' || c_custkey || ':' || c_name || ':' || c_acctbal || ':'
  || coalesce({SEGMENT_SQL}, 'null') AS row_text, 'Key: ' || c_custkey AS key_text FROM customer""")
def row_key_text(spark: SparkSession, sf: str) -> DataFrame:
    values = F.array(*[F.col(v).cast("string") for v in CUSTOMER_VALUES])
    key = F.array(F.col("c_custkey").cast("string"))
    return _customers(spark, sf).select(t.row_text(values).alias("row_text"),
                                        t.key_text(key).alias("key_text"))


@query("row_record", f"""SELECT c_custkey, json_object('c_custkey', c_custkey, 'c_name', c_name,
  'c_acctbal', c_acctbal, 'c_mktsegment', {SEGMENT_SQL})::VARCHAR AS record FROM customer""")
def row_record(spark: SparkSession, sf: str) -> DataFrame:
    record = t.row_record(*CUSTOMER_VALUES)
    return _customers(spark, sf).select("c_custkey", record.alias("record"))


@query("decode_strings", """SELECT doc_id, text, CASE WHEN lang <> 'en' THEN lang END AS lang
FROM documents""")
def decode_strings(spark: SparkSession, sf: str) -> DataFrame:
    raw = i.table(spark, sf, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("text"),
        F.when(F.col("lang") != "en", F.encode("lang", "UTF-8")).alias("lang"))
    return raw.select("doc_id", ty.read_text(F.col("text")).alias("text"),
                      ty.read_text(F.col("lang")).alias("lang"))


@query("coerce_ints", """SELECT o_orderkey, TRY_CAST(o_custkey AS TINYINT) AS as_tinyint,
  TRY_CAST(o_custkey AS TINYINT) IS NOT NULL AS fits_tinyint,
  TRY_CAST(o_orderkey AS SMALLINT) AS as_smallint,
  TRY_CAST(o_orderkey AS SMALLINT) IS NOT NULL AS fits_smallint,
  CAST(o_orderkey AS INTEGER) AS as_int FROM orders""")
def coerce_ints(spark: SparkSession, sf: str) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    return i.table(spark, sf, "orders").select(
        "o_orderkey",
        ty.read_int(customer, "TINYINT").alias("as_tinyint"),
        ty.fits(customer, "TINYINT").alias("fits_tinyint"),
        ty.read_int(order, "SMALLINT").alias("as_smallint"),
        ty.fits(order, "SMALLINT").alias("fits_smallint"),
        ty.read_int(order, "INT").alias("as_int"),
    )


@query("map_source_types", i.with_(i.CATALOG_SQL) + """SELECT db, tbl, column_name, sql_type,
  engine_type, length, engine_type IS NOT NULL AS supported FROM typed""")
def map_source_types(spark: SparkSession, sf: str) -> DataFrame:
    return typed_columns(i.cat_columns(spark, sf)).drop("ordinal", "spark_type")


@query("map_sink_types", i.with_(i.CATALOG_SQL)
       + "SELECT db, tbl, column_name, sink_type FROM sink_wanted")
def map_sink_types(spark: SparkSession, sf: str) -> DataFrame:
    return sink_columns_for(i.cat_columns(spark, sf)).drop("ordinal", "comment")


@query("table_id", i.with_(i.CATALOG_SQL) + "SELECT db || '.' || tbl AS table_id FROM cat_tables")
def table_id(spark: SparkSession, sf: str) -> DataFrame:
    return i.cat_tables(spark, sf).select(
        t.table_id(F.col("db"), F.col("tbl")).alias("table_id"))


@query("delta_kind", i.with_(i.CHANGELOG_SQL) + """SELECT k, epoch, filename, "offset", seq,
  CASE WHEN after_k IS NULL THEN 'D' WHEN before_k IS NULL THEN 'I' ELSE 'U' END AS kind
FROM changelog""")
def delta_kind(spark: SparkSession, sf: str) -> DataFrame:
    return i.full_log(spark, sf).select(
        "k", "epoch", "filename", "offset", "seq",
        d.delta_kind(F.col("before"), F.col("after")).alias("kind"))


@query("delta_phase", i.with_(*i.ALL_DELTAS_SQL) + """SELECT k, filename, "offset", seq,
  CASE WHEN "offset" = 0 THEN 'backfill' ELSE 'iterative' END AS phase FROM deltas""")
def delta_phase(spark: SparkSession, sf: str) -> DataFrame:
    return i.all_deltas(spark, sf).select("k", "filename", "offset", "seq",
                                          p.phase(F.col("offset")).alias("phase"))


@query("delta_text", i.with_(i.CHANGELOG_SQL) + f"""SELECT 'Got {i.ACCOUNT_TEXT}: '
  || CASE WHEN before_k IS NULL THEN 'null'
          ELSE 'Row: ' || before_k || ':' || before_v || ':' || before_s END || ' -> '
  || CASE WHEN after_k IS NULL THEN 'null'
          ELSE 'Row: ' || after_k || ':' || after_v || ':' || after_s END
  || ' @ MySqlStreamPosition: (' || epoch || ':' || filename || ':' || "offset" || ')' AS line
FROM changelog""")
def delta_text(spark: SparkSession, sf: str) -> DataFrame:
    return delta_lines(i.full_log(spark, sf), F.lit(i.ACCOUNT_TEXT), ["k", "v", "s"])


# --- checks ---------------------------------------------------------------------

TURN_WIDTH = 4


def _row_images(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as logged rows: fifth turns are a value short, third turns
    leave out the text."""
    turn = F.col("turn")
    values = [F.col(v).cast("string") for v in ("conv_id", "turn", "role", "text")]
    yes, no = F.lit(True), F.lit(False)
    return i.table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.when(turn == 5, F.array(*values[:3])).otherwise(F.array(*values)).alias("values"),
        F.when(turn == 5, F.array(yes, yes, yes)).when(turn == 3, F.array(yes, yes, yes, no))
        .otherwise(F.array(yes, yes, yes, yes)).alias("included"),
    )


@query("width_violations", """SELECT conv_id, turn, CAST(3 AS INTEGER) AS width,
  CAST(4 AS INTEGER) AS expected FROM conversations WHERE turn = 5""")
def width_violations(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = c.set_apart(_row_images(spark, sf), c.has_width(F.col("values"), TURN_WIDTH))
    return bad.select("conv_id", "turn", F.size("values").alias("width"),
                      F.lit(TURN_WIDTH).alias("expected"))


@query("partial_images", "SELECT conv_id, turn FROM conversations WHERE turn IN (3, 5)")
def partial_images(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = c.set_apart(_row_images(spark, sf), c.is_full_image(F.col("included"), TURN_WIDTH))
    return bad.select("conv_id", "turn")


@query("table_map_mismatch", i.with_(i.CATALOG_SQL) + """, widths AS (
  SELECT db, tbl, CAST(count(*) AS INTEGER) AS columns FROM cat_columns GROUP BY db, tbl)
SELECT db, tbl, columns + 1 AS width, columns FROM widths JOIN cat_tables USING (db, tbl)
WHERE p_size = 21""")
def table_map_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    # Tables made from parts of size 21 were widened after their catalog was read.
    width = F.expr("2 + p_size % 5 + if(p_size = 21, 1, 0)")
    mapped = i.cat_tables(spark, sf).select("db", "tbl", width.alias("width"))
    return c.table_map_mismatch(mapped, i.cat_columns(spark, sf))


@query("schema_drift", i.with_(i.CATALOG_SQL) + """, compared AS (
  SELECT coalesce(w.db, s.db) AS db, coalesce(w.tbl, s.tbl) AS tbl,
         coalesce(w.column_name, s.column_name) AS column_name,
         w.sink_type AS expected, s.sink_type AS found,
         CASE WHEN s.tbl IS NULL THEN 'missing' WHEN w.tbl IS NULL THEN 'extra'
              WHEN w.sink_type <> s.sink_type THEN 'retyped' END AS drift
  FROM sink_wanted w FULL JOIN sink_columns s
    ON w.db = s.db AND w.tbl = s.tbl AND w.column_name = s.column_name)
SELECT * FROM compared WHERE drift IS NOT NULL""")
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    return c.schema_drift(sink_columns_for(i.cat_columns(spark, sf)), i.sink_columns(spark, sf))
