"""Reading a source database through Spark's JDBC source.

The catalog comes from ``information_schema``. The database itself numbers the keys in its
own order, so that ranges hold for any collation, and only the border keys come over. A table
is read in waves of key ranges, each range in one query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import base_tables, primary_keys

# A JDBC read takes its ranges as a list on the driver. So many are read in one wave; a load
# that was stopped goes on with the wave it was in.
RANGES_PER_WAVE = 1_000


@dataclass(frozen=True)
class JdbcOptions:
    host: str
    database: str
    user: str
    password: str = field(repr=False)
    port: int = 3306
    batch_size: int = 10_000
    epoch: int = 0
    concurrent_full_imports: int = 5
    url: str | None = None
    driver: str | None = None

    def reader(self) -> dict[str, str]:
        options = {
            "url": self.url or f"jdbc:mysql://{self.host}:{self.port}/{self.database}",
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.batch_size),
        }
        if self.driver:
            options["driver"] = self.driver
        return options


def read_query(spark: SparkSession, options: JdbcOptions, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options.reader()).option("query", query).load()


def read_tables(spark: SparkSession, options: JdbcOptions) -> DataFrame:
    return read_query(spark, options, "SELECT table_schema AS db, table_name AS tbl, table_type "
                                      "FROM information_schema.tables").where(
        F.col("db") == options.database)


def read_columns(spark: SparkSession, options: JdbcOptions) -> DataFrame:
    return read_query(
        spark, options,
        "SELECT table_schema AS db, table_name AS tbl, column_name AS column_name, "
        "ordinal_position AS ordinal, upper(data_type) AS sql_type, "
        "character_maximum_length AS size FROM information_schema.columns",
    ).where(F.col("db") == options.database)


def read_indexes(spark: SparkSession, options: JdbcOptions) -> DataFrame:
    return read_query(
        spark, options,
        "SELECT table_schema AS db, table_name AS tbl, index_name, seq_in_index AS seq, "
        "column_name AS column_name FROM information_schema.statistics",
    ).where(F.col("db") == options.database)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def point_query(table: str, key: Sequence[str], batch_size: int) -> str:
    """The first key of every range but the first, in the database's own order of keys."""
    names = ", ".join(map(quoted, key))
    return (f"SELECT {names}, _place FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) "
            f"- 1 AS _place FROM {quoted(table)}) AS _keys "
            f"WHERE _place > 0 AND MOD(_place, {int(batch_size)}) = 0")


def read_points(spark: SparkSession, options: JdbcOptions, table: str,
                key: Sequence[str]) -> DataFrame:
    """``split_id`` and key of every split point: one row for each ``batch_size`` rows."""
    found = read_query(spark, options, point_query(table, key, options.batch_size))
    return found.select(F.expr(f"CAST(_place AS BIGINT) div {options.batch_size}").alias("split_id"),
                        *key)


def _literal(value: object) -> str:
    """A key value as SQL; a date or a time of day with it is written as its text."""
    if value is None or isinstance(value, bool):
        raise TypeError(f"{value!r} is no key value")
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    value = str(value)
    if "\\" in value:
        # Whether a backslash escapes depends on the session's mode, so none is written.
        return f"_utf8mb4 X'{value.encode().hex()}'"
    return "'" + value.replace("'", "''") + "'"


def _less(key: Sequence[str], bound: Sequence) -> str:
    first, *others = key
    value, *rest = bound
    less = f"{quoted(first)} < {_literal(value)}"
    if not others:
        return less
    return f"({less} OR ({quoted(first)} = {_literal(value)} AND {_less(others, rest)}))"


def range_predicate(key: Sequence[str], lo: Sequence | None, hi: Sequence | None) -> str:
    """The range ``[lo, hi)`` as SQL text, spelled out column by column."""
    parts = []
    if lo is not None:
        parts.append(f"NOT ({_less(key, lo)})")
    if hi is not None:
        parts.append(f"{_less(key, hi)}")
    return " AND ".join(parts) or "1 = 1"


def waves(points: DataFrame, key: Sequence[str],
          size: int = RANGES_PER_WAVE) -> Iterator[tuple[str, list[str]]]:
    """The ranges between split points in waves: a name, and one predicate per range.

    Every key is in one range. Only the points of one wave are on the driver.
    """
    last = points.agg(F.max("split_id")).first()[0] or 0
    for first in range(0, last + 1, size):
        end = min(first + size, last + 1)
        at = {row["split_id"]: tuple(row[k] for k in key)
              for row in points.where(F.col("split_id").between(first, end)).collect()}
        yield f"r{first}", [range_predicate(key, at.get(n), at.get(n + 1))
                            for n in range(first, end)]


def read_ranges(spark: SparkSession, options: JdbcOptions, table: str,
                predicates: list[str]) -> DataFrame:
    """The rows of the given ranges, in as many tasks as may read at a time.

    Each range is a query of its own; a lost task repeats its share of one wave.
    """
    reader = options.reader()
    df = spark.read.jdbc(reader.pop("url"), quoted(table), predicates=predicates,
                         properties=reader)
    return df.coalesce(options.concurrent_full_imports)


def table_keys(spark: SparkSession, options: JdbcOptions) -> list[tuple[str, tuple[str, ...]]]:
    """The database's base tables with their primary key columns.

    Raises when a key names a column its table has not. A driver-side list: as
    long as the database has tables.
    """
    tables = base_tables(read_tables(spark, options), options.database)
    keys = primary_keys(read_columns(spark, options), read_indexes(spark, options))
    found = tables.join(keys, ["db", "tbl"], "left").collect()
    unknown = [row.tbl for row in found if row.known is False]
    if unknown:
        raise ValueError(f"unknown primary key columns in {unknown}")
    return [(row.tbl, tuple(row.key or ())) for row in found]
