"""Reading a landed change log, whole or as a stream, typed or raw."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.position import after_position, in_files_from, position_columns
from ..functions.types import read_text
from ..model import TableSpec
from ..operators.checks import has_width, is_full_image
from ..operators.deltas import row_events, unpack_rows
from ..operators.lookups import orphans, table_at

# Raw log events. A row change has the values before and after it, each as the bytes
# of its text; an insert has no ``before`` and a delete no ``after``. ``included``
# tells for each column whether the event has its value.
RAW_EVENTS = """epoch int, filename string, offset bigint, event_type string, table_id bigint,
included_before array<boolean>, included array<boolean>,
rows array<struct<before:array<binary>,after:array<binary>>>"""
TABLE_MAP = ("epoch int, filename string, offset bigint, table_id bigint, db string, "
             "tbl string")


def read_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return _in_order(spark.read.schema(schema).parquet(path), schema)


def _in_order(log: DataFrame, schema: StructType | str) -> DataFrame:
    """The columns as the schema has them; those that are folders would come last."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return log.select(*schema.fieldNames())


def stream_log(spark: SparkSession, path: str, schema: StructType | str,
               files_per_batch: int | None = None) -> DataFrame:
    """The log's files as a stream; ``path`` is a folder or a glob pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _in_order(reader.parquet(path), schema)


# A log landed in folders by these can be read from a position on without opening older files.
LOG_FOLDERS = ("epoch", "filename")


def land_log(log: DataFrame, path: str) -> None:
    """Add a log to ``path``, in a folder for each of its files.

    A file's rows are gathered before; those of a large one stay in several tasks.
    """
    (log.hint("rebalance", *LOG_FOLDERS).write.mode("append").partitionBy(*LOG_FOLDERS)
     .parquet(path))


def log_after(log: DataFrame, epoch: int, filename: str, offset: int) -> DataFrame:
    """The rows of a log, at rest or streaming, that are strictly behind a position.

    Of a log written by ``land_log`` the folders of older files are pruned. In one landed otherwise
    only the epoch reaches the scan as a filter, since names are ordered by their length first.
    """
    return (log.where(F.col("epoch") >= epoch).where(in_files_from(epoch, filename))
            .where(after_position(epoch, filename, offset)))


def row_changes(events: DataFrame) -> DataFrame:
    """One row per row change of the raw events, with its ``op`` and ``seq``."""
    changes = unpack_rows(row_events(events))
    return changes.select("*", "row.before", "row.after").drop("row", "event_type")


def unmapped_changes(changes: DataFrame, table_map: DataFrame) -> DataFrame:
    """Row changes whose table is not known."""
    return orphans(changes, table_map)


def _sides(check) -> Column:
    """Whether both images pass a check; an absent image does."""
    passes = [F.col(values).isNull() | check(F.col(values), F.col(included))
              for values, included in (("before", "included_before"), ("after", "included"))]
    return F.coalesce(passes[0] & passes[1], F.lit(False))


def _image(values: str, schema: StructType) -> Column:
    typed = [read_text(F.get(values, n)).try_cast(field.dataType).alias(field.name)
             for n, field in enumerate(schema)]
    return F.when(F.col(values).isNotNull(), F.struct(*typed))


def _unreadable(values: str, image: str, schema: StructType) -> Column:
    """Whether some value is there that its column's type does not hold."""
    lost = F.lit(False)
    for n, field in enumerate(schema):
        lost = lost | (F.get(values, n).isNotNull() & F.col(image)[field.name].isNull())
    return F.col(values).isNotNull() & lost


def table_changes(changes: DataFrame, table_map: DataFrame, table: TableSpec) -> DataFrame:
    """The row changes of one table as typed deltas, with a column ``reason``."""
    return typed_changes(table_at(changes, table_map), table)


def typed_changes(mapped: DataFrame, table: TableSpec) -> DataFrame:
    """Of row changes with their ``db, tbl`` those of one table, with a column ``reason``.

    ``reason`` is null for a good row. Else it tells why the row cannot be loaded:
    not all columns are in its image, it has another number of values than the table
    has columns, or a value is not of its column's type.
    """
    schema, width = table.schema, len(table.schema)
    ours = mapped.where(
        (F.col("db") == table.db) & (F.col("tbl") == table.name))
    typed = ours.withColumn("old", _image("before", schema)).withColumn(
        "new", _image("after", schema))
    reason = (
        F.when(~_sides(lambda _, included: is_full_image(included, width)), "partial row image")
        .when(~_sides(lambda values, _: has_width(values, width)), "wrong number of values")
        .when(_unreadable("before", "old", schema) | _unreadable("after", "new", schema),
              "value not of its type"))
    return typed.select(*_delta_columns(table), reason.alias("reason"))


@dataclass(frozen=True)
class SchemaHistory:
    """A table as it is now, and the schemas it had before, each until a log position.

    ``earlier`` are pairs of a schema and the position ``(epoch, filename, offset)`` from which
    on it is no longer in force, the oldest first.
    """

    table: TableSpec
    earlier: tuple[tuple[StructType, tuple[int, str, int]], ...] = ()

    def choose(self, of) -> Column:
        """``of(schema)`` for the schema in force at a row's position."""
        chosen = of(self.table.schema)
        for schema, (epoch, filename, offset) in reversed(self.earlier):
            until = F.struct(F.lit(epoch), F.lit(len(filename)), F.lit(filename),
                             F.lit(offset).cast("long"))
            chosen = F.when(F.struct(*position_columns()) < until, of(schema)).otherwise(chosen)
        return chosen


def typed_by_history(mapped: DataFrame, history: SchemaHistory) -> DataFrame:
    """As ``typed_changes``, each row read by the schema that was in force at its position.

    The images have the columns the table has now: those added later are null in older rows, those
    dropped since are left out, and values are read as the types the columns have now. One pass,
    whatever the number of schemas. A new key column has no value in older rows, so it is refused.
    """
    table, now = history.table, history.table.schema
    for schema, _ in history.earlier:
        absent = [k for k in table.key if k not in schema.fieldNames()]
        if absent:
            raise ValueError(f"{table.table_id}: key columns {absent} were added later")

    def image(values: str) -> Column:
        def of(schema: StructType) -> Column:
            places = {name: n for n, name in enumerate(schema.fieldNames())}
            return F.struct(*[
                (read_text(F.get(values, places[f.name])) if f.name in places else
                 F.lit(None).cast("string")).try_cast(f.dataType).alias(f.name) for f in now])
        return F.when(F.col(values).isNotNull(), history.choose(of))

    def lost(values: str, typed: str) -> Column:
        def of(schema: StructType) -> Column:
            bad = F.lit(False)
            for n, name in enumerate(schema.fieldNames()):
                if name in now.fieldNames():
                    bad = bad | (F.get(values, n).isNotNull() & F.col(typed)[name].isNull())
            return bad
        return F.col(values).isNotNull() & history.choose(of)

    width = history.choose(lambda schema: F.lit(len(schema)))
    ours = mapped.where((F.col("db") == table.db) & (F.col("tbl") == table.name))
    typed = ours.withColumn("old", image("before")).withColumn("new", image("after"))
    reason = (
        F.when(~_sides(lambda _, included: is_full_image(included, width)), "partial row image")
        .when(~_sides(lambda values, _: has_width(values, width)), "wrong number of values")
        .when(lost("before", "old") | lost("after", "new"), "value not of its type"))
    return typed.select(*_delta_columns(table), reason.alias("reason"))


def _delta_columns(table: TableSpec) -> list[Column]:
    key = [F.coalesce(F.col("new")[k], F.col("old")[k]).alias(k) for k in table.key]
    return [F.col("db"), F.col("tbl"), F.col("op"), *key, F.col("old").alias("before"),
            F.col("new").alias("after"), F.col("epoch"), F.col("filename"), F.col("offset"),
            F.col("seq")]


def typed_deltas(routed: DataFrame, table: TableSpec) -> DataFrame:
    """The rows that were routed to a table, which have no faults, as its deltas."""
    typed = routed.withColumn("old", _image("before", table.schema)).withColumn(
        "new", _image("after", table.schema))
    return typed.select(*_delta_columns(table))
