"""Appending after-images, creating sink tables, and the sink's catalog."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.text import TABLE_COMMENT, delta_text, row_text, struct_values
from ..functions.types import SINK_SPARK_TYPES, widest
from ..model import DELETE, TableSpec
from ..session import stored


def after_images(deltas: DataFrame) -> DataFrame:
    """The rows an append-only sink gets: after-images of inserts and updates."""
    return deltas.where(F.col("op") != DELETE).select("after.*")


def append_rows(deltas: DataFrame, path: str, batch_id: int | str,
                schema: StructType | None = None) -> None:
    """Append a batch's after-images, as ``schema`` if given; a repeated batch replaces itself."""
    images = after_images(deltas)
    if schema is not None:
        images = images.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    images.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All appended rows, without the folder's batch number."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def delta_lines(deltas: DataFrame, schema_text: Column, fields: Sequence[str]) -> DataFrame:
    """One line of text per delta."""
    def image(side: str) -> Column:
        return F.when(F.col(side).isNotNull(), row_text(struct_values(side, list(fields))))

    return deltas.select(delta_text(schema_text, image("before"), image("after"), F.col("epoch"),
                                    F.col("filename"), F.col("offset")).alias("line"))


def sink_schema(columns: Sequence[tuple[str, str, str]]) -> StructType:
    """The Spark schema of a sink table from ``(name, sink type, comment)``."""
    return StructType([StructField(name, SINK_SPARK_TYPES[kind], True, {"comment": comment})
                       for name, kind, comment in columns])


def sink_table_schema(table: TableSpec) -> StructType:
    """The table's columns in the sink's types, each with a comment that tells its origin."""
    comment = {"comment": f"{TABLE_COMMENT}{table.table_id}"}
    return StructType([StructField(f.name, widest(f.dataType), True, comment)
                       for f in table.schema])


def sink_table_name(table: TableSpec) -> str:
    """The table's name in the sink; ``a_b.c`` and ``a.b_c`` have different ones.

    Two underscores part database and table; one of their own becomes ``_u``.
    """
    return "__".join(part.replace("_", "_u") for part in (table.db, table.name))


def create_table(spark: SparkSession, database: str, name: str, schema: StructType,
                 path: str) -> None:
    """Create an empty sink table if the sink has none of that name.

    The table is all that is below ``path``, in batch folders or not.
    """
    full = f"{database}.{name}"
    if not spark.catalog.tableExists(full):
        spark.catalog.createTable(full, path=path, source="parquet", schema=schema,
                                  recursiveFileLookup="true")


def check_table(spark: SparkSession, database: str, name: str, schema: StructType) -> None:
    """Raise if a sink table's columns are not those of ``schema``."""
    wanted = {field.name: field.dataType.simpleString() for field in schema}
    found = {c.name: c.dataType for c in spark.catalog.listColumns(f"{database}.{name}")}
    drift = {column: (wanted.get(column), found.get(column))
             for column in wanted.keys() | found.keys()
             if wanted.get(column) != found.get(column)}
    if drift:
        raise ValueError(f"{database}.{name} has drifted, column: (source, sink) {drift}")


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """``tbl, column_name, ordinal, spark_type`` of every table in the sink.

    Names and types only: as many rows as the sink has columns.
    """
    found = [
        (table.name, column.name, place, column.dataType)
        for table in spark.catalog.listTables(database)
        for place, column in enumerate(spark.catalog.listColumns(f"{database}.{table.name}"), 1)
    ]
    return spark.createDataFrame(
        found, "tbl string, column_name string, ordinal int, spark_type string")


Processor = Callable[[DataFrame, int], None]


def batch_name(origin: str, batch: DataFrame, batch_id: int) -> str:
    """A name for a batch that no other source, stream or checkpoint gives.

    The id of a streaming query lives in its checkpoint: it is the same after a restart, and
    another one for a new checkpoint, where the batch numbers start over.
    """
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return "-".join(filter(None, (origin, stream, str(batch_id))))


def fan_out(processors: Sequence[Processor]) -> Processor:
    """A processor that hands each batch to all of ``processors``, reading it once."""
    def process(batch: DataFrame, batch_id: int) -> None:
        # Written, so that an executor that is lost does not make the source be read again; what
        # fits into memory is not read from there twice.
        held = stored(batch, "batch").persist(StorageLevel.MEMORY_ONLY)
        try:
            for processor in processors:
                processor(held, batch_id)
        finally:
            held.unpersist()

    return process
