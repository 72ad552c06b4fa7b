"""Counts of deltas that stay right when batches come again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType)

from ..functions.position import phase, position_columns
from ..session import read_if_written

_COUNTS = StructType([
    StructField("db", StringType()), StructField("tbl", StringType()),
    StructField("phase", StringType()), StructField("op", StringType()),
    StructField("deltas", LongType()),
    StructField("last", StructType([
        StructField("epoch", IntegerType()), StructField("name_length", IntegerType()),
        StructField("filename", StringType()), StructField("offset", LongType())]))])


class CountTable:
    """Counts and last positions by table, phase and operation, a few rows for each batch.

    A batch that comes again replaces its own rows, so nothing is counted twice; the rows of all
    batches are added up on reading.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def add(self, batch: DataFrame, batch_id: int | str) -> None:
        last = F.max(F.struct(*position_columns()))
        batch.groupBy("db", "tbl", phase(F.col("offset")).alias("phase"), "op").agg(
            F.count("*").alias("deltas"), last.alias("last")).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def _rows(self) -> DataFrame:
        rows = read_if_written(self.spark, self.path, _COUNTS)
        return self.spark.createDataFrame([], _COUNTS) if rows is None else rows

    def by_phase(self) -> DataFrame:
        """Deltas by table and phase."""
        return self._rows().groupBy("db", "tbl", "phase").agg(F.sum("deltas").alias("count"))

    def by_op(self) -> DataFrame:
        """Deltas by table and operation."""
        return self._rows().groupBy("db", "tbl", "op").agg(F.sum("deltas").alias("count"))

    def high_water(self) -> DataFrame:
        """The last position of each table."""
        return self._rows().groupBy("db", "tbl").agg(F.max("last").alias("last")).select(
            "db", "tbl", "last.epoch", "last.filename", "last.offset")
