"""The table mappings of a log as state that is carried from batch to batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.mappings import RUNS, TABLE_KEY, file_runs, merged_runs, names_at, torn
from ..session import append_row, read_if_written, stored
from .log import TABLE_MAP, read_log, stream_log

_VERSIONS = StructType([StructField("version", LongType()), StructField("folder", StringType())])


class MappingState:
    """What a landed folder of mappings says so far, kept as runs below ``root``.

    ``refresh`` reads only the files that landed since, as a stream that ends, and merges their
    runs into the ones known; mappings may be repeated and come in any order. Only where a late
    mapping falls into a run of another name, that table id's mappings are read again. The runs
    are written anew each time and count once their row is in ``versions``, so a refresh that
    was cut off is done again with the same result. One job at a time may refresh.
    """

    def __init__(self, spark: SparkSession, folder: str, root: str,
                 files_per_batch: int | None = None) -> None:
        self.spark, self.folder, self.root = spark, folder, root
        self.files_per_batch = files_per_batch

    def runs(self) -> DataFrame:
        versions = read_if_written(self.spark, f"{self.root}/versions", _VERSIONS)
        newest = None if versions is None else versions.agg(
            F.max_by(F.struct("*"), "version").alias("v")).first().v
        if newest is None:
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).parquet(newest.folder)

    def _merge(self, table_map: DataFrame, _: int) -> None:
        both = stored(self.runs().unionByName(file_runs(table_map)), "runs")
        again = torn(both)
        if not again.isEmpty():
            again = stored(again, "torn")
            read = read_log(self.spark, self.folder, TABLE_MAP).join(again, list(TABLE_KEY),
                                                                    "left_semi")
            both = both.join(again, list(TABLE_KEY), "left_anti").unionByName(file_runs(read))
        self._keep(merged_runs(both))

    def _keep(self, runs: DataFrame) -> None:
        versions = read_if_written(self.spark, f"{self.root}/versions", _VERSIONS)
        last = 0 if versions is None else versions.agg(F.max("version")).first()[0] or 0
        folder = f"{self.root}/runs/{uuid.uuid4().hex}"
        runs.write.parquet(folder)
        append_row(self.spark, f"{self.root}/versions", _VERSIONS, last + 1, folder)

    def refresh(self) -> None:
        """Take in the mappings that landed since the last time."""
        stream = stream_log(self.spark, self.folder, TABLE_MAP, self.files_per_batch)
        (stream.writeStream.foreachBatch(self._merge)
         .option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True)
         .start().awaitTermination())

    def names_at(self, rows: DataFrame, **limits) -> DataFrame:
        """``rows`` with the ``db, tbl`` in force at their positions, null where there is none."""
        return names_at(rows, self.runs(), **limits)
