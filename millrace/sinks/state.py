"""The current state of a table, kept in the warehouse.

Below ``root`` there are

``versions``                  one row per finished base or raised fence: the base's number
                              and folder, and the fence
``base/<folder>``             the latest delta per key, tombstones included, in
                              buckets of the key
``delta/v=<n>/batch_id=<i>``  what batch ``i`` brought on top of base ``n``

A batch that is delivered again overwrites its own folder, or, after the base was
rewritten, adds deltas the base already has. Neither changes the result, since
the greatest position wins. A base counts once its row is in ``versions``; one
that was left unfinished is never read. One job at a time may write.

The fence is an epoch. When a source was read anew in a higher epoch and all of it has
come, the epochs before are over: whatever has a lower one, be it stored or still landing,
is not there any more. A late delta of an old epoch therefore cannot bring back a key that
the new epoch's backfill did not have, though no tombstone of that key is kept.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.position import position_columns
from ..model import BACKFILL_OFFSET, TableSpec
from ..operators.merge import (latest_delta, live_rows, merge_latest, of_epochs_from,
                               tombstones)
from ..session import append_row, read_if_written

_VERSIONS = StructType([StructField("version", LongType()), StructField("buckets", IntegerType()),
                        StructField("folder", StringType()),
                        StructField("fence", IntegerType())])


class _Base(NamedTuple):
    version: int
    buckets: int
    folder: str | None
    fence: int | None = None

    def holds(self, deltas: DataFrame) -> DataFrame:
        """Those of ``deltas`` that are not of an epoch that is over."""
        return deltas if self.fence is None else of_epochs_from(deltas, self.fence)


class StateTable:
    def __init__(self, spark: SparkSession, root: str, table: TableSpec,
                 buckets: int | None = None):
        if not table.key:
            raise ValueError(f"{table.table_id} has no primary key and cannot be merged")
        self.spark, self.root, self.key = spark, root, list(table.key)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema = StructType([
            *[table.schema[k] for k in table.key],
            StructField("op", StringType()),
            StructField("after", table.schema),
            StructField("epoch", IntegerType()),
            StructField("filename", StringType()),
            StructField("offset", LongType()),
            StructField("seq", IntegerType()),
        ])

    def _newest(self) -> _Base:
        """The newest base; number 0 stands for none."""
        versions = read_if_written(self.spark, f"{self.root}/versions", _VERSIONS)
        # Of the rows of one base, the one with the highest fence counts; null is below all.
        newest = (None if versions is None else versions.agg(
            F.max_by(F.struct("*"), F.struct("version", "fence")).alias("v")).first().v)
        return _Base(0, self.buckets, None) if newest is None else _Base(*newest)

    @staticmethod
    def _table_name(folder: str) -> str:
        return "state_" + hashlib.sha256(folder.encode()).hexdigest()[:32]

    def _rows_of(self, base: _Base) -> DataFrame:
        """The base as a bucketed table, made known to the catalog if it is not."""
        name = self._table_name(base.folder)
        if not self.spark.catalog.tableExists(name):
            key = ", ".join(f"`{k}`" for k in self.key)
            self.spark.sql(
                f"CREATE TABLE {name} ({self.schema.toDDL()}) USING parquet "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {base.buckets} BUCKETS "
                f"LOCATION '{base.folder}'")
        return self.spark.table(name)

    def _batches(self, version: int) -> DataFrame | None:
        return read_if_written(self.spark, f"{self.root}/delta/v={version}", self.schema)

    def apply(self, deltas: DataFrame, batch_id: int | str, reduce: bool = True) -> None:
        """Add a batch. The same batch may come again, and batches in any order.

        A batch known to hold each key once, as a backfill does, need not be reduced:
        it is then written without a shuffle. Deltas below the fence are not written.
        """
        base = self._newest()
        deltas = base.holds(deltas)
        if reduce:
            deltas = latest_delta(deltas, self.key)
        deltas.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(
            f"{self.root}/delta/v={base.version}/batch_id={batch_id}")

    def latest(self) -> DataFrame:
        """Key, operation, after-image and position of every key, tombstones included."""
        return self._latest(self._newest())

    def _latest(self, base: _Base) -> DataFrame:
        stored = None if base.folder is None else base.holds(self._rows_of(base))
        batches = self._batches(base.version)
        if batches is None:
            return self.spark.createDataFrame([], self.schema) if stored is None else stored
        # A key is at most once in each batch, so it is not hot here. With as many
        # partitions as the base has buckets, the base is not shuffled.
        recent = latest_delta(
            base.holds(batches).repartition(base.buckets, *self.key), self.key)
        return recent if stored is None else merge_latest(stored, recent, self.key)

    def rows(self) -> DataFrame:
        """The table as it is now."""
        return live_rows(self.latest())

    def deleted(self) -> DataFrame:
        return tombstones(self.latest())

    def high_water(self) -> tuple[int, str, int] | None:
        """The last log position (epoch, file name, offset) that is stored, None without one.

        For logs that are delivered in order: all before it is stored then. Only the columns of
        the position are read, and nothing is merged.
        """
        base = self._newest()
        parts = [self._batches(base.version), self._rows_of(base) if base.folder else None]
        last = [base.holds(part).where(F.col("offset") != BACKFILL_OFFSET).agg(
            F.max(F.struct(*position_columns())).alias("last")).first().last
            for part in parts if part is not None]
        last = max((tuple(row) for row in last if row is not None), default=None)
        return None if last is None else (last[0], last[2], last[3])

    def fence(self) -> int | None:
        """The lowest epoch whose deltas count, None if all do."""
        return self._newest().fence

    def raise_fence(self, epoch: int) -> None:
        """Leave out all keys and deltas of lower epochs, from now on and for good.

        For use once that epoch's backfill is complete: a key it did not bring was deleted
        between the epochs. Nothing is rewritten; the next ``compact`` drops what is left out.
        """
        base = self._newest()
        if base.fence is None or base.fence < epoch:
            self._note(base._replace(fence=epoch))

    def _note(self, base: _Base) -> None:
        append_row(self.spark, f"{self.root}/versions", _VERSIONS, *base)

    def compact(self) -> None:
        """Write a new base from the present one and its batches."""
        old = self._newest()
        new = old._replace(version=old.version + 1,
                           folder=f"{self.root}/base/v={old.version + 1}-{uuid.uuid4().hex}")
        # The merge leaves each bucket in a task of its own, so it is one file.
        state = self._latest(old).select(*self.schema.fieldNames())
        (state.write.format("parquet").bucketBy(new.buckets, *self.key).sortBy(*self.key)
         .option("path", new.folder).saveAsTable(self._table_name(new.folder)))
        self._note(new)
