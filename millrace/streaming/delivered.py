"""Deltas once each, by the stretches of the log that were delivered before."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.deltas import without_repeats
from ..operators.stretches import STRETCH, outside, stretches
from ..session import append_row, read_if_written
from ..sinks.tables import Processor, batch_name

_VERSIONS = StructType([StructField("number", LongType()), StructField("batch", StringType()),
                        StructField("folder", StringType())])
_PARTS = StructType([StructField("part", StringType())])


class Delivered:
    """What of a log was delivered, kept below ``root`` as stretches.

    It grows with the gaps between what was delivered, not with the deltas: a file that has come
    whole is one row. Rows need ``next_offset``, and all rows of an event have to come in one
    batch, as they do when the log's files land whole. Each batch leaves a version of its own,
    and a batch that is handed over again is judged by the version before its own, so it gives the
    same rows. Batches have names that no others have, so a log may be read by several streams,
    one after the other.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _versions(self, before: str | None = None) -> list[tuple[int, str]]:
        """Numbers and folders of all versions, or of those before a batch's own, newest last."""
        versions = read_if_written(self.spark, f"{self.root}/versions", _VERSIONS)
        rows = [] if versions is None else sorted(map(tuple, versions.collect()))
        own = min((n for n, batch, _ in rows if batch == before), default=None)
        return [(n, folder) for n, _, folder in rows if own is None or n < own]

    def stretches(self, before: str | None = None) -> DataFrame:
        """The stretches delivered so far, or before a batch."""
        versions = self._versions(before)
        return (self.spark.read.schema(STRETCH).parquet(versions[-1][1]) if versions
                else self.spark.createDataFrame([], STRETCH))

    def new_rows(self, batch: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
        """The deltas of the batch ``name`` that no batch before it had, each once."""
        return without_repeats(outside(batch, self.stretches(name)), key)

    def note(self, batch: DataFrame, name: str) -> None:
        """Count the batch ``name`` as delivered."""
        versions = self._versions(name)
        log = batch.select("epoch", "filename", "offset", "next_offset")
        if versions:
            log = log.unionByName(self.spark.read.schema(STRETCH).parquet(versions[-1][1]))
        folder = f"{self.root}/stretches/{uuid.uuid4().hex}"
        stretches(log).write.parquet(folder)
        number = versions[-1][0] + 1 if versions else 0
        append_row(self.spark, f"{self.root}/versions", _VERSIONS, number, name, folder)

    def once(self, processor: Processor, key: Sequence[str]) -> Processor:
        """``processor``, handed each delta in one batch only."""
        def process(batch: DataFrame, batch_id: int) -> None:
            name = batch_name("batch", batch, batch_id)
            processor(self.new_rows(batch, name, key), batch_id)
            self.note(batch, name)

        return process

    def part(self, name: str) -> bool:
        """Whether the named part of a backfill is still to come; see ``end_part``.

        Rows of a backfill share a position, so it is delivered, and counts, in whole parts.
        """
        parts = read_if_written(self.spark, f"{self.root}/parts", _PARTS)
        return parts is None or parts.where(F.col("part") == name).isEmpty()

    def end_part(self, name: str) -> None:
        append_row(self.spark, f"{self.root}/parts", _PARTS, name)
