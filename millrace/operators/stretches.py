"""Stretches of a log: which offsets of which files are there, and where gaps are.

An event takes the offsets from its own up to that of the next one (``next_offset``), so events
that follow each other touch. Touching events are one stretch: ``epoch, filename, offset,
next_offset``. A whole log file is one row, however many events it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import FIRST_LOG_OFFSET
from ..session import BROADCAST_BYTES, BROADCAST_ROWS, is_small

FILE = ("epoch", "filename")
STRETCH = "epoch int, filename string, offset long, next_offset long"

# Offsets whose events are put together first, so that no file is one task's.
PART_OFFSETS = 1 << 24

# Stretches of one file that a broadcast join may look through.
FILE_STRETCHES = 64


def _touching(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    order = W.partitionBy(*key).orderBy("offset", "next_offset")
    reached = F.max("next_offset").over(order.rowsBetween(W.unboundedPreceding, -1))
    begins = F.coalesce(F.col("offset") > reached, F.lit(True))
    return (rows.withColumn("stretch", F.sum(begins.cast("long")).over(
        order.rowsBetween(W.unboundedPreceding, 0))).groupBy(*key, "stretch")
        .agg(F.min("offset").alias("offset"), F.max("next_offset").alias("next_offset"))
        .drop("stretch"))


def stretches(log: DataFrame) -> DataFrame:
    """The stretches of the events, or stretches, of ``log``; those without an extent do not count.

    Files are first done in parts of ``PART_OFFSETS``, and only what is left of each part meets.
    """
    places = log.select(*FILE, "offset", "next_offset").where("next_offset > offset")
    parts = places.withColumn("part", F.expr(f"offset div {PART_OFFSETS}"))
    return _touching(_touching(parts, (*FILE, "part")).drop("part"), FILE)


def outside(log: DataFrame, known: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
            broadcast_bytes: int = BROADCAST_BYTES,
            file_stretches: int = FILE_STRETCHES) -> DataFrame:
    """The rows of ``log`` whose event is in none of the ``known`` stretches.

    Few stretches are broadcast; else each event finds the last stretch that begins at or before
    it, by one sort of both.
    """
    most = known.groupBy(*FILE).count().agg(F.max("count")).first()[0] or 0
    if most <= file_stretches and is_small(known, broadcast_rows, broadcast_bytes):
        at = F.broadcast(known.select(F.col("epoch").alias("_epoch"), F.col("filename").alias("_name"),
                                      F.col("offset").alias("_from"),
                                      F.col("next_offset").alias("_to")))
        return log.join(at, (F.col("epoch") == F.col("_epoch"))
                        & (F.col("filename") == F.col("_name")) & (F.col("offset") >= F.col("_from"))
                        & (F.col("offset") < F.col("_to")), "left_anti")
    places = log.select(*FILE, "offset").distinct().withColumn("_to", F.lit(None).cast("long"))
    both = places.withColumn("_part", F.expr(f"offset div {PART_OFFSETS}")).unionByName(
        known.select(*FILE, "offset", F.col("next_offset").alias("_to"), F.explode(F.sequence(
            F.expr(f"offset div {PART_OFFSETS}"), F.expr(f"(next_offset - 1) div {PART_OFFSETS}")))
            .alias("_part")))
    order = W.partitionBy(*FILE, "_part").orderBy("offset", F.col("_to").isNull())
    inside = (both.withColumn("_reached", F.max("_to").over(
        order.rowsBetween(W.unboundedPreceding, 0)))
        .where(F.col("_to").isNull() & (F.col("_reached") > F.col("offset")))
        .select(*FILE, "offset"))
    return log.join(inside, [*FILE, "offset"], "left_anti").select(*log.columns)


# What is missing: offsets of a file, or files by their numbers.
GAPS = "epoch int, kind string, filename string, first long, last long"


def gaps(known: DataFrame, first_offset: int = FIRST_LOG_OFFSET) -> DataFrame:
    """What is missing between ``known`` stretches, of each epoch.

    ``kind`` is ``offsets`` for the offsets from ``first`` to ``last`` of a file, or ``files`` for
    the file numbers from ``first`` to ``last`` that have no event, and then ``filename`` is the
    file before them. What follows the last event of a file that has a next one cannot be known.
    """
    in_file = W.partitionBy(*FILE).orderBy("offset")
    reached = F.coalesce(F.lag("next_offset").over(in_file), F.lit(first_offset))
    offsets = known.withColumn("reached", reached).where("offset > reached").select(
        "epoch", F.lit("offsets").alias("kind"), "filename", F.col("reached").cast("long").alias(
            "first"), (F.col("offset") - 1).alias("last"))
    number = F.regexp_extract("filename", r"(\d+)$", 1).try_cast("long")
    files = known.select(*FILE).distinct().withColumn("number", number).where("number IS NOT NULL")
    order = W.partitionBy("epoch").orderBy("number")
    before = files.withColumn("after", F.lead("number").over(order)).where("after > number + 1")
    return offsets.unionByName(before.select(
        "epoch", F.lit("files").alias("kind"), "filename", (F.col("number") + 1).alias("first"),
        (F.col("after") - 1).alias("last")))


def complete_until(known: DataFrame, first_offset: int = FIRST_LOG_OFFSET) -> DataFrame:
    """For each epoch the last position (``filename, offset``) before which nothing is missing."""
    missing = gaps(known, first_offset)
    place = F.struct(F.length("filename").alias("length"), F.col("filename"), F.col("offset"))
    # A gap of files begins after its file's last event, one of offsets where the offsets do.
    ends = known.groupBy(*FILE).agg(F.max("next_offset").alias("end"))
    stops = missing.join(ends, list(FILE)).select(
        "epoch", "filename", F.when(F.col("kind") == "offsets", F.col("first")).otherwise(
            F.col("end")).alias("offset")).groupBy("epoch").agg(F.min(place).alias("stop"))
    last = known.select("epoch", "filename", F.col("next_offset").alias("offset")).groupBy(
        "epoch").agg(F.max(place).alias("last"))
    until = F.coalesce("stop", "last")
    return last.join(stops, "epoch", "left").select(
        "epoch", until["filename"].alias("filename"), until["offset"].alias("offset"))
