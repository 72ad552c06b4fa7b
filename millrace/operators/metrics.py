"""Counting and monitoring deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.position import delta_order, phase
from ..functions.text import table_id


def count_by_phase(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("db", "tbl", phase(F.col("offset")).alias("phase")).count()


def batch_hits(counts: DataFrame, batch_size: int) -> DataFrame:
    """How often each counter, started again at ``batch_size``, was full.

    The counter is ``db.table-phase``; after n deltas it was reset
    ``(n - 1) div batch_size`` times.
    """
    key = F.concat(table_id(F.col("db"), F.col("tbl")), F.lit("-"), F.col("phase"))
    return counts.select(
        key.alias("counter"),
        F.expr(f"(count - 1) div {int(batch_size)}").alias("hits"),
        ((F.col("count") - 1) % batch_size + 1).alias("value"),
    )


def count_by_op(deltas: DataFrame) -> DataFrame:
    ops = {"I": "inserts", "U": "updates", "D": "deletes"}
    return deltas.groupBy("db", "tbl").agg(
        *[F.count_if(F.col("op") == op).alias(name) for op, name in ops.items()])


def high_water(deltas: DataFrame) -> DataFrame:
    """The greatest position seen of each table."""
    at = F.struct("epoch", "filename", "offset", "seq")
    return deltas.groupBy("db", "tbl").agg(F.max_by(at, delta_order()).alias("at")).select(
        "db", "tbl", "at.*")
