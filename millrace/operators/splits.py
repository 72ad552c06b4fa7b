"""Cutting a table into primary-key ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import tuple_ge, tuple_lt
from .selection import keys_at
from .slices import row_index

# The states of a split.
NOT_STARTED, RUNNING, DONE = "NOT_STARTED", "RUNNING", "DONE"


def split_assignment(df: DataFrame, key: Sequence[str], batch_size: int) -> DataFrame:
    """Each key with its ``row_index`` and the ``split_id`` of the range it is in."""
    if not key:
        raise ValueError("a table without a primary key is one unbounded split")
    return row_index(df, key).withColumn(
        "split_id", F.expr(f"row_index div {int(batch_size)}"))


def split_points(assigned: DataFrame, key: Sequence[str], batch_size: int) -> DataFrame:
    """The first key of every split but the first: rows b, 2b, .. in key order."""
    at_border = (F.col("row_index") % batch_size == 0) & (F.col("row_index") > 0)
    return assigned.where(at_border).select("split_id", *key)


def nth_key(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """The key at zero-based place ``n`` in key order; its columns must not be null."""
    return keys_at(df, key, [n]).select(*key)


def split_ranges(points: DataFrame, key: Sequence[str]) -> DataFrame:
    """Half-open ranges ``[lo, hi)`` from the split points; null is unbounded.

    A point closes one range and opens the next. Each range gathers its two ends
    by id, so the number of points may be large.
    """
    point = F.struct(*key)
    # Keeps the first range when there are no points at all.
    first = points.sparkSession.range(1).select(F.lit(0).cast("long").alias("split_id"))
    ends = points.select(F.explode(F.array(
        F.struct("split_id", point.alias("lo"),
                 F.when(F.lit(False), point).alias("hi")),
        F.struct((F.col("split_id") - 1).alias("split_id"),
                 F.when(F.lit(False), point).alias("lo"), point.alias("hi")),
    )).alias("end")).select("end.*")
    return (
        ends.unionByName(first, allowMissingColumns=True)
        .groupBy("split_id")
        .agg(F.first("lo", ignorenulls=True).alias("lo"),
             F.first("hi", ignorenulls=True).alias("hi"))
    )


def split_kind(lo: Column, hi: Column) -> Column:
    return (F.when(lo.isNull() & hi.isNull(), "all").when(lo.isNull(), "initial")
            .when(hi.isNull(), "final").otherwise("middle"))


def split_counts(assigned: DataFrame, key: Sequence[str]) -> DataFrame:
    first, last = F.min(F.struct(*key)), F.max(F.struct(*key))
    return assigned.groupBy("split_id").agg(F.count("*").alias("rows"), first.alias("first"),
                                            last.alias("last"))


def split_progress(assigned: DataFrame, loaded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Planned and loaded rows of each split, and the state that follows.

    ``loaded`` holds one row per loaded key.
    """
    found = loaded.select(*key, F.lit(1).alias("found"))
    counts = assigned.join(found, list(key), "left").groupBy("split_id").agg(
        F.count("*").alias("planned"), F.count("found").alias("loaded"))
    state = (F.when(F.col("loaded") == 0, NOT_STARTED)
             .when(F.col("loaded") < F.col("planned"), RUNNING).otherwise(DONE))
    return counts.withColumn("state", state)


def in_range(key: Sequence[str], lo: Sequence | None, hi: Sequence | None) -> Column:
    """Whether the key is in ``[lo, hi)``; None is unbounded."""
    inside = F.lit(True)
    if lo is not None:
        inside = inside & tuple_ge(key, lo)
    if hi is not None:
        inside = inside & tuple_lt(key, hi)
    return inside


def scan_split(df: DataFrame, key: Sequence[str], lo: Sequence | None = None,
               hi: Sequence | None = None) -> DataFrame:
    """The rows of one split. No bound gives the whole table."""
    return df if lo is None and hi is None else df.where(in_range(key, lo, hi))
