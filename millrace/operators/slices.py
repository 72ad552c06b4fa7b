"""Ordered computations that hold for any distribution of keys.

A plain window puts all rows of one key into one task, and a global order puts
the whole table into one. A plain window is used for keys of up to ``HOT_ROWS`` rows: it
is one shuffle. The rows of hotter keys, and those to be numbered in a global
order, are range-partitioned on key *and* order, so
a hot key covers many slices of even size. Rows equal in key and order are told
apart by the input partition they come from, so many copies of one row are cut
too. Each slice is worked on alone; what crosses a slice border is one row per
slice, which is small, and is broadcast.

The slices are written once to the shared folder: range borders come from a
sample, so two runs of the same plan need not cut at the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, has_at_most, stored

# A key with more rows than this is cut into slices. Both ways give the same result.
HOT_ROWS = 1_000_000

SLICE, ROW, TIE = "_slice", "_row", "_tie"
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def _slices(df: DataFrame, order: Sequence[str | Column], count: int | None) -> DataFrame:
    """``df`` cut into ranges of ``order``, with slice and row-in-slice numbers.

    Without a ``count`` there are ``spark.sql.shuffle.partitions`` slices, fewer
    when adaptive execution finds them small.
    """
    order = [*order, TIE]
    parts = [count, *order] if count else order
    running = (df.withColumn(TIE, F.spark_partition_id())
               .repartitionByRange(*parts).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()))
    return stored(
        running.select(
            *df.columns,
            F.shiftright("_id", _ROW_BITS).cast("int").alias(SLICE),
            F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(ROW),
        ), "slices")


def _by_heat(df: DataFrame, key: Sequence[str],
             hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of usual keys, and those of hot ones, if there are any."""
    counts = df.groupBy(*key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    names = [f"_hot_{n}" for n, _ in enumerate(key)]
    hot = stored(counts.select(*[F.col(k).alias(n) for k, n in zip(key, names)]), "hot-keys")
    if hot.isEmpty():
        return df, None
    same = F.lit(True)
    for k, n in zip(key, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    keys = F.broadcast(hot) if has_at_most(hot, BROADCAST_ROWS) else hot
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")


def _slice_order() -> WindowSpec:
    """For windows over one row per slice."""
    return W.orderBy(SLICE)


def row_index(df: DataFrame, key: Sequence[str], slices: int | None = None) -> DataFrame:
    """The key columns with ``row_index``, the row's zero-based place in key order."""
    cut = _slices(df.select(*key), key, slices)
    earlier = F.sum("rows").over(_slice_order().rowsBetween(W.unboundedPreceding, -1))
    starts = cut.groupBy(SLICE).agg(F.count("*").alias("rows")).select(
        SLICE, F.coalesce(earlier, F.lit(0)).alias("_start"))
    return cut.join(F.broadcast(starts), SLICE).select(
        *key, (F.col("_start") + F.col(ROW)).alias("row_index"))


def row_at(df: DataFrame, key: Sequence[str], n: int, slices: int | None = None) -> DataFrame:
    """The key at zero-based place ``n`` in key order. Only its slice is read again."""
    cut = _slices(df.select(*key), key, slices)
    so_far = F.sum("rows").over(_slice_order())
    found = (cut.groupBy(SLICE).agg(F.count("*").alias("rows"))
             .select(SLICE, (so_far - F.col("rows")).alias("start"), so_far.alias("end"))
             .where((F.col("start") <= n) & (F.col("end") > n)).first())
    if found is None:
        return cut.where(F.lit(False)).select(*key)
    here = (F.col(SLICE) == found[SLICE]) & (F.col(ROW) == n - found.start)
    return cut.where(here).select(*key)


def _same_key(left: str, right: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in right:
        same = same & F.col(left)[k].eqNullSafe(F.col(k))
    return same


def _rows_at(cut: DataFrame, at: Column, *columns: Column) -> DataFrame:
    """``columns`` of each slice's row with the greatest ``at``: one row per slice."""
    last = cut.groupBy(SLICE).agg(F.max(at).alias(ROW))
    return cut.join(F.broadcast(last), [SLICE, ROW]).select(SLICE, *columns)


def _carry(ends: DataFrame, value: str) -> DataFrame:
    """What each slice takes over: last key and ``value`` of the slice before it."""
    return ends.select(SLICE, F.lag("_end").over(_slice_order()).alias("_key"),
                       F.lag(value).over(_slice_order()).alias("_carried"))


def rank_in_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                name: str = "rank", slices: int | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with the row's one-based place within its key."""
    usual, hot = _by_heat(df, key, hot_rows)
    place = F.row_number().over(W.partitionBy(*key).orderBy(*order)).cast("long")
    ranked = usual.withColumn(name, place)
    return ranked if hot is None else ranked.unionByName(
        _rank_in_slices(hot, key, order, name, slices))


def _rank_in_slices(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], name: str,
                    slices: int | None) -> DataFrame:
    cut = _slices(df, [*key, *order], slices)
    # Only a slice's last key goes on in the next one.
    last_key = _rows_at(cut, F.col(ROW), F.struct(*key).alias("_end"))
    ends = (cut.join(F.broadcast(last_key), SLICE).where(_same_key("_end", key))
            .groupBy(SLICE, "_end").agg(F.count("*").alias("rows")))
    so_far = F.sum("rows").over(W.partitionBy("_end").orderBy(SLICE))
    carried = _carry(ends.withColumn("rows", so_far), "rows")
    here = F.row_number().over(W.partitionBy(SLICE, *key).orderBy(ROW))
    before = F.when(_same_key("_key", key), F.col("_carried"))
    return (cut.withColumn(name, here).join(F.broadcast(carried), SLICE)
            .withColumn(name, F.col(name) + F.coalesce(before, F.lit(0).cast("long")))
            .select(*df.columns, name))


def previous_in_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], value: str,
                    name: str = "previous", slices: int | None = None,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with a struct ``(value)`` from the key's previous row.

    The struct is null on the key's first row; inside it the value may be null.
    """
    usual, hot = _by_heat(df, key, hot_rows)
    boxed = F.struct(F.col(value).alias("value"))
    linked = usual.withColumn(name, F.lag(boxed).over(W.partitionBy(*key).orderBy(*order)))
    return linked if hot is None else linked.unionByName(
        _previous_in_slices(hot, key, order, boxed, name, slices))


def _previous_in_slices(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                        boxed: Column, name: str, slices: int | None) -> DataFrame:
    cut = _slices(df, [*key, *order], slices)
    ends = _rows_at(cut, F.col(ROW), F.struct(*key).alias("_end"), boxed.alias("box"))
    return _fill(cut, F.lag(boxed).over(W.partitionBy(SLICE, *key).orderBy(ROW)),
                 _carry(ends, "box"), key, name).select(*df.columns, name)


def latest_in_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], value: str,
                  name: str = "latest", slices: int | None = None,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with the key's last non-null ``value`` at or before each row."""
    usual, hot = _by_heat(df, key, hot_rows)
    upto = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    filled = usual.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    return filled if hot is None else filled.unionByName(
        _latest_in_slices(hot, key, order, value, name, slices))


def _latest_in_slices(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                      value: str, name: str, slices: int | None) -> DataFrame:
    cut = _slices(df, [*key, *order], slices)
    # Per slice: its last key, and the last value seen if it is of that key.
    last_key = _rows_at(cut, F.col(ROW), F.struct(*key).alias("_end"))
    last_value = _rows_at(cut, F.when(F.col(value).isNotNull(), F.col(ROW)),
                          F.struct(*key).alias("value_key"), F.col(value).alias("value"))
    own = F.when(F.col("value_key").eqNullSafe(F.col("_end")), F.col("value"))
    so_far = F.last(own, ignorenulls=True).over(W.partitionBy("_end").orderBy(SLICE))
    ends = last_key.join(F.broadcast(last_value), SLICE, "left").select(
        SLICE, "_end", so_far.alias("value"))
    within = F.last(value, ignorenulls=True).over(
        W.partitionBy(SLICE, *key).orderBy(ROW).rowsBetween(W.unboundedPreceding, 0))
    return _fill(cut, within, _carry(ends, "value"), key, name).select(*df.columns, name)


def _fill(cut: DataFrame, within: Column, carried: DataFrame, key: Sequence[str],
          name: str) -> DataFrame:
    """``within`` its slice, and where that is null what the slice took over."""
    over = F.when(_same_key("_key", key), F.col("_carried"))
    return (cut.withColumn(name, within).join(F.broadcast(carried), SLICE)
            .withColumn(name, F.coalesce(name, over)))
