"""Latest delta per key and what follows from it.

The delta with the greatest position wins, whatever the order and however often
the deltas arrive. ``max_by`` reduces each key before the shuffle, so a hot key
sends one row per task. Deletes stay in as tombstones: a backfill row that comes
late must not bring a deleted key back.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.position import delta_columns, delta_order
from ..model import DELETE, UPDATE
from .slices import previous_in_key

STATE = ("op", "after", "epoch", "filename", "offset", "seq")


def latest_delta(deltas: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key, ``op``, ``after`` and position of each key's last delta."""
    newest = F.max_by(F.struct(*STATE), delta_order())
    return deltas.groupBy(*key).agg(newest.alias("_newest")).select(*key, "_newest.*")


def live_rows(latest: DataFrame) -> DataFrame:
    """The after-images of the keys that are not deleted."""
    return latest.where(F.col("op") != DELETE).select("after.*")


def current_state(deltas: DataFrame, key: Sequence[str]) -> DataFrame:
    return live_rows(latest_delta(deltas, key))


def tombstones(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("op") == DELETE)


def of_epochs_from(deltas: DataFrame, epoch: int) -> DataFrame:
    """The deltas of ``epoch`` and those after it: what is left when the ones before are over."""
    return deltas.where(F.col("epoch") >= epoch)


def merge_latest(state: DataFrame, newer: DataFrame, key: Sequence[str]) -> DataFrame:
    """Two sets of latest deltas as one; each side has one row per key.

    A full join and not an aggregate, so a state stored in buckets of the key is
    read in place and only ``newer`` is shuffled.
    """
    theirs = newer.select(*key, F.struct(*STATE).alias("_b"), delta_order().alias("_b_order"))
    mine = state.select(*key, F.struct(*STATE).alias("_a"), delta_order().alias("_a_order"))
    take_b = F.col("_a").isNull() | (F.col("_b_order") > F.col("_a_order"))
    chosen = F.when(F.coalesce(take_b, F.lit(False)), F.col("_b")).otherwise(F.col("_a"))
    both = mine.join(theirs, list(key), "full")
    return both.select(*key, chosen.alias("_chosen")).select(*key, "_chosen.*")


def split_key_updates(deltas: DataFrame, key: Sequence[str]) -> DataFrame:
    """Updates that change the key as a delete of the old key and an insert of the new.

    Both keep the position. ``seq`` is doubled so that the delete sorts first.
    """
    moved = reduce(
        lambda a, b: a | b, [~F.col("before")[k].eqNullSafe(F.col("after")[k]) for k in key])
    moved = (F.col("op") == UPDATE) & F.col("before").isNotNull() & moved
    no_row = F.when(F.lit(False), F.col("after"))
    keep = F.struct(*[F.col(k).alias(k) for k in key], "op", "before", "after",
                    (F.col("seq") * 2).alias("seq"))
    old = F.struct(*[F.col("before")[k].alias(k) for k in key], F.lit(DELETE).alias("op"),
                   "before", no_row.alias("after"), (F.col("seq") * 2).alias("seq"))
    new = F.struct(*[F.col("after")[k].alias(k) for k in key], F.lit("I").alias("op"),
                   F.when(F.lit(False), F.col("before")).alias("before"), "after",
                   (F.col("seq") * 2 + 1).alias("seq"))
    replaced = {*key, "op", "before", "after", "seq"}
    rest = [c for c in deltas.columns if c not in replaced]
    return deltas.select(
        *rest, F.explode(F.when(moved, F.array(old, new)).otherwise(F.array(keep))).alias("_d")
    ).select(*rest, "_d.*")


def _changed(field: str) -> Column:
    return F.when(
        ~F.col("before")[field].eqNullSafe(F.col("after")[field]),
        F.struct(F.lit(field).alias("column_name"),
                 F.col("before")[field].cast("string").alias("old_value"),
                 F.col("after")[field].cast("string").alias("new_value")))


def changed_columns(deltas: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per column that an update changed, with the old and the new value."""
    both = deltas.where(F.col("before").isNotNull() & F.col("after").isNotNull())
    changes = F.array_compact(F.array(*[_changed(f) for f in fields]))
    rest = [c for c in deltas.columns if c not in ("before", "after")]
    return both.select(*rest, F.explode(changes).alias("_change")).select(
        *rest, "_change.*")


def image_breaks(deltas: DataFrame, key: Sequence[str]) -> DataFrame:
    """Deltas whose ``before`` is not the ``after`` of the key's previous delta."""
    linked = previous_in_key(deltas, key, delta_columns(), "after")
    expected = F.col("previous.value")
    broken = F.col("previous").isNotNull() & ~F.col("before").eqNullSafe(expected)
    return linked.where(broken).withColumn("expected", expected).drop("previous")
