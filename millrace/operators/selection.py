"""Keys at given places of the key order, without sorting or shuffling the keys.

A sample of bounded size tells about where a place is: between two keys whose exact places one
count over the table gives. The rows between them are a small part, of which the same is done
until they are few enough to be sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from math import ceil, floor, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import tuple_ge, tuple_lt

# Rows of a sample, which come to the driver, and rows that are sorted at the end.
SAMPLE, FEW = 20_000, 100_000


@dataclass(frozen=True)
class Bracket:
    """Where a place is: among the keys from ``lo`` to ``hi``; None is unbounded.

    ``after_lo`` and ``before_hi`` leave these keys themselves out. ``below`` rows come before the
    bracket, which holds ``rows``.
    """

    place: int
    rows: int
    below: int = 0
    lo: tuple | None = None
    hi: tuple | None = None
    after_lo: bool = False
    before_hi: bool = False
    # Whether the last count left more than half of it.
    stuck: bool = False

    def holds(self, key: Sequence[str], bound) -> Column:
        inside = F.lit(True)
        if self.lo is not None:
            lo = bound(self.lo)
            inside = _after(key, lo) if self.after_lo else tuple_ge(key, lo)
        if self.hi is not None:
            hi = bound(self.hi)
            inside = inside & (tuple_lt(key, hi) if self.before_hi else ~_after(key, hi))
        return inside

    def single(self) -> bool:
        return self.lo is not None and self.lo == self.hi and not (self.after_lo or self.before_hi)


def _after(key: Sequence[str], bound: Sequence[Column]) -> Column:
    same = F.lit(True)
    for k, b in zip(key, bound, strict=True):
        same = same & (F.col(k) == b)
    return tuple_ge(key, bound) & ~same


def _around(bracket: Bracket, sample: list[tuple]) -> tuple[tuple, tuple]:
    """Two keys of a sorted sample of the bracket between which its place is, as a rule.

    Where a few keys are most rows, that may be all of it: then it is one key twice, which is the
    place's own or parts those before it from those after.
    """
    at = (bracket.place - bracket.below) / bracket.rows * len(sample)
    margin = 0 if bracket.stuck else 2 * sqrt(len(sample)) + 1
    last = len(sample) - 1
    lo = sample[max(0, min(last, floor(at - margin)))]
    return lo, lo if bracket.stuck else sample[max(0, min(last, ceil(at + margin)))]


def _next(bracket: Bracket, lo: tuple, hi: tuple, less: int, among: int) -> Bracket:
    """The part of a bracket that has its place: before ``lo``, up to ``hi``, or after it."""
    place = bracket.place - bracket.below
    if place < less:
        found = replace(bracket, rows=less, hi=lo, before_hi=True)
    elif place < less + among:
        found = replace(bracket, rows=among, below=bracket.below + less, lo=lo, hi=hi,
                        after_lo=False, before_hi=False)
    else:
        found = replace(bracket, rows=bracket.rows - less - among,
                        below=bracket.below + less + among, lo=hi, after_lo=True)
    return replace(found, stuck=2 * found.rows > bracket.rows)


def keys_at(df: DataFrame, key: Sequence[str], places: Sequence[int], sample: int = SAMPLE,
            few: int = FEW) -> DataFrame:
    """``place`` and the key at each zero-based place in key order; places beyond have no row.

    A few scans of the key columns for any number of rows; what moves are the samples, counts, and
    at last up to ``few`` keys for each place. Keys that many rows share are found as well. Key
    columns must not be null. For many places, as all split points, ``row_index`` needs one
    shuffle instead.
    """
    rows, schema = df.select(*key), df.select(*key).schema

    def bound(values: tuple) -> list[Column]:
        return [F.lit(v).cast(f.dataType) for v, f in zip(values, schema)]

    total = rows.count()
    open_ = [Bracket(p, total) for p in sorted(set(places)) if 0 <= p < total]
    closed: list[Bracket] = []
    while open_:
        closed += [b for b in open_ if b.single() or b.rows <= few]
        open_ = [b for b in open_ if not b.single() and b.rows > few]
        if not open_:
            break
        drawn = rows.select(*key, F.array_compact(F.array(*[
            F.when(b.holds(key, bound) & (F.rand(n) < sample / b.rows), F.lit(n))
            for n, b in enumerate(open_)])).alias("of")).where(F.size("of") > 0)
        found: list[list[tuple]] = [[] for _ in open_]
        for row in drawn.select(*key, F.explode("of").alias("of")).orderBy(*key).collect():
            found[row[-1]].append(tuple(row)[:-1])
        # A bracket without a sample, which hardly happens, is sampled again.
        around = [_around(b, s) if s else None for b, s in zip(open_, found)]
        counted = rows.agg(*[
            F.count_if(b.holds(key, bound) & test)
            for b, ends in zip(open_, around) if ends
            for test in (tuple_lt(key, bound(ends[0])),
                         tuple_ge(key, bound(ends[0])) & ~_after(key, bound(ends[1])))
        ] or [F.count("*")]).first()
        counts = iter(counted)
        open_ = [b if ends is None else _next(b, *ends, next(counts), next(counts))
                 for b, ends in zip(open_, around)]
    return _sorted_keys(rows, key, closed, bound)


def _sorted_keys(rows: DataFrame, key: Sequence[str], brackets: list[Bracket],
                 bound) -> DataFrame:
    """The keys at the places of brackets that are few rows, or one key."""
    spark = rows.sparkSession
    out = rows.select(F.lit(0).cast("long").alias("place"), *key).limit(0)
    for b in brackets:
        if b.single():
            out = out.unionByName(spark.range(1).select(
                F.lit(b.place).cast("long").alias("place"),
                *[v.alias(k) for v, k in zip(bound(b.lo), key)]))
    small = [b for b in brackets if not b.single()]
    if not small:
        return out
    within = F.array_compact(F.array(*[F.when(b.holds(key, bound), F.struct(
        F.lit(b.place).cast("long").alias("place"),
        F.lit(b.place - b.below).cast("long").alias("at"))) for b in small]))
    order = W.partitionBy("of.place").orderBy(*key)
    picked = (rows.select(*key, within.alias("of")).where(F.size("of") > 0)
              .select(*key, F.explode("of").alias("of"))
              .withColumn("n", F.row_number().over(order) - 1).where("n = of.at")
              .select("of.place", *key))
    return out.unionByName(picked)
