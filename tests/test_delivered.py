"""Stretches of a log, dedup by them, and counts, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import stretches as st
from millrace.sinks.counts import CountTable
from millrace.sources.log import stream_log
from millrace.streaming import runs as r
from millrace.streaming.delivered import Delivered

LOG = ("db string, tbl string, op string, k long, epoch int, filename string, offset long, "
       "seq int, next_offset long")


def row(file, n, k=0, seq=0, epoch=0, size=10):
    """Event n of a file; events follow each other every ten offsets."""
    return ("d", "t", "U", k, epoch, f"bin.{file:06d}", 4 + 10 * n, seq, 4 + 10 * n + size)


def brute_stretches(rows):
    found = {}
    for place in sorted({(x[4], x[5], x[6], x[8]) for x in rows}):
        have = found.setdefault(place[:2], [])
        if have and place[2] <= have[-1][1]:
            have[-1][1] = max(have[-1][1], place[3])
        else:
            have.append([place[2], place[3]])
    return sorted((*key, *each) for key, have in found.items() for each in have)


@pytest.mark.parametrize("part", [1 << 24, 16, 3])
def test_stretches_and_what_is_outside(spark, monkeypatch, part):
    monkeypatch.setattr(st, "PART_OFFSETS", part)
    rng = random.Random(part)
    rows = [row(rng.randrange(3), rng.randrange(40), epoch=rng.randrange(2),
                size=rng.choice([10, 10, 10, 7, 25])) for _ in range(90)]
    table = spark.createDataFrame(rows, LOG)
    known = st.stretches(table)
    assert sorted(map(tuple, known.collect())) == brute_stretches(rows)
    more = [row(f, n, k=1, epoch=e) for f in range(4) for n in range(45) for e in (0, 1)]
    inside = brute_stretches(rows)
    want = sorted(x for x in more if not any(
        (s[0], s[1]) == (x[4], x[5]) and s[2] <= x[6] < s[3] for s in inside))
    other = spark.createDataFrame(more, LOG)
    for limits in ({}, {"file_stretches": 0}, {"broadcast_rows": 0}):
        assert sorted(map(tuple, st.outside(other, known, **limits).collect())) == want
    nothing = known.limit(0)
    assert st.outside(other, nothing).count() == len(more)


def test_gaps(spark):
    rows = [row(1, n) for n in (0, 1, 2, 5, 6)] + [row(2, n) for n in range(1, 4)]
    rows += [row(6, 0), row(7, 0), row(9, 0), row(2, 0, epoch=1)]
    known = st.stretches(spark.createDataFrame(rows, LOG))
    assert sorted(map(tuple, st.gaps(known).collect())) == [
        (0, "files", "bin.000002", 3, 5), (0, "files", "bin.000007", 8, 8),
        (0, "offsets", "bin.000001", 34, 53), (0, "offsets", "bin.000002", 4, 13)]
    until = st.complete_until(known).orderBy("epoch").collect()
    assert [tuple(x) for x in until] == [(0, "bin.000001", 34), (1, "bin.000002", 14)]
    whole = st.stretches(spark.createDataFrame([row(1, n) for n in range(5)], LOG))
    assert st.gaps(whole).count() == 0
    assert [tuple(x) for x in st.complete_until(whole).collect()] == [(0, "bin.000001", 54)]


def test_each_delta_once_in_any_order_of_batches(spark, tmp_path):
    """Events of several rows, delivered several times, late and again; the state stays small."""
    rng = random.Random(5)
    events = [[row(f, n, k, s) for s, k in enumerate(range(rng.randrange(1, 4)))]
              for f in (1, 2) for n in range(30)]
    delivered, got = Delivered(spark, f"{tmp_path}/state"), {}

    def keep(batch, batch_id):
        got[batch_id] = sorted(map(tuple, batch.collect()))

    process = delivered.once(keep, ["k"])
    for batch_id in range(5):
        some = rng.sample(events, 25)
        rows = [x for event in some + some[:5] for x in event]
        batch = spark.createDataFrame(rows, LOG)
        process(batch, batch_id)
        first = got[batch_id]
        if batch_id % 2:
            process(batch, batch_id)  # the same batch again, after it was counted
            assert got[batch_id] == first
    process(spark.createDataFrame([x for event in events for x in event], LOG), 5)
    assert sorted(x for rows in got.values() for x in rows) == sorted(
        x for event in events for x in event)
    assert delivered.stretches().count() == 2


def test_state_rows_grow_with_gaps_and_not_with_deltas(spark, tmp_path):
    delivered = Delivered(spark, f"{tmp_path}/state")
    log = spark.range(200_000).select(
        F.lit("d").alias("db"), F.lit("t").alias("tbl"), F.lit("U").alias("op"),
        F.col("id").alias("k"), F.lit(0).alias("epoch"), F.lit("bin.000001").alias("filename"),
        (4 + 10 * F.col("id")).alias("offset"), F.lit(0).alias("seq"),
        (14 + 10 * F.col("id")).alias("next_offset"))
    delivered.note(log.where("k % 1000 <> 0"), "a")
    assert delivered.stretches().count() == 200
    delivered.note(log.where("k % 1000 = 0"), "b")
    assert [tuple(x) for x in delivered.stretches().collect()] == [(0, "bin.000001", 4, 2_000_004)]


def test_parts_of_a_backfill_come_once(spark, tmp_path):
    delivered = Delivered(spark, f"{tmp_path}/state")
    assert delivered.part("e0-0")
    delivered.end_part("e0-0")
    assert not delivered.part("e0-0") and delivered.part("e0-1")


def test_counts_of_batches_that_come_again(spark, tmp_path):
    log = spark.createDataFrame([row(1, n, k=n) for n in range(50)], LOG).repartition(5)
    log.write.parquet(f"{tmp_path}/log")
    counts = CountTable(spark, f"{tmp_path}/counts")
    assert counts.by_op().count() == 0
    for attempt in range(2):
        stream = stream_log(spark, f"{tmp_path}/log", log.schema, files_per_batch=2)
        r.run(stream, [counts.add], f"{tmp_path}/checkpoint-{attempt}")
    assert [tuple(x) for x in counts.by_op().collect()] == [("d", "t", "U", 50)]
    assert [tuple(x) for x in counts.high_water().collect()] == [
        ("d", "t", 0, "bin.000001", 494)]
