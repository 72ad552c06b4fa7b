"""Images over the batches of a log, and reading a log from a position on."""

from __future__ import annotations

import random

import pytest

from millrace import connect as c
from millrace.functions.position import after_position
from millrace.operators import merge as g
from millrace.operators.deltas import backfill_deltas
from millrace.plans.inputs import ACCOUNT
from millrace.sinks.state import StateTable
from millrace.sources.log import land_log, log_after, read_log, stream_log
from millrace.streaming import runs as r
from millrace.streaming.continuity import Continuity
from tests.test_merge import SCHEMA, _history, delta, expected, rows_of
from tests.test_streams import _specification


def _log(seed, n=120):
    """Deltas in order whose images mostly follow from each other, one hot key among them."""
    rng, last, log = random.Random(seed), {}, []
    for at in range(n):
        k = 0 if rng.random() < 0.4 else rng.randrange(12)
        op = rng.choice("IUUD")
        before = last.get(k) if rng.random() < 0.8 else (k, -5.0, "?")
        log.append(delta(op, k, at % 40, before=before, file=1 + at // 40))
        last[k] = log[-1][5]
    return log


def _brute_breaks(log):
    last, found = {}, []
    for d in sorted(log, key=lambda d: (d[6], d[7], d[8], d[9])):
        if d[3] in last and d[4] != last[d[3]]:
            found.append((d[3], d[2], d[4], last[d[3]], d[6], d[7], d[8], d[9]))
        last[d[3]] = d[5]
    return sorted(found, key=lambda row: row[4:])


def _found(rows):
    return sorted((tuple(None if v is None else tuple(v) if isinstance(v, tuple) else v
                         for v in row) for row in rows.collect()), key=lambda row: row[4:])


@pytest.mark.parametrize("cuts, compact", [((120,), False), ((7, 40, 41, 90), True)])
def test_breaks_over_batches_are_those_of_the_log(spark, tmp_path, cuts, compact):
    log = _log(len(cuts))
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=3)
    state.apply(backfill_deltas(spark.createDataFrame(
        [(k, 0.5, "backfill") for k in range(12)], ACCOUNT.schema), ACCOUNT, 0), "backfill")
    continuity = Continuity(state)
    assert continuity.breaks().isEmpty() and continuity.late().isEmpty()
    for n, (first, end) in enumerate(zip((0, *cuts), (*cuts, len(log)))):
        batch = spark.createDataFrame(log[first:end], SCHEMA).repartition(3)
        for attempt in range(2):
            continuity.judge(batch, str(n))
            state.apply(batch, n)
        if compact and n == 1:
            state.compact()
    want = _brute_breaks(log)
    assert want and _found(continuity.breaks()) == want
    whole = g.image_breaks(spark.createDataFrame(log, SCHEMA), ["k"])
    assert whole.count() == len(want)
    assert continuity.late().isEmpty()


def test_late_rows_and_copies(spark, tmp_path):
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=2)
    continuity = Continuity(state)

    def add(name, *rows):
        batch = spark.createDataFrame(rows, SCHEMA)
        continuity.judge(batch, name)
        state.apply(batch, name)

    first = delta("I", 1, 5, after=(1, 5.0, "a"))
    add("a", first, delta("I", 2, 5, after=(2, 5.0, "a")))
    # A copy is not judged, and what follows it is compared with the stored image.
    add("b", first, delta("U", 1, 6, before=(1, 0.0, "?"), after=(1, 6.0, "a")),
        delta("U", 2, 3, before=(2, 9.0, "?"), after=(2, 3.0, "a")),
        delta("U", 2, 7, before=(2, 5.0, "a"), after=(2, 7.0, "a")))
    assert [(b.k, b.offset, b.expected.v) for b in continuity.breaks().collect()] == [(1, 604, 5.0)]
    assert [(x.k, x.offset) for x in continuity.late().collect()] == [(2, 304)]


def test_images_are_checked_in_a_run(spark, tmp_path):
    log = [delta("U", 1, 1, before=(1, 7.0, "older"), after=(1, 1.0, "a")),
           delta("U", 1, 2, before=(1, 1.0, "a"), after=(2, 2.0, "a")),
           delta("D", 2, 3, before=(2, 3.0, "?"))]
    spark.createDataFrame([(1, 0.0, "x")], ACCOUNT.schema).write.parquet(f"{tmp_path}/rows")
    specification = _specification(tmp_path, key=["k"])
    specification["exporters"]["now"]["check_images"] = True
    for rows in (log[:1], log[1:]):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{tmp_path}/log")
        sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
    # The backfill's image is not compared; the row that got another key goes on under it.
    found = sinks["now"].continuity(ACCOUNT).breaks().collect()
    assert [(b.k, b.offset, tuple(b.expected)) for b in found] == [(2, 304, (2, 2.0, "a"))]


# --- from a position on -------------------------------------------------------------------


def _spoil(folder):
    """Make a folder's files unreadable."""
    files = list(folder.glob("*.parquet"))
    for file in files:
        file.write_bytes(b"not parquet")
    return files


def test_older_files_are_not_opened(spark, tmp_path):
    log = [delta("U", k, n, file=file, epoch=epoch)
           for epoch, file in ((0, 8), (0, 999_999), (0, 1_000_000), (1, 1)) for n in range(4)
           for k in range(2)]
    path = f"{tmp_path}/log"
    land_log(spark.createDataFrame(log, SCHEMA), path)
    start = (0, "bin.999999", 104)
    want = sorted(d[6:10] + (d[3],) for d in log
                  if (d[6], len(d[7]), d[7], d[8]) > (0, 10, "bin.999999", 104))
    assert _spoil(tmp_path / "log" / "epoch=0" / "filename=bin.000008")

    def places(rows):
        return sorted((x.epoch, x.filename, x.offset, x.seq, x.k) for x in rows.collect())

    at_rest = log_after(read_log(spark, path, SCHEMA), *start)
    assert at_rest.columns == SCHEMA.fieldNames() and places(at_rest) == want
    assert "PartitionFilters: [" in at_rest._jdf.queryExecution().executedPlan().toString()
    r.write_stream(log_after(stream_log(spark, path, SCHEMA), *start), f"{tmp_path}/out",
                   f"{tmp_path}/checkpoint")
    assert places(spark.read.parquet(f"{tmp_path}/out")) == want
    with pytest.raises(Exception):
        read_log(spark, path, SCHEMA).collect()


def test_in_one_folder_the_same_rows_are_behind(spark, tmp_path):
    rows = [delta("U", n, n, file=file) for file in (1, 2, 3) for n in range(3)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/log")
    log = read_log(spark, f"{tmp_path}/log", SCHEMA)
    for start in ((0, "", 0), (0, "bin.000002", 104), (0, "bin.000003", 204), (1, "", 0)):
        assert rows_of(log_after(log, *start)) == rows_of(log.where(after_position(*start)))
    text = log_after(log, *start)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(epoch" in text.split("PushedFilters: ")[1]


def test_high_water_of_a_state(spark, tmp_path):
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=2)
    assert state.high_water() is None
    state.apply(spark.createDataFrame([delta("I", 9, 0, file=0)], SCHEMA), "backfill")
    assert state.high_water() is None
    state.apply(spark.createDataFrame(
        [delta("U", 1, 3, file=1_000_000), delta("D", 2, 9, file=999_999)], SCHEMA), 0)
    assert state.high_water() == (0, "bin.1000000", 304)
    state.compact()
    assert state.high_water() == (0, "bin.1000000", 304)
    state.apply(spark.createDataFrame([delta("U", 1, 1, epoch=1)], SCHEMA), 1)
    assert state.high_water() == (1, "bin.000001", 104)


def test_a_run_without_its_checkpoint_starts_at_the_position(spark, tmp_path):
    log, backfill = _history(23)
    spark.createDataFrame([d[5] for d in backfill], ACCOUNT.schema).write.parquet(
        f"{tmp_path}/rows")
    land_log(spark.createDataFrame(log[:90], SCHEMA), f"{tmp_path}/log")
    specification = _specification(tmp_path, key=["k"])
    sinks = c.run(spark, specification, f"{tmp_path}/checkpoints")
    last = sinks["now"].state(ACCOUNT).high_water()
    assert last == log[89][6:9]
    land_log(spark.createDataFrame(log[90:], SCHEMA), f"{tmp_path}/log")
    specification["importers"]["shop"]["start"] = list(last)
    sinks = c.run(spark, specification, f"{tmp_path}/other-checkpoints")
    assert rows_of(sinks["now"].state(ACCOUNT).rows()) == expected(log + backfill)
    batches = spark.read.parquet(sinks["all"].path(ACCOUNT))
    assert batches.count() == len(backfill) + sum(d[2] != "D" for d in log)
