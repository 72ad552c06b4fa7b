"""The merge gives one result for any order, repetition and batching of the deltas."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.connect import log_schema
from millrace.operators import merge as g
from millrace.operators.deltas import backfill_deltas, without_repeats
from millrace.operators.slices import rank_in_key, row_index
from millrace.plans.inputs import ACCOUNT
from millrace.sinks.state import StateTable
from millrace.model import TableSpec

KEY = ["k"]
SCHEMA = log_schema(ACCOUNT)


def delta(op, k, n, before=None, after=None, file=1, epoch=0, seq=0):
    """A delta at offset n of a log file; file 0 is the backfill."""
    filename = f"bin.{file:06d}" if file else ""
    return ("shop", "account", op, k, before, None if op == "D" else after or (k, float(n), op),
            epoch, filename, 100 * n + 4 if file else 0, seq)


def expected(deltas):
    """Brute force: the last delta of each key, unless it is a delete."""
    last = {}
    for d in sorted(deltas, key=lambda d: (d[6], d[7], d[8], d[9])):
        last[d[3]] = d
    return sorted(d[5] for d in last.values() if d[2] != "D")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


OPS = st.lists(st.tuples(st.sampled_from("IUD"), st.integers(0, 4), st.integers(0, 2)),
               min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(OPS, st.randoms(use_true_random=False))
def test_any_order_and_repetition(spark, ops, rng):
    deltas = [delta(op, k, n, file=file + 1) for n, (op, k, file) in enumerate(ops)]
    deltas += [delta("I", k, 0, after=(k, -1.0, "backfill"), file=0) for k in range(5)]
    mixed = deltas + rng.sample(deltas, len(deltas) // 2)
    rng.shuffle(mixed)
    df = spark.createDataFrame(mixed, SCHEMA)
    assert rows_of(g.current_state(df, KEY)) == expected(deltas)
    half = len(mixed) // 2
    merged = g.merge_latest(
        g.latest_delta(spark.createDataFrame(mixed[:half], SCHEMA), KEY),
        g.latest_delta(spark.createDataFrame(mixed[half:], SCHEMA), KEY), KEY)
    assert rows_of(g.live_rows(merged)) == expected(deltas)


def test_late_backfill_does_not_bring_a_row_back(spark):
    log = spark.createDataFrame([delta("D", 1, 5), delta("U", 2, 6)], SCHEMA)
    late = spark.createDataFrame([delta("I", k, 0, file=0) for k in (1, 2, 3)], SCHEMA)
    merged = g.merge_latest(g.latest_delta(log, KEY), g.latest_delta(late, KEY), KEY)
    assert [r.k for r in g.live_rows(merged).orderBy("k").collect()] == [2, 3]
    assert [r.k for r in g.tombstones(merged).collect()] == [1]


def test_several_rows_at_one_position(spark):
    rows = [delta("U", 1, 5, after=(1, v, "s"), seq=q) for q, v in ((0, 1.0), (2, 3.0), (1, 2.0))]
    assert rows_of(g.current_state(spark.createDataFrame(rows, SCHEMA), KEY)) == [(1, 3.0, "s")]


def test_a_new_epochs_backfill_outranks_the_old_log(spark):
    rows = [delta("U", 1, 50), delta("U", 2, 51), delta("I", 1, 0, file=0, epoch=1)]
    latest = g.latest_delta(spark.createDataFrame(rows, SCHEMA), KEY)
    assert {r.k: r.epoch for r in latest.collect()} == {1: 1, 2: 0}
    assert [r.k for r in g.of_epochs_from(latest, 1).collect()] == [1]


def test_key_change(spark):
    moved = delta("U", 1, 5, before=(1, 1.0, "a"), after=(9, 2.0, "b"), seq=1)
    kept = delta("U", 2, 6, before=(2, 1.0, "a"), after=(2, 2.0, "b"))
    rows = [delta("I", k, 0, file=0) for k in (1, 2, 9)] + [moved, kept]
    split = g.split_key_updates(spark.createDataFrame(rows, SCHEMA), KEY)
    assert rows_of(g.current_state(split, KEY)) == [(2, 2.0, "b"), (9, 2.0, "b")]
    found = {(r.op, r.k, r.seq) for r in split.where("offset = 504").collect()}
    assert found == {("D", 1, 2), ("I", 9, 3)}


def test_key_swap_at_one_position(spark):
    # One statement exchanges two keys; the later row's delete must not win.
    rows = [delta("U", 1, 5, before=(1, 1.0, "a"), after=(3, 1.0, "a"), seq=0),
            delta("U", 2, 5, before=(2, 2.0, "b"), after=(1, 2.0, "b"), seq=1)]
    split = g.split_key_updates(spark.createDataFrame(rows, SCHEMA), KEY)
    assert rows_of(g.current_state(split, KEY)) == [(1, 2.0, "b"), (3, 1.0, "a")]


@pytest.mark.parametrize("names", [("a", "b"), ("key", "start"), ("rows", "newest")])
def test_composite_key(spark, tmp_path, names):
    first, second = names
    data = [(1, "x", 1), (1, "y", 2), (2, "x", 3)]
    rows = spark.createDataFrame(data, f"{first} long, {second} string, v long")
    table = TableSpec("d", "t", rows.schema, names)
    deltas = backfill_deltas(rows, table, 0)
    assert rows_of(g.current_state(deltas, table.key)) == data
    state = StateTable(spark, f"{tmp_path}/state", table, buckets=2)
    for batch_id in range(2):
        state.apply(deltas, batch_id)
        state.compact()
    state.apply(deltas, 2)
    assert rows_of(state.rows()) == data
    assert g.image_breaks(deltas, table.key).count() == 0
    assert row_index(rows, names).count() == rank_in_key(rows, names, ["v"]).count() == 3


def test_repeats_are_removed_but_not_neighbours(spark):
    rows = [delta("U", 1, 5, seq=q) for q in (0, 1)] * 3
    assert without_repeats(spark.createDataFrame(rows, SCHEMA), ["k"]).count() == 2
    backfill = [delta("I", k, 0) for k in range(20)] * 2
    assert without_repeats(spark.createDataFrame(backfill, SCHEMA), ["k"]).count() == 20
    with pytest.raises(ValueError, match="keyless"):
        without_repeats(spark.createDataFrame(rows, SCHEMA), [])


def test_changed_columns(spark):
    rows = [delta("U", 1, 5, before=(1, 1.0, None), after=(1, 1.0, "b")),
            delta("U", 1, 6, before=(1, 1.0, None), after=(1, 2.0, None)),
            delta("I", 2, 7), delta("D", 2, 8, before=(2, 1.0, "x"))]
    found = g.changed_columns(spark.createDataFrame(rows, SCHEMA), ["k", "v", "s"])
    assert {(r.column_name, r.old_value, r.new_value) for r in found.collect()} == {
        ("s", None, "b"), ("v", "1.0", "2.0")}


def test_image_breaks(spark):
    rows = [delta("I", 1, 1, after=(1, 1.0, "a")),
            delta("U", 1, 2, before=(1, 1.0, "a"), after=(1, 2.0, "a")),
            delta("U", 1, 3, before=(1, 9.0, "a"), after=(1, 3.0, "a")),
            delta("D", 1, 4, before=(1, 3.0, "a")),
            delta("I", 1, 5, after=(1, 5.0, "a")),
            delta("I", 1, 6, after=(1, 6.0, "a")),
            delta("U", 2, 9, before=(2, 1.0, "?"))]
    found = g.image_breaks(spark.createDataFrame(rows, SCHEMA).repartition(3), KEY)
    assert sorted(r.offset for r in found.collect()) == [304, 604]


# --- stored state ----------------------------------------------------------------


def _history(seed):
    rng = random.Random(seed)
    log = [delta(rng.choice("IUUD"), 0 if rng.random() < 0.4 else rng.randrange(30), n)
           for n in range(200)]
    return log, [delta("I", k, 0, after=(k, -1.0, "backfill"), file=0) for k in range(40)]


@pytest.mark.parametrize("compact_after", [set(), {0}, {1, 3}])
def test_state_in_any_batching(spark, tmp_path, compact_after):
    log, backfill = _history(11)
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=3)
    assert state.rows().count() == 0
    random.Random(5).shuffle(log)
    batches = [log[n::4] for n in (2, 0, 3, 1)] + [backfill]
    for number, batch in enumerate(batches):
        state.apply(spark.createDataFrame(batch, SCHEMA), number)
        if number in compact_after:
            state.compact()
    state.apply(spark.createDataFrame(batches[1], SCHEMA), 1)  # delivered again
    state.apply(spark.createDataFrame(backfill, SCHEMA), 7, reduce=False)
    assert rows_of(state.rows()) == expected(log + backfill)
    state.compact()
    assert rows_of(state.rows()) == expected(log + backfill)
    gone = {d[3] for d in backfill} - {r[0] for r in expected(log + backfill)}
    assert {r.k for r in state.deleted().collect()} == gone


def test_state_is_found_again(spark, tmp_path):
    log, backfill = _history(12)
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=3)
    state.apply(spark.createDataFrame(backfill, SCHEMA), 0)
    state.compact()
    for table in spark.catalog.listTables():
        if table.name.startswith("state_"):
            spark.sql(f"DROP TABLE {table.name}")
    again = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=99)
    again.apply(spark.createDataFrame(log, SCHEMA), 1)
    assert rows_of(again.rows()) == expected(log + backfill)


def test_unfinished_base_is_not_read(spark, tmp_path):
    log, backfill = _history(13)
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=3)
    state.apply(spark.createDataFrame(backfill, SCHEMA), 0)
    # A base that was being written when the job died: files, but no version row.
    spark.range(5).write.parquet(f"{tmp_path}/state/base/v=1-dead")
    state.compact()
    state.apply(spark.createDataFrame(log, SCHEMA), 1)
    assert rows_of(state.rows()) == expected(log + backfill)


def test_merge_reads_the_stored_base_in_place(spark, tmp_path):
    log, backfill = _history(14)
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=4)
    state.apply(spark.createDataFrame(backfill, SCHEMA), 0)
    state.compact()
    state.apply(spark.createDataFrame(log, SCHEMA), 1)
    plan = state.latest()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert plan.count("Exchange") == 1  # of the batch only
    for _ in range(2):
        assert len(spark.read.parquet(state._newest().folder).inputFiles()) <= 4
        state.compact()


def test_state_needs_a_key(spark, tmp_path):
    with pytest.raises(ValueError):
        StateTable(spark, str(tmp_path), TableSpec("d", "t", ACCOUNT.schema))
    with pytest.raises(ValueError):
        TableSpec("d", "t", ACCOUNT.schema, ("nope",))
    with pytest.raises(ValueError):
        TableSpec("d", "t", spark.range(0).withColumnRenamed("id", "offset").schema, ("offset",))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = g.latest_delta(spark.createDataFrame([delta("I", 1, 1)], SCHEMA), KEY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning")
    assert plan.select(F.count("*")).first()[0] == 1


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.randoms(use_true_random=False))
def test_the_fence_closes_older_epochs_for_good(spark, tmp_path_factory, rng):
    """Deltas of three epochs in any order; fences and compactions between them."""
    deltas = [delta(rng.choice("IUD"), rng.randrange(6), n, file=rng.randrange(3),
                    epoch=rng.randrange(3), seq=n) for n in range(rng.randrange(1, 25))]
    state = StateTable(spark, str(tmp_path_factory.mktemp("state")), ACCOUNT, buckets=2)
    fence = None
    for n, d in enumerate(rng.sample(deltas, len(deltas))):
        if n % 5 == 0:
            state.apply(spark.createDataFrame(
                rng.sample(deltas, len(deltas))[n:n + 5] + [d], SCHEMA), n)
        if rng.random() < 0.15:
            epoch = rng.randrange(3)
            state.raise_fence(epoch)
            fence = epoch if fence is None else max(fence, epoch)
        if rng.random() < 0.15:
            state.compact()
    state.apply(spark.createDataFrame(deltas, SCHEMA), "last")
    assert state.fence() == fence
    want = expected([d for d in deltas if fence is None or d[6] >= fence])
    assert rows_of(state.rows()) == want
    state.compact()
    assert rows_of(state.rows()) == want


def test_a_state_written_before_there_were_fences_is_read(spark, tmp_path):
    state = StateTable(spark, f"{tmp_path}/state", ACCOUNT, buckets=2)
    state.apply(spark.createDataFrame([delta("I", k, 0, file=0) for k in (1, 2)], SCHEMA), 0)
    state.compact()
    path = f"{tmp_path}/state/versions"
    old = spark.createDataFrame([tuple(r)[:3] for r in spark.read.parquet(path).collect()],
                                "version long, buckets int, folder string")
    old.write.mode("overwrite").parquet(path)
    assert state.fence() is None and state.rows().count() == 2
    state.raise_fence(1)
    assert state.rows().count() == 0
