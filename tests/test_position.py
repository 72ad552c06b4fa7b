from __future__ import annotations

import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import position as p
from millrace.session import is_machine_local

SCHEMA = "epoch int, filename string, offset bigint"
POSITIONS = st.lists(st.tuples(
    st.integers(-2**31, 2**31 - 1),
    st.text(max_size=12).filter(lambda s: s.encode("utf-8", "ignore").decode() == s),
    st.integers(-2**63, 2**63 - 1),
), min_size=1, max_size=40)


def _columns():
    return F.col("epoch"), F.col("filename"), F.col("offset")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(POSITIONS)
def test_codec_round_trip_and_layout(spark, positions):
    coded = spark.createDataFrame(positions, SCHEMA).withColumn(
        "bytes", p.encode_position(*_columns()))
    decoded = coded.withColumn("d", p.decode_position(F.col("bytes"))).collect()
    for row in decoded:
        ends = struct.pack(">i", row.epoch), struct.pack(">q", row.offset)
        assert bytes(row.bytes) == row.filename.encode().join(ends)
        assert tuple(row.d) == (row.epoch, row.filename, row.offset)


def test_too_short_to_decode(spark):
    rows = spark.createDataFrame([(b"\0" * n,) for n in range(14)], "b binary")
    decoded = rows.select(F.octet_length("b").alias("n"), p.decode_position(F.col("b")).alias("d"))
    assert {r.n: r.d is not None for r in decoded.collect()} == {n: n >= 12 for n in range(14)}


def test_text(spark):
    row = spark.createDataFrame([(0, "bin.000001", 4)], SCHEMA).select(
        p.position_text(*_columns())).first()
    assert row[0] == "MySqlStreamPosition: (0:bin.000001:4)"


def test_file_numbers_sort_as_numbers(spark):
    names = ["", "bin.999998", "bin.999999", "bin.1000000", "bin.1000001"]
    rows = [(0, name, 4) for name in reversed(names)]
    ordered = spark.createDataFrame(rows, SCHEMA).orderBy(p.position_order()).collect()
    assert [r.filename for r in ordered] == names


def test_backfill_sorts_first_in_its_epoch_and_after_older_ones(spark):
    rows = [(1, "bin.000001", 4), (1, "", 0), (0, "bin.000009", 99), (0, "", 0)]
    ordered = spark.createDataFrame(rows, SCHEMA).orderBy(p.position_order()).collect()
    assert [tuple(r) for r in ordered] == sorted(rows)


def test_byte_order_is_typed_order_for_names_of_one_width(spark):
    rows = [(e, f"bin.{n:06d}", o)
            for e in (0, 1, 7) for n in (1, 2, 300000) for o in (4, 256, 70000)]
    df = spark.createDataFrame(rows, SCHEMA)
    by_bytes = [tuple(r) for r in df.orderBy(p.encode_position(*_columns())).collect()]
    by_type = [tuple(r) for r in df.orderBy(p.position_order()).collect()]
    assert by_bytes == by_type


def test_after_position(spark):
    rows = [(e, f, o) for e in (0, 1, 2) for f in ("", "bin.999999", "bin.1000000")
            for o in (0, 4, 100)]
    df = spark.createDataFrame(rows, SCHEMA)

    def order(row):
        return row[0], int(row[1][4:] or 0), row[2]

    for start in rows:
        got = {tuple(r) for r in df.where(p.after_position(*start)).collect()}
        assert got == {row for row in rows if order(row) > order(start)}


def test_phase(spark):
    rows = spark.createDataFrame([(0,), (4,)], "offset bigint")
    assert [r[0] for r in rows.select(p.phase(F.col("offset"))).collect()] == [
        "backfill", "iterative"]


def test_positions_that_cannot_be_read_have_a_fault(spark):
    good = bytes(4) + b"bin.1" + bytes(8)
    rows = spark.createDataFrame([(1, good), (2, b"short"), (3, bytes(4) + b"\xff\xfe" + bytes(8)),
                                  (4, None), (5, bytes(12))], "n int, p binary")
    found = rows.select("n", p.decode_position(F.col("p")).alias("d"),
                        p.position_fault(F.col("p")).alias("fault")).orderBy("n").collect()
    assert [(r.d and r.d.filename, r.fault) for r in found] == [
        ("bin.1", None), (None, "too short"), (None, "file name is no UTF-8"), (None, None),
        ("", None)]


def test_a_local_checkpoint_folder_is_refused_on_a_cluster():
    assert is_machine_local("file:/tmp/x", "yarn") and is_machine_local("file:///x", "spark://h:1")
    assert not is_machine_local("hdfs://n/x", "yarn") and not is_machine_local("/x", "yarn")
    assert not is_machine_local("file:///x", "local-cluster[3,2,1024]")
