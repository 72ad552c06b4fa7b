"""Delta streams. Each runs over the files that are there, and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..connect import log_schema
from ..functions.position import after_position, position_order
from ..operators.merge import current_state
from ..operators.stretches import gaps, stretches
from ..session import new_folder
from ..sinks.counts import CountTable
from ..sinks.tables import append_rows, read_appended
from ..sources.log import land_log, log_after, stream_log
from ..sources.mappings import MappingState
from ..streaming import runs as r
from ..streaming.continuity import Continuity
from ..streaming.delivered import Delivered
from . import inputs as i
from .merging import APPENDED_SQL, KEY, new_state
from .registry import SQL, query

LOG_SQL = i.with_(i.CHANGELOG_SQL) + f"SELECT {i.DELTA} FROM changelog"


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return i.event_deltas(i.table_stream(spark, sf, "events"))


def _backfill(spark: SparkSession, sf: str) -> DataFrame:
    return i.customer_deltas(i.table_stream(spark, sf, "customer")).drop("before")


def _all(spark: SparkSession, sf: str) -> DataFrame:
    return _backfill(spark, sf).unionByName(_log(spark, sf))


def _written(stream: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    folder = new_folder(spark, label)
    r.write_stream(stream, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query("stream_log", LOG_SQL)
def stream_log_(spark: SparkSession, sf: str) -> DataFrame:
    return i.flat(_written(_log(spark, sf), spark, "stream-log"))


@query("stream_current_state", i.CURRENT_STATE_SQL)
def stream_current_state(spark: SparkSession, sf: str) -> DataFrame:
    state = new_state(spark)
    r.run(_log(spark, sf), [state.apply], f"{state.root}/checkpoint")
    state.apply(i.backfill(spark, sf), -1, reduce=False)
    return state.rows()


def _with_extents(events: DataFrame) -> DataFrame:
    """The log with the offset at which each event's next one begins."""
    return i.event_deltas(events).withColumn("next_offset", F.col("offset") + 100)


@query("stream_dedup", i.with_(*i.ALL_DELTAS_SQL) + f"SELECT {i.DELTA} FROM deltas")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill and log, delivered twice, the second time by a reader that starts over."""
    folder = new_folder(spark, "stream-dedup")
    delivered, path = Delivered(spark, f"{folder}/delivered"), f"{folder}/rows"
    schema = i.all_deltas(spark, sf).schema
    for _ in range(2):
        if delivered.part("all"):
            i.backfill(spark, sf).select(schema.names).write.parquet(f"{path}/batch_id=backfill")
            delivered.end_part("all")
    landed = i.landed(spark, sf, "log-with-extents",
                      lambda: _with_extents(i.table(spark, sf, "events")))
    log = spark.read.parquet(landed)
    for reader in range(2):
        def keep(batch: DataFrame, batch_id: int, reader: int = reader) -> None:
            batch.select(schema.names).write.mode("overwrite").parquet(
                f"{path}/batch_id={reader}-{batch_id}")

        r.run(stream_log(spark, landed, log.schema), [delivered.once(keep, i.ACCOUNT.key)],
              f"{folder}/checkpoint-{reader}")
    return i.flat(spark.read.schema(schema).parquet(path).select(schema.names))


@query("stream_dedup_ids", i.with_(*i.ALL_DELTAS_SQL) + f"SELECT {i.DELTA} FROM deltas")
def stream_dedup_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill and log, delivered twice, where rows do not tell where the next event begins."""
    twice = _all(spark, sf).unionByName(_all(spark, sf))
    return i.flat(_written(r.without_repeats(twice, i.ACCOUNT.key), spark, "stream-dedup"))


@query("log_gaps", f"""WITH places AS (
  SELECT DISTINCT event_id // {i.EVENTS_PER_FILE} + 1 AS number,
         4 + 100 * ((event_id % {i.EVENTS_PER_FILE}) // 3) AS place
  FROM events WHERE event_id % 97 >= 6 AND (event_id // {i.EVENTS_PER_FILE}) % 4 <> 2),
steps AS (
  SELECT number, place, coalesce(lag(place + 100) OVER (PARTITION BY number ORDER BY place), 4)
    AS reached FROM places),
files AS (SELECT number, lead(number) OVER (ORDER BY number) AS after
          FROM (SELECT DISTINCT number FROM places))
SELECT CAST({i.EPOCH} AS INTEGER) AS epoch, 'offsets' AS kind, printf('bin.%06d', number)
  AS filename, reached AS first, place - 1 AS last FROM steps WHERE place > reached
UNION ALL
SELECT CAST({i.EPOCH} AS INTEGER), 'files', printf('bin.%06d', number), number + 1, after - 1
FROM files WHERE after > number + 1""")
def log_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """What is missing of a log that lost every fourth file and, of the others, some events."""
    events = i.table(spark, sf, "events").where(
        f"event_id % 97 >= 6 AND (event_id div {i.EVENTS_PER_FILE}) % 4 <> 2")
    return gaps(stretches(_with_extents(events)))


@query("counts_redelivered", i.with_(*i.ALL_DELTAS_SQL) + """SELECT 'phase' AS by,
  CASE WHEN "offset" = 0 THEN 'backfill' ELSE 'iterative' END AS name, count(*) AS count
FROM deltas GROUP BY ALL
UNION ALL SELECT 'op', op, count(*) FROM deltas GROUP BY ALL
UNION ALL SELECT 'last', max(filename), max("offset") FROM deltas
WHERE filename = (SELECT max(filename) FROM deltas)""")
def counts_redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a stream that is run anew from its beginning: all its batches come twice."""
    folder = new_folder(spark, "counts")
    counts = CountTable(spark, f"{folder}/counts")
    counts.add(i.backfill(spark, sf), "backfill")
    log = i.changelog(spark, sf)
    log.repartition(4).write.parquet(f"{folder}/log")
    for attempt in range(2):
        stream = stream_log(spark, f"{folder}/log", log.schema, files_per_batch=2)
        r.run(stream, [counts.add], f"{folder}/checkpoint-{attempt}")
    parts = (("phase", counts.by_phase(), "phase", "count"), ("op", counts.by_op(), "op", "count"),
             ("last", counts.high_water(), "filename", "offset"))
    found = [rows.select(F.lit(by).alias("by"), F.col(name).alias("name"), F.col(n).alias("count"))
             for by, rows, name, n in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("stream_resume", LOG_SQL)
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Run, stop, run again when more of the log has landed, and once more for nothing."""
    folder = new_folder(spark, "stream-resume")
    log = i.changelog(spark, sf)
    middle = log.agg(F.percentile_approx("offset", 0.5).alias("offset")).first().offset
    for part in (F.col("offset") <= middle, F.col("offset") > middle, None):
        if part is not None:
            log.where(part).write.mode("append").parquet(f"{folder}/log")
        r.write_stream(stream_log(spark, f"{folder}/log", log.schema), f"{folder}/rows",
                       f"{folder}/checkpoint")
    return i.flat(spark.read.schema(log.schema).parquet(f"{folder}/rows"))


@query("resume_from_position", LOG_SQL)
def resume_from_position(spark: SparkSession, sf: str) -> DataFrame:
    """Read a log, lose the checkpoint, and go on behind the last position that was stored.

    The reader stops amid a file. What it appended and the state agree on the position.
    """
    folder, state = new_folder(spark, "resume-position"), new_state(spark)
    log = i.changelog(spark, sf, "event_id")
    middle = log.agg(F.max("event_id")).first()[0] // 2
    cut = log.agg(F.max(F.when(F.col("event_id") <= middle, position_order()))).first()[0]
    log = log.drop("event_id")
    behind = after_position(cut.epoch, cut.filename, cut.offset)
    for reader, rows in enumerate((~behind, behind)):
        land_log(log.where(rows), f"{folder}/log")
        stream, last = stream_log(spark, f"{folder}/log", log.schema), state.high_water()
        if last is not None:
            stream = log_after(stream, *last)

        def keep(batch: DataFrame, batch_id: int, reader: int = reader) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={reader}-{batch_id}")
            state.apply(batch, f"{reader}-{batch_id}")

        r.run(stream, [keep], f"{folder}/checkpoint-{reader}")
    return i.flat(spark.read.schema(log.schema).parquet(f"{folder}/rows").select(*log.columns))


@query("stream_image_breaks", SQL["image_breaks"])
def stream_image_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """The breaks of a log that lands in three parts, found batch by batch against the state."""
    state = new_state(spark)
    continuity, path = Continuity(state), f"{state.root}/log"
    log = i.full_log(spark, sf).drop("event_type")
    files = F.expr("CAST(right(filename, 6) AS BIGINT)")
    last = log.agg(F.max(files)).first()[0]
    state.apply(i.backfill(spark, sf), "backfill", reduce=False)
    for part in range(3):
        log.where(F.ceil(files * 3 / last) == part + 1).write.mode("append").parquet(path)
        r.run(stream_log(spark, path, log.schema), [continuity.process],
              f"{state.root}/checkpoint")
        if part == 1:
            state.compact()
    return i.flat(continuity.breaks())


@query("stream_table_at", i.with_(i.CHANGELOG_SQL, i.TABLE_MAP_SQL, i.MULTI_LOG_SQL) + """
SELECT r.db, r.tbl, g.op, g.k, g.epoch, g.filename, g."offset", g.seq, g.table_id
FROM multi_log g LEFT JOIN table_map r ON g.epoch = r.epoch AND g.table_id = r.table_id
  AND g.filename = r.filename""")
def stream_table_at(spark: SparkSession, sf: str) -> DataFrame:
    """A log of two tables as it lands, with the mappings known by then.

    First the files of even numbers land and their mappings, then the others, whose mappings
    come late, between those known, and the first ones once more. Rows without a mapping stay.
    """
    folder = new_folder(spark, "stream-table-at")
    log = i.multi_log(spark, sf).drop("after_v", "after_s")
    table_map = i.table_map(spark, sf)
    even = F.right("filename", F.lit(1)).isin("0", "2", "4", "6", "8")
    state = MappingState(spark, f"{folder}/table-map", f"{folder}/state")

    def named(batch: DataFrame, batch_id: int) -> None:
        state.refresh()
        state.names_at(batch).write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    for rows, mappings in ((even, even), (~even, F.lit(True))):
        table_map.where(mappings).write.mode("append").parquet(f"{folder}/table-map")
        log.where(rows).write.mode("append").parquet(f"{folder}/log")
        r.run(stream_log(spark, f"{folder}/log", log.schema), [named], f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows").select(
        "db", "tbl", "op", "k", "epoch", "filename", "offset", "seq", "table_id")


@query("stream_counts", i.with_(*i.ALL_DELTAS_SQL) + """SELECT db, tbl,
  CASE WHEN "offset" = 0 THEN 'backfill' ELSE 'iterative' END AS phase, count(*) AS count
FROM deltas GROUP BY ALL""")
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "stream-counts")
    counts = r.running_counts(_all(spark, sf))
    r.run(counts, [r.write_batches(f"{folder}/counts")], f"{folder}/checkpoint", "update")
    # Each batch brings the groups that changed; a count only grows.
    emitted = spark.read.schema(counts.schema).parquet(f"{folder}/counts")
    return emitted.groupBy("db", "tbl", "phase").agg(F.max("count").alias("count"))


@query("stream_keyed_state", i.CURRENT_STATE_SQL)
def stream_keyed_state(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "stream-keyed")
    latest = r.running_latest(_all(spark, sf), KEY)
    r.run(latest, [r.write_batches(f"{folder}/latest")], f"{folder}/checkpoint", "update")
    return current_state(spark.read.schema(latest.schema).parquet(f"{folder}/latest"), KEY)


@query("late_deltas", i.CURRENT_STATE_SQL)
def late_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The log twice over, its rows dealt out at random to four batches, backfill last."""
    state = new_state(spark)
    twice = i.delivered_twice(i.changelog(spark, sf))
    mixed = F.xxhash64("offset", "seq", "k")
    path = f"{state.root}/log"
    (twice.withColumn("part", F.pmod(mixed, F.lit(4))).sortWithinPartitions("part", mixed)
     .write.partitionBy("part").parquet(path))
    files = len(spark.read.schema(twice.schema).parquet(path).inputFiles())
    log = stream_log(spark, path, twice.schema, files_per_batch=-(-files // 4))
    r.run(log, [state.apply], f"{state.root}/checkpoint")
    state.apply(i.backfill(spark, sf), -1, reduce=False)
    return state.rows()


@query("fan_out", """SELECT 'history' AS sink, * FROM (""" + APPENDED_SQL + """)
UNION ALL SELECT 'current', * FROM (""" + i.CURRENT_STATE_SQL + ")")
def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """One stream into an appending and a merging sink."""
    state, path = new_state(spark), new_folder(spark, "history")
    r.run(_all(spark, sf), [state.apply, lambda batch, n: append_rows(batch, path, n)],
          f"{state.root}/checkpoint")
    history = read_appended(spark, path, i.ACCOUNT.schema)
    return history.select(F.lit("history").alias("sink"), "*").unionByName(
        state.rows().select(F.lit("current").alias("sink"), "*"))


@query("custom_processor", i.with_(i.CHANGELOG_SQL) + """SELECT op, count(*) AS deltas,
  max(after_v) AS largest FROM changelog GROUP BY op""")
def custom_processor(spark: SparkSession, sf: str) -> DataFrame:
    """A user's own processor: it gets each batch as a DataFrame, with its id."""
    path = new_folder(spark, "custom")

    def summarize(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("op").agg(F.count("*").alias("deltas"), F.max("after.v").alias("largest")) \
            .write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    log = stream_log(spark, i.full_log_folder(spark, sf), log_schema(i.ACCOUNT))
    r.run(log, [summarize], f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows").groupBy("op").agg(
        F.sum("deltas").alias("deltas"), F.max("largest").alias("largest"))
