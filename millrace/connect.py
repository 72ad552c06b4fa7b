"""Named sources and sinks, and the connections between them.

A specification has three parts, as in::

    importers:
      shop: {type: lake, database: shop, epoch: 0, tables: {...}}
    exporters:
      warehouse: {type: state, warehouse: /data, dataset_id: shop}
    connections:
      shop_to_warehouse: {in: shop, out: warehouse}

``run`` opens all sinks first and then starts the sources, each table of a source
with one stream that feeds every connected sink.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .model import TableSpec
from .operators.deltas import backfill_deltas
from .operators.merge import split_key_updates
from .operators.routing import OTHER, REJECTED, event_rows, routed, routes_of, write_routed
from .session import append_row, new_folder, read_if_written, stored
from .sinks.state import StateTable
from .sinks.tables import (Processor, append_rows, batch_name, check_table, create_table,
                           sink_table_name, sink_table_schema)
from .sources import jdbc
from .sources.log import RAW_EVENTS, log_after, stream_log, typed_deltas
from .sources.mappings import MappingState
from .streaming.continuity import Continuity
from .streaming.runs import start

# The batch a backfill is delivered as; the log's batches count from 0.
BACKFILL_BATCH = -1

# Files of a log that a micro-batch takes at most, unless a source says otherwise.
FILES_PER_BATCH = 1000


def log_schema(table: TableSpec) -> StructType:
    """The columns of a table's landed change log."""
    return StructType([
        StructField("db", StringType()),
        StructField("tbl", StringType()),
        StructField("op", StringType()),
        *[table.schema[k] for k in table.key],
        StructField("before", table.schema),
        StructField("after", table.schema),
        StructField("epoch", IntegerType()),
        StructField("filename", StringType()),
        StructField("offset", LongType()),
        StructField("seq", IntegerType()),
    ])


@dataclass(frozen=True)
class Feed:
    """One table of a source: its backfill and its log, both as deltas.

    ``read_once`` tells that the source should not be read again for every sink. A backfill
    may come in ``parts``, each with a name that is the same when the load goes on after a
    stop; what they need to know of each other is kept in the folder they are given.
    """

    table: TableSpec
    backfill: DataFrame
    log: DataFrame | None = None
    read_once: bool = False
    epoch: int = 0
    parts: Callable[[str], Iterator[tuple[str, DataFrame]]] | None = None


class Source(Protocol):
    def feeds(self, spark: SparkSession) -> Iterable[Feed]: ...


class Sink(Protocol):
    def open(self, spark: SparkSession) -> None: ...

    def processor(self, table: TableSpec, origin: str) -> Processor: ...

    def end_backfill(self, table: TableSpec, replaces: int | None) -> None: ...


@dataclass
class LakeSource:
    """Tables and their logs as parquet folders.

    ``tables`` maps a table name to ``rows``, ``log`` (optional) and ``key``. With ``start``, a
    position ``[epoch, filename, offset]``, only what is strictly behind it is read of the logs.
    """

    database: str
    tables: dict[str, dict]
    epoch: int = 0
    files_per_batch: int = FILES_PER_BATCH
    start: Sequence | None = None

    def feeds(self, spark: SparkSession) -> Iterable[Feed]:
        for name, where in self.tables.items():
            rows = spark.read.parquet(where["rows"])
            table = TableSpec(self.database, name, rows.schema, tuple(where.get("key", ())))
            log = (stream_log(spark, where["log"], log_schema(table), self.files_per_batch)
                   if "log" in where else None)
            if log is not None and self.start is not None:
                log = log_after(log, *self.start)
            yield Feed(table, backfill_deltas(rows, table, self.epoch), log, epoch=self.epoch)


@dataclass
class RawLakeSource:
    """Tables as parquet folders, and one raw log of all of them.

    ``tables`` maps a table name to ``rows`` and ``key``. ``events`` is the folder of the raw
    events, ``table_map`` that of the mappings of table ids, which have to land no later than
    the events they are for. Rows that cannot be loaded are written below ``rejected``:
    ``rows`` has their places and the reason, ``events`` the number of events that are
    neither row changes nor mappings. Rows of tables that are not named are passed over.
    """

    database: str
    tables: dict[str, dict]
    events: str
    table_map: str
    rejected: str
    epoch: int = 0
    files_per_batch: int = FILES_PER_BATCH

    def feeds(self, spark: SparkSession) -> Iterable[Feed]:
        return LakeSource(self.database, self.tables, self.epoch).feeds(spark)

    def raw_log(self, spark: SparkSession) -> DataFrame:
        return stream_log(spark, self.events, RAW_EVENTS, self.files_per_batch)

    def raw_processor(self, spark: SparkSession, origin: str,
                      targets: Sequence[tuple[TableSpec, Sequence[Processor]]],
                      state: str) -> Processor:
        """Hands the changes of each table to its processors, and sets the others apart.

        A batch is read once, whatever the number of tables: its rows get their tables from the
        mappings known so far, which are kept below ``state``, are checked, and are written in
        a folder for each table. Processors of tables without rows are not called.
        """
        mappings = MappingState(spark, self.table_map, state, self.files_per_batch)
        tables = [table for table, _ in targets]

        def process(batch: DataFrame, batch_id: int) -> None:
            name = batch_name(origin, batch, batch_id)
            mappings.refresh()
            written = write_routed(routed(mappings.names_at(event_rows(batch)), tables),
                                   new_folder(batch.sparkSession, "routed"))
            present = routes_of(written)
            for number, (table, processors) in enumerate(targets):
                if number in present:
                    deltas = typed_deltas(written.where(F.col("route") == number), table)
                    for processor in processors:
                        processor(deltas, batch_id)
            mapped = F.col("tbl").isNotNull()
            rejected = written.where(F.col("route") == REJECTED).select(
                "db", "tbl", F.when(~mapped, F.col("table_id")).alias("table_id"), "op", "epoch",
                "filename", "offset", "seq", "reason")
            others = written.where(F.col("route") == OTHER).groupBy("event_type").count()
            for label, rows in (("rows", rejected), ("events", others)):
                rows.write.mode("overwrite").parquet(f"{self.rejected}/{label}/batch_id={name}")

        return process


@dataclass
class MySqlSource:
    """All tables of a database by JDBC in key ranges, and their landed logs.

    ``log`` is a folder with one subfolder per table.
    """

    host: str
    database: str
    user: str
    password: str = field(repr=False)
    port: int = 3306
    batch_size: int = 10_000
    epoch: int = 0
    concurrent_full_imports: int = 5
    log: str | None = None
    files_per_batch: int = FILES_PER_BATCH

    def feeds(self, spark: SparkSession) -> Iterable[Feed]:
        options = jdbc.JdbcOptions(
            host=self.host, port=self.port, user=self.user, password=self.password,
            database=self.database, batch_size=self.batch_size, epoch=self.epoch,
            concurrent_full_imports=self.concurrent_full_imports)
        for name, key in jdbc.table_keys(spark, options):
            whole = jdbc.read_query(spark, options, f"SELECT * FROM {jdbc.quoted(name)}")
            table = TableSpec(self.database, name, whole.schema, key)
            log = (stream_log(spark, f"{self.log}/{name}", log_schema(table),
                              self.files_per_batch) if self.log else None)
            yield Feed(table, backfill_deltas(whole, table, self.epoch), log, read_once=True,
                       epoch=self.epoch, parts=self._waves(spark, options, table) if key else None)

    def _waves(self, spark: SparkSession, options: jdbc.JdbcOptions,
               table: TableSpec) -> Callable[[str], Iterator[tuple[str, DataFrame]]]:
        def parts(folder: str) -> Iterator[tuple[str, DataFrame]]:
            schema = StructType([StructField("split_id", LongType()),
                                 *[table.schema[k] for k in table.key]])
            points = read_if_written(spark, folder, schema)
            if points is None:
                jdbc.read_points(spark, options, table.name, table.key).write.parquet(folder)
                points = spark.read.schema(schema).parquet(folder)
            for name, predicates in jdbc.waves(points, table.key):
                rows = jdbc.read_ranges(spark, options, table.name, predicates)
                yield name, backfill_deltas(rows, table, self.epoch)

        return parts


@dataclass
class StateSink:
    """Current-state tables below ``warehouse/project_id/dataset_id``.

    Updates that change the key are split first. With ``compact_every`` the base is
    rewritten after the backfill and after every so many batches. With ``check_images`` the
    images of each batch are compared with those stored; see ``continuity``.
    """

    warehouse: str
    dataset_id: str
    project_id: str = "default"
    application_name: str = "millrace"
    buckets: int | None = None
    compact_every: int | None = None
    check_images: bool = False
    _spark: SparkSession | None = field(default=None, repr=False)

    @property
    def root(self) -> str:
        return f"{self.warehouse}/{self.project_id}/{self.dataset_id}"

    def open(self, spark: SparkSession) -> None:
        self._spark = spark

    def state(self, table: TableSpec) -> StateTable:
        return StateTable(self._spark, f"{self.root}/{table.table_id}", table, self.buckets)

    def continuity(self, table: TableSpec) -> Continuity:
        """What was found in the images of a table's log."""
        return Continuity(self.state(table))

    def processor(self, table: TableSpec, origin: str) -> Processor:
        state, continuity = self.state(table), self.continuity(table)

        def process(batch: DataFrame, batch_id: int) -> None:
            deltas = split_key_updates(batch, state.key)
            if self.check_images and batch_id != BACKFILL_BATCH:
                continuity.judge(deltas, batch_name(origin, batch, batch_id))
            state.apply(deltas, batch_name(origin, batch, batch_id),
                        reduce=batch_id != BACKFILL_BATCH)
            if self.compact_every and batch_id != BACKFILL_BATCH and (
                    batch_id + 1) % self.compact_every == 0:
                state.compact()

        return process

    def end_backfill(self, table: TableSpec, replaces: int | None) -> None:
        """Close the epochs before the one that ``replaces`` them, late log rows included."""
        state = self.state(table)
        if replaces is not None:
            state.raise_fence(replaces)
        if self.compact_every:
            state.compact()


@dataclass
class AppendSink:
    """Every after-image appended, as it came, below ``warehouse/project_id/dataset_id``.

    With a ``database``, each table is also one of the catalog, in the sink's types: created
    when it is missing, else checked against the source's columns.
    """

    warehouse: str
    dataset_id: str
    project_id: str = "default"
    application_name: str = "millrace"
    database: str | None = None
    _spark: SparkSession | None = field(default=None, repr=False)

    def path(self, table: TableSpec) -> str:
        return f"{self.warehouse}/{self.project_id}/{self.dataset_id}/{table.table_id}"

    def open(self, spark: SparkSession) -> None:
        self._spark = spark
        if self.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def processor(self, table: TableSpec, origin: str) -> Processor:
        path, schema = self.path(table), None
        if self.database:
            name, schema = sink_table_name(table), sink_table_schema(table)
            create_table(self._spark, self.database, name, schema, path)
            check_table(self._spark, self.database, name, schema)
        return lambda batch, batch_id: append_rows(
            batch, path, batch_name(origin, batch, batch_id), schema)

    def end_backfill(self, table: TableSpec, replaces: int | None) -> None:
        """What was appended stays."""


SOURCES = {"lake": LakeSource, "raw": RawLakeSource, "mysql": MySqlSource}
SINKS = {"state": StateSink, "append": AppendSink}


def load_specification(path: str) -> dict:
    """Read a specification from a YAML or JSON file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as absent:
        raise ValueError("reading YAML needs the yaml package; use a .json file") from absent
    return yaml.safe_load(text)


def _build(kinds: dict, part: dict[str, dict]) -> dict:
    built = {}
    for name, options in part.items():
        options = dict(options)
        kind = options.pop("type", None)
        if kind not in kinds:
            raise ValueError(f"{name}: unknown type {kind!r}, known are {sorted(kinds)}")
        built[name] = kinds[kind](**options)
    return built


def connect(specification: dict) -> tuple[dict, dict, list[tuple[str, str]]]:
    """The named sources and sinks, and which source feeds which sink."""
    sources = _build(SOURCES, specification["importers"])
    sinks = _build(SINKS, specification["exporters"])
    links = [(link["in"], link["out"]) for link in specification["connections"].values()]
    for source, sink in links:
        if source not in sources or sink not in sinks:
            raise ValueError(f"connection {source} -> {sink} names an unknown end")
    return sources, sinks, links


# What of a table's backfill is loaded: its parts, and with a null part all of an epoch.
FINISHED = StructType([StructField("epoch", IntegerType()), StructField("part", StringType())])


def _finished(spark: SparkSession, path: str) -> set[tuple[int, str | None]]:
    written = read_if_written(spark, path, FINISHED)
    return set() if written is None else {tuple(r) for r in written.distinct().collect()}


@dataclass(frozen=True)
class _Load:
    """One table of a source and the sinks it goes to."""

    source: str
    feed: Feed
    sinks: list[Sink]
    checkpoints: str

    @property
    def finished(self) -> str:
        return f"{self.checkpoints}/finished/{self.source}/{self.feed.table.table_id}"

    def processors(self, part: str = "") -> list[Processor]:
        origin = f"{self.source}-e{self.feed.epoch}" + (f"-{part}" if part else "")
        return [sink.processor(self.feed.table, origin) for sink in self.sinks]

    def check(self, spark: SparkSession) -> None:
        """Raise if a sink does not take the table, or its epoch is behind a finished one."""
        self.processors()
        epochs = [epoch for epoch, part in _finished(spark, self.finished) if part is None]
        if self.feed.epoch < max(epochs, default=self.feed.epoch):
            raise ValueError(f"{self.source}: epoch {self.feed.epoch} of "
                             f"{self.feed.table.table_id} is over")

    def backfill(self, spark: SparkSession) -> None:
        """Load what of the backfill is not loaded yet."""
        feed, finished = self.feed, _finished(spark, self.finished)
        if (feed.epoch, None) in finished:
            return

        def note(part: str | None) -> None:
            append_row(spark, self.finished, FINISHED, feed.epoch, part)

        points = f"{self.checkpoints}/points/{self.source}/{feed.table.table_id}/e{feed.epoch}"
        for part, deltas in feed.parts(points) if feed.parts else [("", feed.backfill)]:
            if (feed.epoch, part) in finished:
                continue
            if feed.read_once and len(self.sinks) > 1:
                deltas = stored(deltas, "backfill")
            for process in self.processors(part):
                process(deltas, BACKFILL_BATCH)
            if part:
                note(part)
        replaces = feed.epoch if any(part is None for _, part in finished) else None
        for sink in self.sinks:
            sink.end_backfill(feed.table, replaces)
        note(None)


def run(spark: SparkSession, specification: dict, checkpoints: str, continuous: bool = False,
        running: list[StreamingQuery] | None = None) -> dict[str, Sink]:
    """Load every connected table; returns the sinks by name.

    All tables are checked against their sinks before the first row is written. Each table's
    backfill comes first and its log after it, so that one job at a time writes to a sink
    table. The log's files stay there meanwhile. Without ``continuous`` this returns when what
    is there now is loaded; with it, the streams that go on are added to ``running``.

    A backfill, or part of one, that was completed is not read again. To read a changed source
    anew, raise its epoch: keys that the new backfill does not bring are then left out of a
    state sink, and so are rows of the old epochs' log that land later. So sources that share a
    table of a state sink must not raise their epochs.
    """
    sources, sinks, links = connect(specification)
    for sink in sinks.values():
        sink.open(spark)
    loads: list[_Load] = []
    for name, source in sources.items():
        outs = [sinks[out] for origin, out in links if origin == name]
        loads += [_Load(name, feed, outs, checkpoints)
                  for feed in (source.feeds(spark) if outs else ())]
    for load in loads:
        load.check(spark)

    def follow(log: DataFrame, processors: list[Processor], checkpoint: str) -> None:
        query = start(log, processors, f"{checkpoints}/{checkpoint}", continuous=continuous)
        if not continuous:
            query.awaitTermination()
        elif running is not None:
            running.append(query)

    for load in loads:
        load.backfill(spark)
        if load.feed.log is not None:
            follow(load.feed.log, load.processors(), f"{load.source}/{load.feed.table.table_id}")
    for name, source in sources.items():
        targets = [(load.feed.table, load.processors()) for load in loads if load.source == name]
        if isinstance(source, RawLakeSource) and targets:
            process = source.raw_processor(spark, f"{name}-e{source.epoch}", targets,
                                           f"{checkpoints}/{name}/mappings")
            follow(source.raw_log(spark), [process], f"{name}/raw log")
    return sinks
