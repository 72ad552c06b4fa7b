"""Running delta streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.position import delta_order, phase
from ..operators.deltas import delta_id
from ..operators.merge import STATE
from ..sinks.tables import Processor, fan_out


def start(stream: DataFrame, processors: Sequence[Processor], checkpoint: str,
          output_mode: str = "append", continuous: bool = False) -> StreamingQuery:
    """Start handing the stream's batches to ``processors``.

    A batch may be handed over again after a failure, with the same id. With
    ``continuous`` the query goes on for new files; else it ends with those there.
    """
    writer = (stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
              .foreachBatch(fan_out(processors) if len(processors) > 1 else processors[0]))
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def run(stream: DataFrame, processors: Sequence[Processor], checkpoint: str,
        output_mode: str = "append") -> None:
    """Process what the stream has now, and return."""
    start(stream, processors, checkpoint, output_mode).awaitTermination()


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write what the stream has now to parquet, each row once."""
    (stream.writeStream.format("parquet").option("path", path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
     .awaitTermination())


def write_batches(path: str) -> Processor:
    """A processor that keeps each batch in its own folder."""
    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return process


# Copies of one delta that arrive together are first reduced in this many tasks.
COPY_TASKS = 8


def without_repeats(stream: DataFrame, key: Sequence[str],
                    copy_tasks: int = COPY_TASKS) -> DataFrame:
    """Each delta once, over the whole life of the stream.

    Copies are reduced in two steps, first spread by the input partition they come
    in, so that a delta with very many copies is no bottleneck; ``copy_tasks=1``
    leaves out the first step and its state. No watermark: a delta carries no time
    and may be any amount late. The state holds every delta id seen, so use this only
    for sinks that cannot merge.
    """
    if copy_tasks > 1:
        spread = stream.withColumn("_task", F.spark_partition_id() % copy_tasks)
        stream = spread.dropDuplicates([*delta_id(key), "_task"]).drop("_task")
    return stream.dropDuplicates(delta_id(key))


def running_counts(stream: DataFrame) -> DataFrame:
    """Deltas so far per table and phase."""
    return stream.groupBy("db", "tbl", phase(F.col("offset")).alias("phase")).count()


def running_latest(stream: DataFrame, key: Sequence[str]) -> DataFrame:
    """The latest delta per key, held by the stream.

    A streaming aggregate: rows of one key are reduced before they reach its
    state, so a hot key is no bottleneck. Emit it in update mode to get the keys
    that changed.
    """
    newest = F.max_by(F.struct(*STATE), delta_order())
    return stream.groupBy(*key).agg(newest.alias("_newest")).select(*key, "_newest.*")
