"""Images of a key over the batches of a log: does each ``before`` follow from what was there?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.position import delta_columns, delta_order
from ..model import BACKFILL_OFFSET
from ..operators.slices import previous_in_key
from ..session import append_row, read_if_written, stored
from ..sinks.state import StateTable
from ..sinks.tables import batch_name

_JUDGED = StructType([StructField("batch", StringType())])


class Continuity:
    """Judges the batches of a log by the images that a state table holds, before they reach it.

    The first delta of a key in a batch is compared with the key's stored image, the others with
    the one before them, so all batches together give what ``image_breaks`` gives for the whole
    log, if the log comes in order. A stored image that a backfill brought is not compared: it
    may be younger than the log's next row. Of each key in a batch one row meets the state,
    whose base is read in place in its buckets.

    A key whose rows begin behind its stored position is told by ``late``: its rows up to there
    are compared with each other only. One that comes again at the stored position is not judged.

    What was found is kept below ``root``. A batch that is handed over again after it was judged is
    not judged again, since the state may have it by then.
    """

    def __init__(self, state: StateTable, root: str | None = None) -> None:
        self.state, self.spark = state, state.spark
        self.root = root or f"{state.root}/continuity"
        fields = {f.name: f for f in state.schema}
        image = fields["after"].dataType
        position = [fields[name] for name in ("epoch", "filename", "offset", "seq")]
        key = [fields[name] for name in state.key]
        self._breaks = StructType([*key, fields["op"], StructField("before", image),
                                   StructField("expected", image), *position])
        self._late = StructType([*key, *position])

    def judge(self, deltas: DataFrame, name: str) -> None:
        """Note the breaks and late keys of the batch ``name``, once."""
        judged = read_if_written(self.spark, f"{self.root}/judged", _JUDGED)
        if judged is not None and not judged.where(F.col("batch") == name).isEmpty():
            return
        key, position = self.state.key, self._late.fieldNames()[len(self.state.key):]
        firsts = deltas.groupBy(*key).agg(F.min(delta_order()).alias("_first"))
        mine = self.state.latest().where(F.col("offset") != BACKFILL_OFFSET).select(
            *key, "op", "after", *position)
        known = stored(mine.join(firsts, key), "known-images")
        late = known.where(F.col("_first") < delta_order()).select(*key, *[
            F.col(f"_first.{field}").alias(field) for field in position])
        late.write.mode("overwrite").parquet(f"{self.root}/late/batch_id={name}")
        # A copy of the stored delta comes before it, so it is compared with nothing.
        rows = deltas.select(*key, "op", "before", "after", *position).withColumn("_known", F.lit(0))
        both = rows.unionByName(known.select(
            *key, "op", F.lit(None).cast(self._breaks["before"].dataType).alias("before"), "after",
            *position).withColumn("_known", F.lit(1)))
        linked = previous_in_key(both, key, [*delta_columns(), F.col("_known")], "after")
        expected = F.col("previous.value")
        broken = ((F.col("_known") == 0) & F.col("previous").isNotNull()
                  & ~F.col("before").eqNullSafe(expected))
        linked.where(broken).withColumn("expected", expected).select(
            *self._breaks.fieldNames()).write.mode("overwrite").parquet(
            f"{self.root}/breaks/batch_id={name}")
        append_row(self.spark, f"{self.root}/judged", _JUDGED, name)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Judge a stream's batch and then add it to the state."""
        name = batch_name("batch", batch, batch_id)
        self.judge(batch, name)
        self.state.apply(batch, name)

    def _read(self, label: str, schema: StructType) -> DataFrame:
        rows = read_if_written(self.spark, f"{self.root}/{label}", schema)
        return (self.spark.createDataFrame([], schema) if rows is None
                else rows.select(*schema.fieldNames()))

    def breaks(self) -> DataFrame:
        """Deltas whose ``before`` is not the image that was there, with the ``expected`` one."""
        return self._read("breaks", self._breaks)

    def late(self) -> DataFrame:
        """Keys of a batch that begin behind what the state has, with the first such position."""
        return self._read("late", self._late)
