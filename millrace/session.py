"""Session settings, the shared work folder, and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Settings the jobs here are written for. All of them can be changed freely;
# results do not depend on them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Lookup tables up to this many rows, and bytes of their text form, are broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session that names none gets a temporary folder. A local path on a cluster is refused,
    unless ``spark.millrace.sharedMount`` says that it is a mount all machines share.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        mounted = spark.conf.get("spark.millrace.sharedMount", "false") == "true"
        if not mounted and is_machine_local(named, context.master):
            raise ValueError(f"{named} is on each machine by itself; name a folder all share, or "
                             "set spark.millrace.sharedMount if it is a shared mount")
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def is_machine_local(folder: str, master: str) -> bool:
    """Whether a folder's address is of a machine's own disk, and more than one machine runs."""
    return folder.startswith("file:") and not master.startswith("local")


def new_folder(spark: SparkSession, label: str) -> str:
    """A name not used before, below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    every later use sees the same rows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_if_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The parquet data at ``path``, or None when nothing was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_row(spark: SparkSession, path: str, schema: StructType, *values) -> None:
    """Append one row to the parquet data at ``path``."""
    spark.range(1).select(*[F.lit(value).cast(field.dataType).alias(field.name)
                            for field, value in zip(schema, values, strict=True)]
                          ).write.mode("append").parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to broadcast, by its rows and its bytes as text."""
    width = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    found = df.agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).first()
    return found.rows <= rows and (found.bytes or 0) <= size


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` holds at most ``rows`` rows. Counted whole, without moving rows."""
    return df.count() <= rows
