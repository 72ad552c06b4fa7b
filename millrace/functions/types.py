"""Source, engine and sink types, and reading log values as those types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DoubleType, FloatType, IntegerType,
                               IntegralType, LongType, ShortType, StringType)

# Source type -> (engine type, length; None = as in the catalog).
SOURCE_TYPES = {
    "TINYINT": ("INT", 1),
    "SMALLINT": ("INT", 1),
    "MEDIUMINT": ("INT", 1),
    "INT": ("INT", 4),
    "BIGINT": ("INT", 8),
    "VARCHAR": ("STRING", None),
}

# Engine type -> sink type.
SINK_TYPES = {"FLOAT": "FLOAT", "INT": "INTEGER", "STRING": "STRING"}

# The Spark type that holds each source type whole.
SPARK_TYPES: dict[str, DataType] = {
    "TINYINT": ByteType(),
    "SMALLINT": ShortType(),
    "MEDIUMINT": IntegerType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "VARCHAR": StringType(),
}
SINK_SPARK_TYPES: dict[str, DataType] = {
    "FLOAT": DoubleType(),
    "INTEGER": LongType(),
    "STRING": StringType(),
}


def widest(kind: DataType) -> DataType:
    """The Spark type that a sink keeps a column in; types without one there stay."""
    if isinstance(kind, IntegralType):
        return SINK_SPARK_TYPES["INTEGER"]
    return SINK_SPARK_TYPES["FLOAT"] if isinstance(kind, (FloatType, DoubleType)) else kind


def _choice(of: Column, values: dict[str, Column]) -> Column:
    chosen = F.lit(None)
    for name, value in reversed(values.items()):
        chosen = F.when(of == name, value).otherwise(chosen)
    return chosen


def engine_type(sql_type: Column) -> Column:
    """The engine type, null for a source type that is not supported."""
    return _choice(sql_type, {name: F.lit(kind) for name, (kind, _) in SOURCE_TYPES.items()})


def engine_length(sql_type: Column, size: Column) -> Column:
    return _choice(sql_type, {
        name: size.cast("int") if length is None else F.lit(length)
        for name, (_, length) in SOURCE_TYPES.items()
    })


def spark_type(sql_type: Column) -> Column:
    return _choice(sql_type,
                   {name: F.lit(kind.simpleString()) for name, kind in SPARK_TYPES.items()})


def sink_type(engine: Column) -> Column:
    return _choice(engine, {name: F.lit(kind) for name, kind in SINK_TYPES.items()})


def read_text(value: Column, charset: str = "UTF-8") -> Column:
    """Log bytes as text; NULL stays NULL, and bytes that are no UTF-8 become NULL."""
    if charset.upper().replace("-", "") == "UTF8":
        return F.try_validate_utf8(value.cast("string"))
    return F.decode(value, charset)


def fits(value: Column, sql_type: str) -> Column:
    """Whether an integer is within its declared width; NULL is."""
    return value.isNull() | value.try_cast(SPARK_TYPES[sql_type]).isNotNull()


def read_int(value: Column, sql_type: str) -> Column:
    """The integer in its declared width; see ``fits`` for those outside it."""
    return value.try_cast(SPARK_TYPES[sql_type])
