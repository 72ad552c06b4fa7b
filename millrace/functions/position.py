"""Log positions as columns: byte codec, text, and sort order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import BACKFILL_OFFSET

# Byte layout: big-endian int32 epoch, UTF-8 file name, big-endian int64 offset.
EPOCH_HEX, OFFSET_HEX = 8, 16
SHORTEST_POSITION = 12


def encode_position(epoch: Column, filename: Column, offset: Column) -> Column:
    """The position as bytes."""
    epoch_hex = F.right(F.lpad(F.hex(epoch.cast("long")), 16, "0"), F.lit(EPOCH_HEX))
    offset_hex = F.lpad(F.hex(offset.cast("long")), OFFSET_HEX, "0")
    return F.unhex(F.concat(epoch_hex, F.hex(filename), offset_hex))


def _signed(digits: Column, bits: int) -> Column:
    unsigned = F.conv(digits, 16, 10).cast("decimal(20,0)")
    wrapped = unsigned - F.lit(Decimal(2**bits))
    return F.when(unsigned >= F.lit(Decimal(2 ** (bits - 1))), wrapped).otherwise(unsigned)


def decode_position(position: Column) -> Column:
    """Struct ``(epoch, filename, offset)``; null for fewer than 12 bytes or a name that is no text.

    See ``position_fault`` for which it is.
    """
    digits = F.hex(position)
    parts = F.struct(
        _signed(F.left(digits, F.lit(EPOCH_HEX)), 32).cast("int").alias("epoch"),
        _name(position).alias("filename"),
        _signed(F.right(digits, F.lit(OFFSET_HEX)), 64).cast("long").alias("offset"),
    )
    return F.when(position_fault(position).isNull() & position.isNotNull(), parts)


def _name(position: Column) -> Column:
    """The position's file name, null if its bytes are no UTF-8."""
    digits = F.hex(position)
    length = F.length(digits) - F.lit(EPOCH_HEX + OFFSET_HEX)
    return F.try_validate_utf8(
        F.unhex(F.substr(digits, F.lit(EPOCH_HEX + 1), length)).cast("string"))


def position_fault(position: Column) -> Column:
    """Why a position cannot be read, null if it can."""
    return (F.when(F.octet_length(position) < SHORTEST_POSITION, "too short")
            .when(_name(position).isNull() & position.isNotNull(), "file name is no UTF-8"))


def position_text(epoch: Column, filename: Column, offset: Column) -> Column:
    # Fixed format.
    return F.concat(F.lit("MySqlStreamPosition: ("), epoch.cast("string"), F.lit(":"), filename,
                    F.lit(":"), offset.cast("string"), F.lit(")"))


def position_columns() -> list[Column]:
    """Columns whose order is that of the log positions.

    A log file name is a base and a number, filled up with zeros to a fixed width
    that large numbers exceed. So the longer name is the later one, and
    bin.1000000 comes after bin.999999; names of one length sort as they are, and
    the empty name of a backfill comes first. A change of the base needs a new
    epoch.
    """
    return [F.col("epoch").cast("int").alias("epoch"),
            F.length("filename").alias("name_length"), F.col("filename"),
            F.col("offset").cast("long").alias("offset")]


def delta_columns() -> list[Column]:
    """Columns that put one table's deltas in their total order."""
    return [*position_columns(), F.col("seq").cast("int").alias("seq")]


def position_order() -> Column:
    return F.struct(*position_columns())


def delta_order() -> Column:
    return F.struct(*delta_columns())


def phase(offset: Column) -> Column:
    return F.when(offset == BACKFILL_OFFSET, "backfill").otherwise("iterative")


def after_position(epoch: int, filename: str, offset: int) -> Column:
    """Rows strictly behind the given log position."""
    start = [F.lit(epoch), F.lit(len(filename)), F.lit(filename), F.lit(offset)]
    behind = F.lit(False)
    for mine, theirs in reversed(list(zip(position_columns(), start, strict=True))):
        behind = (mine > theirs) | ((mine == theirs) & behind)
    return behind


def in_files_from(epoch: int, filename: str) -> Column:
    """Rows of the given log file and the files after it.

    Nothing but the file is looked at, so that folders of other files need not be opened.
    """
    mine, theirs = F.col("epoch").cast("int"), F.lit(epoch)
    length = F.length("filename")
    later = (length > len(filename)) | ((length == len(filename)) & (F.col("filename") >= filename))
    return (mine > theirs) | ((mine == theirs) & later)
