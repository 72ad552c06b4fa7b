"""Text forms of rows, keys, schemas and deltas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .position import position_text


def joined_text(values: Column, delimiter: str) -> Column:
    """The array's elements with a delimiter between; NULL prints ``null``."""
    return F.concat_ws(delimiter, F.transform(values, lambda v: F.coalesce(v, F.lit("null"))))


def struct_values(struct: str, fields: list[str]) -> Column:
    return F.array(*[F.col(struct)[f].cast("string") for f in fields])


# Fixed formats of rows, keys, columns, schemas and delta lines.
ROW_PREFIX = "Row: "
KEY_PREFIX = "Key: "
TABLE_COMMENT = "Automatically created for table "


def row_text(values: Column) -> Column:
    return F.concat(F.lit(ROW_PREFIX), joined_text(values, ":"))


def key_text(values: Column) -> Column:
    return F.concat(F.lit(KEY_PREFIX), joined_text(values, ":"))


def column_text(name: Column, engine_type: Column, length: Column) -> Column:
    return F.concat(name, F.lit(" - "), engine_type, F.lit("("), length.cast("string"), F.lit(")"))


def schema_text(db: Column, tbl: Column, columns: Column, key: Column) -> Column:
    return F.concat(db, F.lit("."), tbl, F.lit(", Cols: ["), F.array_join(columns, ", "),
                    F.lit("], PK: ["), F.array_join(key, ", "), F.lit("]"))


def delta_text(schema: Column, before: Column, after: Column, epoch: Column, filename: Column,
               offset: Column) -> Column:
    """One line for a delta; ``before`` and ``after`` are row texts or null."""
    absent = F.lit("null")
    return F.concat(F.lit("Got "), schema, F.lit(": "), F.coalesce(before, absent), F.lit(" -> "),
                    F.coalesce(after, absent), F.lit(" @ "),
                    position_text(epoch, filename, offset))


def table_id(db: Column, tbl: Column) -> Column:
    return F.concat_ws(".", db, tbl)


def table_comment(table: Column) -> Column:
    return F.concat(F.lit(TABLE_COMMENT), table)


def row_record(*columns: str) -> Column:
    """The row as a JSON record of names and values, NULLs kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
