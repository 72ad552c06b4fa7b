"""The table and delta model.

A *delta* is one row change. Its columns are

``db, tbl``       the source table
``op``            ``I``, ``U`` or ``D``
key columns       the primary key of the row the delta applies to
``before``        struct, the row before the change; null for an insert
``after``         struct, the row after the change; null for a delete
``epoch, filename, offset``   the log position; a backfill row has ``('', 0)``
``seq``           the row's ordinal among the rows at that position
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

INSERT, UPDATE, DELETE = "I", "U", "D"
POSITION = ("epoch", "filename", "offset")
# One delta is identified by its table, position and ordinal, and the key of its row:
# all rows of a backfill are at one position.
DELTA_ID = ("db", "tbl", *POSITION, "seq")
# Key columns stand beside these, so they need other names.
DELTA_COLUMNS = ("db", "tbl", "op", "before", "after", *POSITION, "seq")
# Log positions start here, so offset 0 marks a backfill row.
FIRST_LOG_OFFSET = 4
BACKFILL_FILENAME, BACKFILL_OFFSET = "", 0


@dataclass(frozen=True)
class TableSpec:
    """A source table: database, name, columns, and primary key columns in order."""

    db: str
    name: str
    schema: StructType
    key: tuple[str, ...] = ()

    def __post_init__(self):
        missing = [c for c in self.key if c not in self.schema.fieldNames()]
        if missing:
            raise ValueError(f"primary key columns {missing} are not in {self.table_id}")
        taken = [c for c in self.key if c in DELTA_COLUMNS]
        if taken:
            raise ValueError(f"rename the key columns {taken} of {self.table_id}: deltas use "
                             "these names")

    @property
    def table_id(self) -> str:
        return f"{self.db}.{self.name}"
