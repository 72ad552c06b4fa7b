"""All named queries."""

from . import joining, merging, rows, scans, splitting, streams  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
