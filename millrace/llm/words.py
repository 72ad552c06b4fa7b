"""Texts as Arrow arrays: slices of bounded size, and words as numbered codes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

# Bytes of text that are worked on at once. One longer text is a slice of its own.
SLICE_BYTES = 4_000_000

# Rows of an Arrow batch: both sides of the pipe hold a few batches whole.
BATCH_ROWS = 2_500

_UPPER = bytes(range(65, 91))

# A-Z become a-z; everything else stays, so white space separates the words.
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())

# A-Z become a-z, and every ASCII byte but 0-9 and a-z becomes a space.
ALPHANUMERIC = bytes(
    LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class Words(NamedTuple):
    """The words of some texts: text ``i`` holds ``codes[starts[i]:starts[i + 1]]``.

    A code is the word's place in ``vocabulary``, an array of distinct words.
    """

    codes: np.ndarray
    starts: np.ndarray
    vocabulary: pa.Array


def small_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold no more than ``BATCH_ROWS`` rows.

    Texts are long rows, so the usual number of them is tens of megabytes. Results do not depend
    on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` as names that ``df`` has no columns of: with as many underscores as it takes."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def slices(batch: pa.RecordBatch, text: str,
           most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """``batch`` in slices of bounded text size, each with its texts (null: empty)."""
    texts = pc.fill_null(batch.column(text).cast(pa.string()), "")
    sizes = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
    first = 0
    while first < len(texts):
        before = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(first, end - first), texts.slice(first, end - first)
        first = end
        # What a slice needed goes back to the system: other stages share the executor.
        pa.default_memory_pool().release_unused()


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """``texts`` with every byte replaced by its place in ``table`` (ASCII for ASCII)."""
    _, offsets, data = texts.buffers()
    data = (data.to_pybytes() if data else b"").translate(table)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, pa.py_buffer(data)],
                                 offset=texts.offset)


def split_words(texts: pa.Array, table: bytes | None = None) -> Words:
    """The words between ASCII white space, after ``table`` if there is one."""
    if table is not None:
        texts = translated(texts, table)
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, vocabulary = np.asarray(words.indices), words.dictionary
    offsets = offsets - offsets[0]
    # White space at either end of a text leaves an empty word there.
    empty = pc.index(vocabulary, "").as_py()
    if empty >= 0:
        kept = codes != empty
        before = np.concatenate(([0], np.cumsum(kept)))
        codes, offsets = codes[kept], before[offsets]
    return Words(codes.astype(np.int64), offsets, vocabulary)


def word_hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word, the same in every process."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in vocabulary.cast(pa.binary()).to_pylist()),
                       dtype=np.uint64, count=len(vocabulary))
