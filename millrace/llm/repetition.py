"""Quality rules on repetition inside a text, from a suffix array of its words.

The suffixes of all texts of a slice are sorted together by prefix doubling, a text's own
number first, so that texts never mix. The longest common prefix of a suffix with its two
neighbours in that order is the depth of the deepest longest-common-prefix interval that
holds it, that is, the length of the longest repeat that starts there. Each such repeat is
maximal to the right by construction; repeats that only continue one that started a word
earlier fall into that one's span, so the union of spans is that of the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.words import slices, split_words

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """What a text may hold.

    ``span_words`` is the shortest repeat that counts as copied; a share of at most
    ``covered`` of the words may lie in such repeats, and the longest may take at most
    ``longest`` of the words, in short texts too. So many ``allowed_words`` would be allowed
    in both cases whatever their share; there are none. The rest are the base rules.
    """

    span_words: int = 8
    covered: float = 0.3
    longest: float = 0.2
    allowed_words: int = 0
    least_words: int = 50
    repeat_words: int = 3
    repeated: float = 0.5


def longest_repeats(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every word, how many words from there on also stand elsewhere in the same text."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ends = starts[1:][text]
    keys = text * (int(codes.max()) + 1) + codes
    order = np.argsort(keys)
    ranks = _ranks(keys[order], np.zeros(n, dtype=np.int64))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = ranks
    levels, step = [(1, rank.astype(np.int32))], 1
    active = _tied(order, ranks)
    while len(active):
        ahead = active + step
        inside = ahead < ends[active]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = rank[active]
        keys = own * (n + 1) + second
        order = np.argsort(keys)
        ranks = _ranks(keys[order], own[order])
        rank[active[order]] = ranks
        step *= 2
        levels.append((step, rank.astype(np.int32)))
        active = _tied(active[order], ranks)
    return _neighbours(np.argsort(rank), ends, levels)


def _ranks(keys: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Places of sorted ``keys`` among all suffixes, equal for equal keys.

    ``base`` is the place of the group that was split, or 0 for the first sorting.
    """
    place = np.arange(len(keys))
    fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
    group = np.concatenate(([True], base[1:] != base[:-1]))
    first = np.maximum.accumulate(np.where(group, place, 0))
    return np.maximum.accumulate(np.where(fresh, base + place - first, 0))


def _tied(order: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The suffixes that share their rank with another one."""
    same = ranks[1:] == ranks[:-1]
    return order[np.concatenate((same, [False])) | np.concatenate(([False], same))]


def _neighbours(suffixes: np.ndarray, ends: np.ndarray,
                levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """The longer of the common prefixes with the suffix before and the one after."""
    n = len(suffixes)
    first, second = suffixes[:-1], suffixes[1:]
    rank = levels[0][1]
    pairs = np.nonzero(rank[first] == rank[second])[0]
    length = np.zeros(len(pairs), dtype=np.int64)
    a, b = first[pairs].copy(), second[pairs].copy()
    end_a, end_b = ends[a], ends[b]
    for step, rank in reversed(levels):
        fits = (a + step <= end_a) & (b + step <= end_b)
        equal = fits & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        moved = equal * step
        length += moved
        a += moved
        b += moved
    common = np.zeros(n + 1, dtype=np.int64)
    common[pairs + 1] = length
    longest = np.empty(n, dtype=np.int64)
    longest[suffixes] = np.maximum(common[:-1], common[1:])
    return longest


def covered_words(longest: np.ndarray, starts: np.ndarray, least: int,
                  width: int | None = None) -> np.ndarray:
    """Per text, the words in the union of its repeats of at least ``least`` words.

    With ``width``, each of them counts with its first ``width`` words only.
    """
    at = np.nonzero(longest >= least)[0]
    change = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + (longest[at] if width is None else width), -1)
    inside = np.cumsum(change)[:-1] > 0
    return np.diff(np.concatenate(([0], np.cumsum(inside)))[starts])


def _of_text(text: str) -> tuple[int, int, int]:
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return chars, symbols, len(lines) - len(set(lines))


def measure(texts: pa.Array, limits: Limits = Limits()) -> pa.RecordBatch:
    """One row of counts and verdicts for each text."""
    words = split_words(texts)
    starts, n_words = words.starts, np.diff(words.starts)
    longest = longest_repeats(words.codes, starts)
    repeated = covered_words(longest, starts, limits.repeat_words, limits.repeat_words)
    covered = covered_words(longest, starts, limits.span_words)
    most = np.zeros(len(n_words), dtype=np.int64)
    filled = n_words > 0
    if filled.any():
        most[filled] = np.maximum.reduceat(longest, starts[:-1][filled])
    own = [_of_text(text) for text in texts.to_pylist()]
    chars, symbols, lines = (np.array(c, dtype=np.int64) for c in zip(*own))
    failed = (n_words < limits.least_words) | (repeated > limits.repeated * n_words)
    passed = ((covered <= np.maximum(limits.covered * n_words, limits.allowed_words))
              & (most <= np.maximum(limits.longest * n_words, limits.allowed_words)))
    return pa.RecordBatch.from_pydict({
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines,
        "n_repeat_words": repeated, "n_covered_words": covered, "longest_repeat": most,
        "base_failed": failed, "kept": ~failed & passed,
    })


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, n_covered_words long, longest_repeat long, base_failed boolean, "
          "kept boolean")


def repetition(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The counts and the verdict for every row of ``docs`` (doc_id, text).

    Nothing is shuffled: a text is judged where it is read, whole, and one task holds no
    more than one slice of texts at a time. Null and empty texts have no words and fail the
    base rule; a null ``doc_id`` stays null; repeated rows are judged one by one; columns
    other than doc_id and text are not read. An empty table gives no rows.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                found = measure(texts, limits)
                ids = rows.column("doc_id").cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, *found.columns], names=["doc_id", *found.schema.names])

    return docs.select("doc_id", "text").mapInArrow(judge, SCHEMA)


def without_repetition(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they are.

    Behaves as :func:`repetition` does; columns of any name are kept.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                yield rows.filter(pa.array(pc.fill_null(measure(texts, limits)["kept"], False)))

    return docs.mapInArrow(kept, docs.schema)
