"""Packing of token streams into sequences, by dynamic programming over their boundaries.

The documents of a partition, in their order, are one stream of tokens. A sequence is a
window of the stream. Windows may end at the end of a document for nothing, at the end of a
sentence for a small penalty, and inside a long sentence for a larger one. A window of L
tokens costs its padding on top, so the best cost of ending a window at place p_j is

    cost[j] = penalty[j] + size - p_j + min(cost[i] + p_i)   over p_j - size <= p_i < p_j

where the minimum over the sliding window comes from a monotone queue. A window whose length
is a power of two is not padded; the last tokens of a partition make such sequences.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from millrace.llm.words import slices, split_words

# Where the tokens of a window may be cut, and what a cut costs in tokens of padding.
SENTENCE, INSIDE = 4, 64

# In a stretch without the end of a sentence, a cut is possible after so many tokens.
STRETCH = 256

# Windows are chosen for this many tokens at once; what follows the last is carried on.
BLOCK = 400_000

# Words whose ids are remembered in a process, in each of two generations.
REMEMBERED = 120_000

SENTENCE_ENDS = frozenset(".!?")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Encoder:
    """Ids of texts by a tokenizer that never joins tokens over white space.

    The ids of a text are then those of its pieces between white space. Most pieces are a
    word of Latin-1 letters, with at most one mark after it. Such a word is not changed by
    normalizing but for its case, so its ids come from the tokenizer's model directly, once
    as long as it is remembered. All other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {code: as_bytes.pre_tokenize_str(chr(code))[0][0]
                        for code in range(128, 256)}
        self.marks = {mark: self._whole(mark) for mark in ".,"}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, piece: str) -> bytes:
        return _packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes | None:
        """The ids of a word of Latin-1 letters in lower case, or None if it is not one."""
        if not word.isalpha():
            return None
        if not word.isascii():
            if max(word) > "\u00ff":
                return None
            word = word.translate(self.letters)
        return _packed([token.id for token in self.tokenizer.model.tokenize(word)])

    def _piece(self, piece: str) -> bytes:
        last = piece[-1]
        mark = self.marks.get(last, b"")
        word = (piece[:-1] if mark else piece).lower()
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                found = self._word(word)
            if found is None:
                return self._whole(piece)
            self.young[word] = found
        return found + mark if mark else found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each text begins in them, and the ends of sentences.

        The last two are the places of ids after which a sentence may end, and their text.
        """
        words = split_words(texts)
        pieces = words.vocabulary.to_pylist()
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        lists = [self._piece(piece) if piece else b"" for piece in pieces]
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // 4
        ends = np.array([piece[-1:] in SENTENCE_ENDS for piece in pieces], dtype=bool)
        flat = np.frombuffer(b"".join(lists), dtype=np.uint32)
        firsts = np.cumsum(lengths) - lengths
        codes = words.codes
        sizes = lengths[codes]
        after = np.cumsum(sizes)
        ids = flat[np.repeat(firsts[codes] - (after - sizes), sizes) + np.arange(
            after[-1] if len(after) else 0)]
        starts = np.concatenate(([0], after))[words.starts]
        at = np.nonzero(ends[codes])[0]
        owner = np.searchsorted(words.starts, at, side="right") - 1
        return ids, starts, after[at], owner


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this process, kept from task to task."""
    return Encoder(path)


@dataclass
class Stream:
    """Documents that are not packed yet, in order, as one stream of tokens."""

    size: int
    doc_ids: deque = field(default_factory=deque)
    tokens: deque[np.ndarray] = field(default_factory=deque)
    packed: deque[int] = field(default_factory=deque)
    # Places inside a document where a sentence ends.
    sentences: deque[np.ndarray] = field(default_factory=deque)
    waiting: int = 0

    def add(self, doc_id, tokens: np.ndarray, sentences: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.tokens.append(tokens)
        self.packed.append(0)
        self.sentences.append(sentences)
        self.waiting += len(tokens)

    def boundaries(self) -> tuple[np.ndarray, np.ndarray]:
        """The places where windows may end, in tokens that wait, and their penalties."""
        places, penalties, before = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for tokens, packed, sentences in zip(self.tokens, self.packed, self.sentences):
            length = len(tokens) - packed
            inner = sentences[(sentences > packed) & (sentences < len(tokens))] - packed
            known = np.concatenate(([0], inner, [length]))
            gaps = np.diff(known)
            extra = [np.arange(known[k] + STRETCH, known[k + 1], STRETCH)
                     for k in np.nonzero(gaps > STRETCH)[0]]
            here = np.concatenate([inner, *extra, [length]])
            cost = np.full(len(here), INSIDE, dtype=np.int64)
            cost[:len(inner)], cost[-1] = SENTENCE, 0
            order = np.argsort(here, kind="stable")
            places.append(before + here[order])
            penalties.append(cost[order])
            before += length
        return np.concatenate(places), np.concatenate(penalties)

    def windows(self) -> list[int]:
        """The lengths of the best windows, without what is left for the next block."""
        places, penalties = (a.tolist() for a in self.boundaries())
        size, last = self.size, places[-1]
        cost, cut = [0] * len(places), [0] * len(places)
        # (cost[i] + p_i, i) with falling costs taken out: the first is the least.
        queue = deque([(0, 0)])
        for j in range(1, len(places)):
            place = places[j]
            while places[queue[0][1]] < place - size:
                queue.popleft()
            least, cut[j] = queue[0]
            cost[j] = least + penalties[j] + size - place
            value = cost[j] + place
            while queue and queue[-1][0] >= value:
                queue.pop()
            queue.append((value, j))
        # Any window near the end may be the last; the cheapest for the tokens it covers.
        ends = [j for j in range(1, len(places)) if places[j] > last - size]
        j = min(ends, key=lambda j: (cost[j] / places[j], -j))
        found = []
        while j:
            found.append(places[j] - places[cut[j]])
            j = cut[j]
        return found[::-1]

    def take(self, length: int) -> list[tuple]:
        """The pieces of the next ``length`` tokens: doc, start, length, crc, doc tokens, offset."""
        pieces, offset = [], 0
        while offset < length:
            tokens, start = self.tokens[0], self.packed[0]
            part = min(length - offset, len(tokens) - start)
            crc = zlib.crc32(tokens[start:start + part].astype("<u4").tobytes())
            pieces.append((self.doc_ids[0], start, part, crc, len(tokens), offset))
            offset += part
            self.packed[0] += part
            if self.packed[0] == len(tokens):
                for column in (self.doc_ids, self.tokens, self.packed, self.sentences):
                    column.popleft()
        self.waiting -= length
        return pieces


def powers(length: int) -> list[int]:
    """``length`` as a sum of powers of two, the greatest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2) -> DataFrame:
    """The pieces of all documents (doc_id, text) in sequences of at most ``size`` tokens.

    A document is the ids of its text by the tokenizer file ``tokenizer``, without special
    tokens, and ``end_id`` after them; a null text counts as empty and is just that id.
    A piece is ``length`` tokens of a document from ``start`` on, at ``offset`` of a sequence;
    each token lies in one piece, and a sequence's pieces have no gaps. Sequences keep the
    order of documents within a partition of the input; nothing is shuffled, and a task holds
    one slice of texts and one block of tokens. The last tokens of a partition are cut into
    sequences of a power of two each, which need no padding.

    A null doc_id stays null; repeated rows are packed one by one; columns other than doc_id
    and text are not read; an empty table gives no rows. ``size`` must be a power of two.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = encoder_of(tokenizer), Stream(size)
        sequence = TaskContext.get().partitionId() << 36
        found: list[tuple] = []

        def out(lengths: list[int]) -> None:
            nonlocal sequence
            for length in lengths:
                found.extend((*piece[:5], sequence, piece[5]) for piece in stream.take(length))
                sequence += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 7
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                       "offset"])

        for batch in batches:
            for rows, texts in slices(batch, "text"):
                ids, starts, ends, owner = encoder(texts)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                for k, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    tokens = np.append(ids[starts[k]:starts[k + 1]], np.uint32(end_id))
                    stream.add(doc_id, tokens, ends[bounds[k]:bounds[k + 1]] - starts[k])
                    if stream.waiting >= BLOCK:
                        out(stream.windows())
                if found:
                    yield batch_of()
        while stream.waiting >= size:
            out(stream.windows())
        out(powers(stream.waiting))
        yield batch_of()

    return docs.select("doc_id", "text").mapInArrow(packed, SCHEMA)
