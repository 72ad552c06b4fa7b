"""Token ids as flat binary files with 64-bit offsets, written by partition and memory-mapped.

A folder of token files holds, for each part of the documents in ascending doc_id order,

``tokens-<part>-<attempt>.bin``   the ids of its documents one after the other, unsigned,
                                  little-endian, of two bytes if every id fits, else four
``offsets-<part>-<attempt>.bin``  one unsigned 64-bit number more than the part has documents:
                                  where each begins in the part, and where the last ends
``ids-<part>-<attempt>.bin``      the doc_ids, signed 64-bit; those of the part's first
                                  ``n_null`` documents stand for null
``manifest``                      a table of the parts that count, with the number of documents
                                  and of ids before each: the prefix sums of the parts before

A task that runs again writes files of other names, and only the files of the attempt that
Spark commits are in the manifest, so a lost executor leaves nothing that is ever read.
"""

from __future__ import annotations

import string
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from millrace.llm.words import slices
from millrace.session import stored

# Words whose ids are remembered in a process, in each of two generations.
REMEMBERED = 200_000

# Words of letters below this are one piece to the tokenizer, whatever its tables of letters.
LATIN_END = "\u0250"

# Those characters after a word of letters are a piece of their own.
MARKS = string.punctuation

# Bytes of text that are encoded at once: the more, the fewer words are looked up.
SLICE_BYTES = 8_000_000

# Ids that are read back at once.
READ_IDS = 2_000_000


class ByteEncoder:
    """Ids of texts by a byte-level tokenizer without a normalizer, remembered by word.

    Such a tokenizer begins a new piece at every blank that follows something other than white
    space. So a text's ids are those of its parts cut before these blanks, and the same part
    has the same ids everywhere. Most parts are a blank and a word of Latin letters, which is one
    piece whose ids come from the tokenizer's model directly, the marks after it, which are
    another, and at times the end of a line and more words. All else goes through the whole
    tokenizer. Words are remembered.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # The character that stands for each byte; one that is no character alone is never asked for.
        self.letters = {byte: as_bytes.pre_tokenize_str(chr(byte))[0][0] for byte in range(128)}
        for code in range(128, 0x250):
            for byte, letter in zip(chr(code).encode(), as_bytes.pre_tokenize_str(chr(code))[0][0]):
                self.letters[byte] = letter
        self.newline = self._whole("\n")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _ids(self, part: str) -> bytes:
        """The ids of a part that is not remembered."""
        word = part.removeprefix(" ")
        if word.isalpha() and max(word) < LATIN_END:
            part = part.encode().decode("latin-1").translate(self.letters)
            return array("I", [token.id for token in self.tokenizer.model.tokenize(part)]).tobytes()
        return self._whole(part)

    def _lists(self, parts: list[str]) -> list[bytes]:
        """The ids of each part."""
        young, old = self.young, self.old

        def remembered(part: str) -> bytes:
            found = young.get(part)
            if found is None:
                found = old.get(part)
                if found is None:
                    found = self._ids(part)
                young[part] = found
            return found

        def ids(part: str) -> bytes:
            word = part.rstrip(MARKS)
            # A word and the marks after it are two pieces.
            if len(word) < len(part) and word.removeprefix(" ").isalpha():
                return remembered(word) + remembered(part[len(word):])
            return remembered(part)

        lists = []
        for part in parts:
            if "\n" in part:
                lines = part.split("\n")
                # A line's end between two things that are no white space is a piece.
                if all(line and not line[-1].isspace() for line in lines) and not any(
                        line[0].isspace() for line in lines[1:]):
                    lists.append(self.newline.join(map(ids, lines)))
                    continue
            lists.append(ids(part))
        return lists

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text begins in them."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        split = pc.split_pattern(texts, " ")
        offsets = np.asarray(split.offsets, dtype=np.int64)
        words = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        codes = np.asarray(words.indices).astype(np.int64)
        vocabulary = words.dictionary.to_pylist()
        # A blank after white space, or after nothing, does not begin a part.
        holds = np.array([not w or w[-1].isspace() for w in vocabulary], dtype=bool)
        first = np.zeros(len(codes), dtype=bool)
        first[offsets[:-1]] = True
        begins = first.copy()
        begins[1:] |= ~holds[codes[:-1]]
        at = np.nonzero(begins)[0]
        ends = np.append(at[1:], len(codes))
        # The number of a part of one word tells the word and whether a blank is before it.
        numbers = codes[at] * 2 + ~first[at]
        longer: dict[str, int] = {}
        for k in np.nonzero(ends - at > 1)[0].tolist():
            part = " ".join(vocabulary[c] for c in codes[at[k]:ends[k]].tolist())
            part = part if first[at[k]] else " " + part
            numbers[k] = longer.setdefault(part, 2 * len(vocabulary) + len(longer))
        present = np.zeros(2 * len(vocabulary) + len(longer), dtype=bool)
        present[numbers] = True
        short = np.nonzero(present[:2 * len(vocabulary)])[0].tolist()
        parts = [" " + vocabulary[n >> 1] if n & 1 else vocabulary[n >> 1] for n in short]
        lists = self._lists(parts + list(longer))
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), dtype=np.uint32)
        places = np.cumsum(lengths) - lengths
        which = (np.cumsum(present) - 1)[numbers]
        sizes = lengths[which]
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        ids = flat[np.repeat(places[which] - (after - sizes), sizes) + np.arange(total)]
        starts = np.concatenate(([0], after))[np.searchsorted(at, offsets)]
        return ids, starts


@lru_cache(maxsize=1)
def encoder_of(path: str) -> ByteEncoder:
    """The encoder of this process, kept from task to task."""
    return ByteEncoder(path)


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


PART = ("part long, tokens string, offsets string, ids string, n_docs long, n_null long, "
        "n_tokens long, width int")
MANIFEST = f"{PART}, docs_before long, tokens_before long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the ids of all documents (doc_id, text) below ``folder``; returns the manifest.

    A document is the ids of its whole text by the byte-level tokenizer file ``tokenizer``,
    without special tokens, and ``end_id`` after them; a null text counts as empty. Documents
    are in ascending doc_id order over all parts, null ids first; rows that share an id, repeated
    rows too, are kept one by one in the order of the input. Other columns are not read. An
    empty table has an empty manifest.

    The one shuffle deals out the texts by ranges of (doc_id, row number), so an id that many
    rows share is no single task's. A task holds one slice of texts, and eight bytes twice for
    each document of its part. ``folder`` must be one that all executors share.
    """
    last = max(Tokenizer.from_file(tokenizer).get_vocab().values(), default=0)
    width = 2 if max(last, end_id) < 1 << 16 else 4

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, dtype = encoder_of(tokenizer), np.dtype(f"<u{width}")
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        names = [f"{kind}-{part:06d}-{attempt}.bin" for kind in ("tokens", "offsets", "ids")]
        files, root = place(folder)
        out, lengths, ids, nulls = None, [], [], 0
        for batch in batches:
            for rows, texts in slices(batch, "text", SLICE_BYTES):
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{names[0]}")
                tokens, starts = encoder(texts)
                # The end of document k moves by the k ends before it.
                out.write(np.insert(tokens, starts[1:], end_id).astype(dtype).tobytes())
                lengths.append(np.diff(starts) + 1)
                doc_ids = rows.column("doc_id")
                nulls += doc_ids.null_count
                ids.append(np.asarray(pc.fill_null(doc_ids.cast(pa.int64()), 0)))
        if out is None:
            return
        out.close()
        ends = np.cumsum(np.concatenate(lengths))
        for name, column in ((names[1], np.concatenate(([0], ends)).astype("<u8")),
                             (names[2], np.concatenate(ids).astype("<i8"))):
            with files.open_output_stream(f"{root}/{name}") as stream:
                stream.write(column.tobytes())
        row = (part, *names, len(ends), nulls, int(ends[-1]), width)
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int32() if k == 7 else None) for k, v in enumerate(row)],
            names=["part", "tokens", "offsets", "ids", "n_docs", "n_null", "n_tokens", "width"])

    ordered = (docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row"))
    parts = stored(ordered.select("doc_id", "text").mapInArrow(written, PART), "parts")
    # One row a task, so the driver adds them up.
    rows = sorted(map(tuple, parts.collect()))
    before = [accumulate((row[k] for row in rows), initial=0) for k in (4, 6)]
    spark = docs.sparkSession
    manifest = spark.createDataFrame(
        [(k, *row[1:], *sums) for k, (row, *sums) in enumerate(zip(rows, *before))], MANIFEST)
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class Flat:
    """A flat binary file as an array: memory-mapped where it is local, else read by ranges."""

    def __init__(self, files: fs.FileSystem, path: str, dtype: str) -> None:
        self.dtype = np.dtype(dtype)
        self.local = (np.memmap(path, dtype=self.dtype, mode="r")
                      if isinstance(files, fs.LocalFileSystem) else None)
        self.remote = None if self.local is not None else files.open_input_file(path)

    def __getitem__(self, span: slice) -> np.ndarray:
        if self.local is not None:
            return self.local[span]
        size = self.dtype.itemsize
        first = span.start or 0
        end = self.remote.size() // size if span.stop is None else span.stop
        return np.frombuffer(self.remote.read_at((end - first) * size, first * size), self.dtype)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from its files.

    ``start`` is the number of ids of all documents before it, over all parts, and
    ``ids_crc32`` that of its ids as unsigned 32-bit numbers. One task reads a part, some
    millions of ids at once; a longer document is read whole.
    """
    manifest = read_manifest(spark, folder)
    parts = manifest.count()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = place(folder)
        for batch in batches:
            for part in batch.to_pylist():
                offsets = Flat(files, f"{root}/{part['offsets']}", "<u8")
                tokens = Flat(files, f"{root}/{part['tokens']}", f"<u{part['width']}")
                ids = Flat(files, f"{root}/{part['ids']}", "<i8")
                yield from _part(part, tokens, np.asarray(offsets[:]).astype(np.int64), ids)

    # The manifest has one row a part, and each goes to a task of its own.
    numbers = spark.range(0, max(parts, 1), 1, max(parts, 1))
    dealt = numbers.join(F.broadcast(manifest), numbers["id"] == manifest["part"]).drop("id")
    return dealt.mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _part(part: dict, tokens: Flat, offsets: np.ndarray, ids: Flat) -> Iterator[pa.RecordBatch]:
    """The documents of one part, in batches of about ``READ_IDS`` ids."""
    first = 0
    while first < part["n_docs"]:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + READ_IDS, "right")) - 1)
        flat = tokens[slice(int(offsets[first]), int(offsets[end]))].astype("<u4")
        at = offsets[first:end + 1] - offsets[first]
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(at, at[1:])]
        null = np.arange(first, end) < part["n_null"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[slice(first, end)].astype(np.int64), mask=null),
             pa.array(offsets[first:end] + part["tokens_before"]),
             pa.array(np.diff(at)), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])
        first = end
