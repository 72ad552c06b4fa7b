"""Near duplicates: the exact Jaccard join of word shingles, with signature trees.

1. Every text becomes its set of shingle hashes; equal sets become one (``set_id``).
2. Two linked sets share one of their first tokens in any order common to all sets, if as
   many are taken as the similarity asks for (the prefix filter). The order puts tokens that
   were seen often last, so passages that many texts share hardly ever count as first.
3. Sets that share a first token fall into one group, named by its least set. Equal groups
   of different tokens thus fall together, and sets alone in their group are gone.
4. A group of any size is dealt into cells of bounded size: blocks of it, in pairs.
5. In every cell a signature tree (:mod:`millrace.llm.signatures`) over the sets' bitmaps
   finds which sets may be linked, directly or through others, and leaves out the rest.
6. Sets that may be linked over any cells come together in one cell of their own, if it is not
   too large; else they stay in the cells of step 4. So hardly a set's tokens go to two places.
7. The tokens are fetched, and a second tree compares them exactly. It tells what is linked in
   the cell; components are joined over all cells.

Texts are read three times, which costs less than storing or shuffling their token sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.signatures import bitmap, bitmap_bits, folded, links, may_be_joined, rooted
from millrace.llm.words import LOWER, slices, split_words, unused, word_hashes
from millrace.session import has_at_most, stored

WORDS = 5
PERCENT = 80

# A token seen this often in one slice of texts is reported as frequent. So many of the most
# frequent ones are put last in the order of tokens; this bounds what is broadcast (16 bytes
# a token) and has no influence on the result, only on the number of pairs compared.
OFTEN, ORDERED = 4, 65_536

# A frequent token's sets are spread over tasks of about this many.
SALTED = 2_000

# Up to so many rows of two ids, a list of documents is broadcast to where the texts are read.
BROADCAST_IDS = 1_000_000

# A cell holds two blocks of at most about this many sets, and this many tokens.
CELL_SETS, CELL_TOKENS = 1_000, 1_000_000

# What names a cell: its group, and the two blocks of it that meet.
CELL = ("leader", "i", "j")



def _salt(words: int) -> np.uint64:
    """A number that tells shingles of different lengths apart."""
    return np.uint64(words * 0x9E3779B97F4A7C15 % 2**64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes.

    A text of fewer than five words, but not none, has one shingle of all its words.
    """
    words = split_words(texts, LOWER)
    hashes = word_hashes(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(
        0, dtype=np.uint64)
    n = len(hashes)
    factors = _mixed(np.array([_salt(k + 1) for k in range(WORDS)])) | np.uint64(1)
    rolled = np.zeros(max(n - WORDS + 1, 0), dtype=np.uint64)
    for k in range(WORDS):
        rolled += hashes[k:k + len(rolled)] * factors[k]
    rolled = _mixed(rolled + _salt(WORDS))
    found, starts = [], words.starts.tolist()
    for first, last in zip(starts, starts[1:]):
        count = last - first
        if count >= WORDS:
            tokens = np.sort(rolled[first:last - WORDS + 1])
            found.append(tokens[np.concatenate(([True], tokens[1:] != tokens[:-1]))])
        elif count:
            short = (hashes[first:last] * factors[:count]).sum(keepdims=True)
            found.append(_mixed(short + _salt(count)))
        else:
            found.append(np.zeros(0, dtype=np.uint64))
    return found


def _set_ids(sets: list[np.ndarray]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(s) for s in sets), dtype=np.uint64, count=len(sets)).view(np.int64)


def _survey(docs: DataFrame) -> DataFrame:
    """A row for each document, and one (token, seen) for each frequent token of a slice."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                sets = shingle_sets(texts)
                tokens, seen = np.unique(np.concatenate(sets), return_counts=True)
                often = seen >= OFTEN
                tokens, seen = tokens[often].view(np.int64), seen[often]
                none, blank = pa.nulls(len(tokens), pa.int64()), pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([rows.column("doc_id").cast(pa.int64()), none]),
                    pa.concat_arrays([pa.array([len(s) for s in sets], pa.int64()), none]),
                    pa.concat_arrays([pa.array(_set_ids(sets)), none]),
                    pa.concat_arrays([pa.array(
                        [bitmap(s, bitmap_bits(len(s))).tobytes() if len(s) else None
                         for s in sets], pa.binary()), pa.nulls(len(tokens), pa.binary())]),
                    pa.concat_arrays([blank, pa.array(tokens)]),
                    pa.concat_arrays([blank, pa.array(seen, pa.int64())]),
                    pa.concat_arrays([rows.column("text_hash"), none]),
                ], names=["doc_id", "n_shingles", "set_id", "bitmap", "token", "seen", "text_hash"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        look, "doc_id long, n_shingles long, set_id long, bitmap binary, token long, seen long, "
        "text_hash long")


def _first_tokens(tokens: np.ndarray, frequent: np.ndarray, seen: np.ndarray,
                  percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a set that a linked set must share one of, and how often each was seen."""
    n = len(tokens)
    count = n - -(-percent * n // 100) + 1
    if not len(frequent):
        return tokens[:count], np.zeros(count, dtype=np.int64)
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    weight = np.where(frequent[at] == tokens, seen[at], 0)
    order = np.argsort(weight, kind="stable")[:count]
    return tokens[order], weight[order]


def _postings(docs: DataFrame, frequent: DataFrame, percent: int) -> DataFrame:
    """(token, salt, set_id) for the first tokens of every set; salt -1 for the usual token."""
    spark = docs.sparkSession
    table = frequent.collect()
    tokens = np.array([row.token for row in table], dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    shared = spark.sparkContext.broadcast(
        (tokens[order], np.array([row.seen for row in table], dtype=np.int64)[order]))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent_tokens, seen = shared.value
        for batch in batches:
            for _, texts in slices(batch, "text"):
                sets = shingle_sets(texts)
                ids = _set_ids(sets)
                # Copies within a slice are posted once.
                _, once = np.unique(ids, return_index=True)
                parts = [(ids[i], *_first_tokens(sets[i], frequent_tokens, seen, percent))
                         for i in once if len(sets[i])]
                if not parts:
                    continue
                counts = [len(p[1]) for p in parts]
                owner = np.repeat(np.array([p[0] for p in parts], dtype=np.int64), counts)
                token = np.concatenate([p[1] for p in parts]).view(np.int64)
                weight = np.concatenate([p[2] for p in parts])
                salts = weight // SALTED + 1
                salt = np.where(weight >= SALTED, owner.view(np.uint64) % salts.view(np.uint64),
                                np.uint64(0)).astype(np.int32)
                salt[weight < SALTED] = -1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token), pa.array(salt), pa.array(owner)],
                    names=["token", "salt", "set_id"])

    return docs.select("text").mapInArrow(post, "token long, salt int, set_id long")


def _groups(postings: DataFrame) -> DataFrame:
    """(leader, set_id): the sets that share a first token, under the least of them."""
    same = Window.partitionBy("token", "salt")
    shared = stored(
        postings.withColumn("least", F.min("set_id").over(same))
        .withColumn("greatest", F.max("set_id").over(same))
        .where("salt >= 0 or least < greatest").drop("greatest"), "postings")
    salted = shared.where("salt >= 0")
    # A row for each of the tokens that are ordered, so this is bounded, and hot tokens stay dealt.
    leaders = F.broadcast(salted.groupBy("token").agg(F.min("least").alias("leader")))
    return (shared.where("salt < 0").select(F.col("least").alias("leader"), "set_id")
            .unionByName(salted.join(leaders, "token").select("leader", "set_id")).distinct())


def _cells(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(leader, i, j, set_id) and the set's size and bitmap: which sets meet in which cell.

    The bitmaps are added last, so that only the move into the cells is one of bitmaps.
    """
    members = groups.join(sets.select("set_id", "n_shingles"), "set_id")
    blocks = (members.groupBy("leader")
              .agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("tokens"))
              .where("members > 1")
              .select("leader", F.ceil(F.greatest(
                  F.col("members") / CELL_SETS, F.col("tokens") / CELL_TOKENS)).alias("blocks")))
    dealt = members.join(blocks, "leader").withColumn(
        "own", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    met = dealt.select(
        "leader", "set_id", "n_shingles", "own",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"),
    ).select("leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
             "set_id", "n_shingles")
    return met.join(sets.select("set_id", "bitmap"), "set_id")


def _by_cell(rows: DataFrame) -> DataFrame:
    """``rows`` with those of a cell together, in one task."""
    cell = [F.col(c) for c in CELL]
    return rows.repartition(*cell).sortWithinPartitions(*cell)


def _each_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after the other; cells stand together."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [np.asarray(batch.column(c)) for c in CELL]
        change = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        first = tuple(int(key[0]) for key in keys)
        change[0] = first != last
        last = tuple(int(key[-1]) for key in keys)
        starts = np.nonzero(change)[0].tolist()
        for start, end in zip([0, *starts], [*starts, batch.num_rows]):
            if start in starts and waiting:
                yield pa.Table.from_batches(waiting)
                waiting = []
            if end > start:
                waiting.append(batch.slice(start, end - start))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _possible(cells: DataFrame, percent: int) -> DataFrame:
    """(leader, i, j, set_id, n_shingles, least) of the sets that may be linked in their cell.

    ``least`` is the least set that it may be linked with there, directly or through others.
    """

    def joined(sizes: np.ndarray, maps: list[bytes]) -> np.ndarray:
        bits = np.array([8 * len(m) for m in maps])
        pairs = []
        # Linked sets differ by less than two in size, so their bitmaps are of one length,
        # or one is twice as long and is folded.
        for width in np.unique(bits).tolist():
            at = np.nonzero((bits == width) | (bits == 2 * width))[0]
            order = at[np.lexsort((sizes[at], np.log(sizes[at]) // np.log(1.25)))]
            masks = np.stack([folded(np.frombuffer(maps[k], dtype=np.uint64), width)
                              for k in order])
            pairs.append(order[may_be_joined(masks, sizes[order], percent)])
        return rooted(len(maps), np.concatenate(pairs))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _each_cell(batches):
            if cell.num_rows > 1:
                ids = np.asarray(cell["set_id"])
                order = np.argsort(ids)
                cell, ids = cell.take(pa.array(order)), ids[order]
                root = joined(np.asarray(cell["n_shingles"], dtype=np.int64),
                              cell["bitmap"].to_pylist())
                some = pa.array(np.bincount(root, minlength=len(root))[root] > 1)
                kept = cell.select([*CELL, "set_id", "n_shingles"]).append_column(
                    "least", pa.array(ids[root])).filter(some)
                yield from kept.to_batches()

    return _by_cell(cells).mapInArrow(
        choose, "leader long, i long, j long, set_id long, n_shingles long, least long")


def _together(possible: DataFrame) -> DataFrame:
    """(leader, i, j, set_id): the cells in which the sets of ``possible`` are to be compared.

    Sets that may be linked, over whatever cells, are one cell if they fit two blocks; its i and j
    are -1. Sets of larger components are compared in the cells that they have.
    """
    joined = components(possible.select(F.col("set_id").alias("a"), F.col("least").alias("b")))
    sized = possible.select("set_id", "n_shingles").distinct().join(
        joined.withColumnRenamed("node", "set_id"), "set_id")
    small = (sized.groupBy("root")
             .agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("tokens"))
             .where((F.col("members") <= 2 * CELL_SETS) & (F.col("tokens") <= 2 * CELL_TOKENS))
             .select("root", F.lit(True).alias("whole")))
    placed = stored(sized.join(small, "root", "left").select("set_id", "root", "whole"), "placed")
    alone = placed.where("whole").select(
        F.col("root").alias("leader"), F.lit(-1).cast("long").alias("i"),
        F.lit(-1).cast("long").alias("j"), "set_id")
    large = possible.join(placed.where("whole is null").select("set_id"), "set_id")
    return alone.unionByName(large.select(*CELL, "set_id"))


def _tokens(texts: DataFrame) -> DataFrame:
    """(set_id, tokens), once for each set. A text that has another set is left out."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, arrays in slices(batch, "text"):
                sets = shingle_sets(arrays)
                ids = np.asarray(rows.column("set_id"))
                at = np.nonzero(ids == _set_ids(sets))[0]
                sets = [sets[k] for k in at]
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))],
                    names=["set_id", "tokens"])

    return texts.select("set_id", "text").mapInArrow(
        tokens, "set_id long, tokens array<long>").dropDuplicates(["set_id"])


def _edges(cells: DataFrame, percent: int) -> DataFrame:
    """(a, b) for every set a that is linked in its cell with others, b being the least of them."""

    def compare(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = np.asarray(cell["set_id"])
        sets = [np.asarray(s.values).view(np.uint64) for s in cell["tokens"]]
        sizes = np.array([len(s) for s in sets])
        order = np.lexsort((sizes, [s[0] for s in sets], np.log(sizes) // np.log(1.25)))
        found = np.array(links([sets[k] for k in order], percent), dtype=np.int64).reshape(-1, 2)
        by_id = np.argsort(ids)
        place = np.argsort(by_id)
        root = rooted(len(ids), place[order[found]])
        linked = root != np.arange(len(ids))
        return ids[by_id[linked]], ids[by_id[root[linked]]]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _each_cell(batches):
            if cell.num_rows > 1:
                a, b = compare(cell)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _by_cell(cells).mapInArrow(find, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``n_shingles`` is the number of distinct five-word shingles; ``component_id`` is the
    least doc_id that can be reached over links (itself included). Two documents are linked
    when 100 * intersection >= ``percent`` * union. No link is lost, whatever the groups' sizes:
    comparisons are left out only when they cannot link, or when both sides are linked already
    through others. Shingles and sets are known by 64-bit hashes.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows with equal
    sets, repeated rows included, are one component; each row is returned. A null doc_id
    is null in its own row, and never names a component while another id can. Columns other
    than doc_id and text are not read. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    survey = stored(_survey(docs), "survey")
    frequent = (survey.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
                .orderBy(F.desc("seen"), "token").limit(ORDERED))
    found = survey.where("token is null").drop("token", "seen")
    sets = found.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"),
        F.first("bitmap").alias("bitmap"))
    groups = _groups(_postings(docs, frequent, percent))
    cells = _together(stored(_possible(_cells(groups, sets), percent), "cells"))
    edges = _edges(cells.join(_tokens(_texts(cells, docs, found)), "set_id"), percent)
    linked = components(edges).withColumnRenamed("node", "set_id")
    named = sets.join(linked, "set_id", "left").select(
        "set_id", "first_id", F.coalesce("root", "set_id").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "root").select("set_id", "component_id")
    return _classed(found, classes)


def _texts(cells: DataFrame, docs: DataFrame, found: DataFrame) -> DataFrame:
    """(set_id, text) for each set of ``cells``: the text of its first document.

    The text counts as well as the id, which many rows may share or have none of: only copies of
    one text come more than once.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    wanted = stored(
        found.groupBy("set_id").agg(first.alias("first"))
        .join(cells.select("set_id").distinct(), "set_id").select(
            "set_id", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")),
        "wanted")
    if has_at_most(wanted, BROADCAST_IDS):
        wanted = F.broadcast(wanted)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(wanted, same).select("set_id", "text")


def _classed(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Every document with its class; one without shingles is a class of its own."""
    some = found.where("n_shingles > 0").join(classes, "set_id").select(
        "doc_id", "n_shingles", "component_id")
    return some.unionByName(found.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, each doc_id once.

    Rows without shingles, and rows whose doc_id is null, are kept as they are: nothing is
    known to repeat them. Of several rows with one doc_id that stays, the one with the least text
    does. All columns are kept, whatever their names.
    """
    name, rows, least, gone = unused(docs, "id", "rows", "least", "gone")
    classes = near_duplicates(docs, percent).where("doc_id is not null")
    told = (classes.groupBy(F.col("doc_id").alias(name))
            .agg(F.count(F.lit(1)).alias(rows), F.min("component_id").alias(least))
            .withColumn(gone, F.col(least) < F.col(name))
            .where(F.col(gone) | (F.col(rows) > 1)).select(name, gone))
    told = stored(told, "told")
    if has_at_most(told, BROADCAST_IDS):
        told = F.broadcast(told)
    marked = docs.join(told, F.col("doc_id") == F.col(name), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    first = F.min_by(F.struct(*columns), F.struct(F.col("text").isNull(), F.col("text")))
    repeated = marked.where(~F.col(gone)).groupBy(F.col("doc_id").alias(name)).agg(
        first.alias(rows)).select(f"{rows}.*")
    return marked.where(F.col(name).isNull()).select(*columns).unionByName(repeated)
