"""Hard negatives by threshold joins with an inverted index, as L2AP does them.

A search finds, for anchors in blocks of bounded size, the first few rows whose inner product
with the anchor lies in a window. Within a slice of rows the dimensions are taken in one order,
and a row is indexed under dimension after dimension only until the norm of what is left of it,
its suffix, is below the least threshold of any anchor over that anchor's norm: a row that
reaches a threshold shares an indexed dimension with the anchor. The scores are accumulated list
by list; after each few lists a pair goes whose score so far and the product of both remaining
norms stay below its threshold. What is left is scored in whole numbers.

Thresholds begin high and are lowered for the anchors whose windows are not full, until they are,
or the window's own bound is reached. So a window that is full after the first round has had few
candidates, and none is ever capped: what a round finds at or above its threshold is all there is.
See Anastasiu and Karypis, "L2AP: Fast cosine similarity search with prefix L-2 norm bounds".
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import new_folder, stored

# Components become floor(SCALE * c).
SCALE = 256

# A row whose squares sum to more may have scores beyond a long.
LARGEST = 2.0 ** 62

# Bytes of the anchors that are searched for at once, and so are sent to every task.
BLOCK_BYTES = 16_000_000

# Numbers of a slice of rows, and of the scores of a tile of anchors and rows.
CELLS, TILE = 1_000_000, 2_000_000

# Index lists that are accumulated between two prunings, and the share of pairs below which
# those left are scored one by one.
LISTS, FEW = 8, 0.02

# Rounds of the positives: the threshold as a share of the greatest score there can be.
SHARES = (0.5, 0.25, 0.125)

# Rounds of the negatives: how much of the window, from its top, is searched.
DEPTHS = (0.25, 0.5)


@dataclass(frozen=True)
class Windows:
    """A block of anchors and the windows that are searched for them.

    Window ``k`` is of the anchor ``owner[k]`` and holds scores from ``low[k]`` to ``high[k]``, of
    rows with the anchor's label (``same``) or with others; ``first`` are wanted. The anchors are
    rows of whole numbers.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    first: int


@dataclass
class Found:
    """The best rows of each window so far: of several slices the first ``most`` together."""

    most: int
    window: np.ndarray
    row: np.ndarray
    score: np.ndarray

    def add(self, window: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        window, row, score = (np.concatenate(both) for both in (
            (self.window, window), (self.row, row), (self.score, score)))
        order = np.lexsort((row, -score, window))
        window, row, score = window[order], row[order], score[order]
        begins = np.searchsorted(window, window, side="left")
        kept = np.arange(len(window)) - begins < self.most
        self.window, self.row, self.score = window[kept], row[kept], score[kept]

    def least(self, windows: int) -> np.ndarray:
        """The score that a further row of each window must reach; -1 on none."""
        counts = np.bincount(self.window, minlength=windows)
        least = np.full(windows, np.iinfo(np.int64).min)
        full = counts >= self.most
        last = np.cumsum(counts) - 1
        least[full] = self.score[last[full]]
        return least


def norms_left(rows: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The norms of the rows from each cut to the end, a column for each cut."""
    squares = rows.astype(float) ** 2
    after = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    after = np.column_stack([after, np.zeros(len(rows))])
    return np.sqrt(after[:, cuts])


def candidates(anchors: np.ndarray, rows: np.ndarray, low: np.ndarray,
               allowed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (anchor, row) that may reach the anchor's threshold ``low``; none that does is missing.

    ``allowed(anchors, rows)`` tells for a tile which pairs count at all.
    """
    width = rows.shape[1]
    cuts = list(range(0, width, LISTS)) + [width]
    order = np.argsort(-(anchors.astype(float) ** 2).sum(axis=0), kind="stable")
    a, x = anchors[:, order].astype(float), rows[:, order].astype(float)
    a_left, x_left = norms_left(a, cuts), norms_left(x, cuts)
    # Sums of doubles are off by less than this share of the product of both norms.
    slack = 1 + 1e-9
    reach = np.full(len(a), -np.inf)
    positive = low > 0
    reach[positive] = low[positive] / (np.maximum(a_left[positive, 0], 1e-300) * slack)
    # The index: a row is in the lists of the dimensions before its suffix falls below all reach.
    lists = (x_left >= reach.min()).sum(axis=1)
    by_lists = np.argsort(-lists, kind="stable")
    x, x_left, lists = x[by_lists], x_left[by_lists], lists[by_lists]
    indexed = int((lists > 0).sum())
    step = max(1, TILE // max(indexed, 1))
    for first in range(0, len(a) if indexed else 0, step):
        tile = slice(first, first + step)
        scores = np.zeros((len(a[tile]), indexed))
        alive = allowed(tile, by_lists[:indexed])
        bound = (low[tile].astype(float) - 1)[:, None]
        for k, (begin, end) in enumerate(zip(cuts, cuts[1:])):
            # A row whose lists have ended is judged once, by what was left of it there.
            n, before = (int((lists[:indexed] > c).sum()) for c in (k, k - 1))
            exactness = 1e-9 * a_left[tile, 0, None] * x_left[None, :before, 0]
            ended = a_left[tile, k, None] * x_left[None, n:before, k] * slack
            alive[:, n:before] &= scores[:, n:before] + ended + exactness[:, n:] >= bound
            scores[:, :n] += a[tile, begin:end] @ x[:n, begin:end].T
            left = a_left[tile, k + 1, None] * x_left[None, :n, k + 1] * slack
            alive[:, :n] &= scores[:, :n] + left + exactness[:, :n] >= bound
            if alive.mean() < FEW:
                break
        pairs = np.nonzero(alive)
        yield pairs[0] + first, by_lists[pairs[1]]


def _exact(anchors: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    step = max(1, CELLS // max(rows.shape[1], 1))
    return np.concatenate([np.zeros(0, np.int64)] + [
        np.einsum("ij,ij->i", anchors[i[k:k + step]], rows[j[k:k + step]])
        for k in range(0, len(i), step)])


def search(windows: Windows, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray,
           found: Found) -> None:
    """Add to ``found`` what a slice of rows has for the windows."""
    # What is found already raises the threshold of a window for the slices after.
    low = np.maximum(windows.low, found.least(len(windows.owner)))
    wanted = np.full(len(windows.ids), np.iinfo(np.int64).max)
    np.minimum.at(wanted, windows.owner, low)
    searched = np.unique(windows.owner)

    def allowed(tile: slice, of: np.ndarray) -> np.ndarray:
        which = searched[tile]
        same = windows.labels[which, None] == labels[None, of]
        if not windows.same:
            return ~same
        return same & (windows.ids[which, None] != ids[None, of])

    by_owner = np.argsort(windows.owner, kind="stable")
    begins = np.searchsorted(windows.owner[by_owner], searched)
    counts = np.searchsorted(windows.owner[by_owner], searched, side="right") - begins
    for i, j in candidates(windows.vectors[searched], rows, wanted[searched], allowed):
        score = _exact(windows.vectors, rows, searched[i], j)
        reached = score >= wanted[searched[i]]
        i, j, score = i[reached], j[reached], score[reached]
        # Each pair meets all windows of its anchor.
        each = np.repeat(np.arange(len(i)), counts[i])
        place = np.arange(len(each)) - np.repeat(np.cumsum(counts[i]) - counts[i], counts[i])
        window = by_owner[begins[i[each]] + place]
        inside = (score[each] >= low[window]) & (score[each] <= windows.high[window])
        each, window = each[inside], window[inside]
        found.add(window, ids[j[each]], score[each])


def _filled(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of one matrix, shorter ones filled up with zeros."""
    lengths = np.asarray(pc.list_value_length(column)).astype(np.int64)
    filled = np.zeros((len(lengths), width), dtype=np.int64)
    filled[np.arange(width) < lengths[:, None]] = np.asarray(column.flatten())
    return filled


FOUND = "window long, row long, score long"


def _search(rows: DataFrame, windows: Windows) -> DataFrame:
    """The first rows of each window over all ``rows``: window, row, score, rank, n in all."""
    width = windows.vectors.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(windows)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, nothing = shared.value, np.zeros(0, np.int64)
        best = Found(block.first, nothing, nothing, nothing)
        step = max(1, CELLS // max(width, 1))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                some = batch.slice(first, step)
                search(block, np.asarray(some.column("vec_id")), np.asarray(some.column("label")),
                       _filled(some.column("x"), width), best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (best.window, best.row, best.score)],
            names=["window", "row", "score"])

    order = W.partitionBy("window").orderBy(F.desc("score"), "row")
    return (rows.select("vec_id", "label", "x").mapInArrow(found, FOUND)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= windows.first)
            .withColumn("n", F.count("*").over(W.partitionBy("window"))))


def _rounds(rows: DataFrame, windows: Windows, wanted: np.ndarray,
            lows: list[np.ndarray]) -> Iterator[DataFrame]:
    """What each round found for the windows that it closes: window, row, score and rank.

    A window is closed when it holds as many rows as ``wanted``, or with the last of ``lows``. A
    threshold of a round that is no higher than the last one's is the last.
    """
    spark = rows.sparkSession
    open_ = np.nonzero(wanted > 0)[0]
    for k, low in enumerate(lows):
        if not len(open_):
            return
        some = replace(windows, owner=windows.owner[open_], high=windows.high[open_],
                       low=low[open_])
        found = stored(_search(rows, some), "found")
        full = wanted[open_]
        last = (low[open_] <= lows[-1][open_]) | (k == len(lows) - 1)
        counts = np.zeros(len(open_), dtype=np.int64)
        # Of the block's windows, each of which is one row here.
        for row in found.where("rank = 1").select("window", "n").collect():
            counts[row.window] = row.n
        closed = last | (counts >= full)
        names = spark.createDataFrame(
            [(int(w), int(open_[w])) for w in np.nonzero(closed)[0]], "window long, name long")
        yield found.join(F.broadcast(names), "window").select(
            F.col("name").alias("window"), "row", "score", "rank")
        open_ = open_[~closed]


def whole(vector: Column) -> Column:
    """The vector's components as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, none null, and its scores fit into a long."""
    finite = F.forall(vector, lambda c: F.coalesce(
        (F.abs(c.cast("double")) <= LARGEST), F.lit(False)))
    squares = F.aggregate(vector, F.lit(0.0), lambda s, c: s + F.pow(F.floor(
        F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double"))) * SCALE)
        .cast("double"), F.lit(2.0)))
    return F.coalesce(finite & (squares <= LARGEST), F.lit(False))


def labelled_vectors(embeddings: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, x`` of the rows that take part, one for each vec_id."""
    return (embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull()
                             & usable(F.col("embedding")))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.struct(label.cast("long").alias("label"),
                             whole(F.col("embedding")).alias("x")).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v.*"))


SCHEMA = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


@dataclass(frozen=True)
class Mining:
    """What is mined: positives an anchor, negatives a positive, and the window in hundredths."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def hard_negatives(embeddings: DataFrame, label: Column, anchor: Column,
                   mining: Mining = Mining()) -> DataFrame:
    """The first negatives of each positive of each anchor, from ``embeddings`` (vec_id, embedding).

    ``label`` is an expression over the rows, and ``anchor`` one over ``vec_id`` that tells which
    rows are anchors. A score is the whole inner product of two rows; higher scores come first,
    ties by smaller vec_id. The positives of an anchor are its first other rows of its label; the
    negatives of a positive are the first rows of other labels whose score with the anchor is
    between ``low`` and ``high`` hundredths of the positive's.

    Rows with a null vec_id, label or vector, with a component that is null or not finite, or
    whose squares sum to more than 2^62 take no part. Of several rows with one vec_id the one with
    the least label and then vector counts. Shorter vectors count as filled up with zeros. An
    empty table, and anchors without positives, give no rows. Other columns are not read.

    The rows are shuffled once, by vec_id, and written. The anchors are the only broadcast, in
    blocks of ``BLOCK_BYTES``; a block searches all rows in a few rounds, and a round's shuffle has
    at most the wanted number of rows for each window and task, those at or above its threshold.
    Only ids and scores of one block's windows pass through the driver.
    """
    spark = embeddings.sparkSession
    rows = stored(labelled_vectors(embeddings, label), "vectors")
    size = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    labels = stored(rows.groupBy("label").agg(
        F.count("*").alias("rows"), F.max(F.size("x")).alias("width"),
        F.max(size).alias("square")), "labels")
    width = labels.agg(F.max("width").alias("w")).first().w or 0
    anchors = rows.where(anchor)
    blocks = max(1, -(-anchors.count() * (width + 4) * 8 // BLOCK_BYTES))
    anchors = stored(
        anchors.join(labels.drop("width"), "label")
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "anchors")
    folder = new_folder(spark, "negatives")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    for block in range(blocks):
        table = anchors.where(F.col("block") == block).orderBy("vec_id").toArrow()
        if table.num_rows:
            for part in _mined(rows, table.combine_chunks(), width, mining):
                part.write.mode("append").parquet(folder)
    return spark.read.schema(SCHEMA).parquet(folder)


def _mined(rows: DataFrame, table: pa.Table, width: int, mining: Mining) -> Iterator[DataFrame]:
    """The results of one block of anchors, one table for each round that closed windows."""
    spark = rows.sparkSession
    ids = np.asarray(table["vec_id"]).astype(np.int64)
    vectors = _filled(table["x"].combine_chunks(), width)
    labels = np.asarray(table["label"]).astype(np.int64)
    none, all_ = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    everyone = np.arange(len(ids))
    windows = Windows(ids, labels, vectors, everyone, np.full(len(ids), none),
                      np.full(len(ids), all_), True, mining.positives)
    # No score of an anchor is above the product of its norm and the greatest of its label.
    most = np.sqrt((vectors.astype(float) ** 2).sum(axis=1) * np.asarray(table["square"]))
    wanted = np.minimum(np.asarray(table["rows"]) - 1, mining.positives)
    lows = [np.minimum(most * share, 2.0 ** 62).astype(np.int64) for share in SHARES]
    positives = []
    for found in _rounds(rows, windows, wanted, [*lows, windows.low]):
        # At most ``positives`` rows for each anchor of the block.
        positives += [(r.window, r.rank, r.row, r.score) for r in found.collect()]
    positives.sort()
    if not positives:
        return
    owner, _, _, score = (np.array(c, dtype=np.int64) for c in zip(*positives))
    # 80 p <= 100 n <= 100 p in whole numbers, without leaving the range of a long.
    low, high = (np.array([f(int(s)) for s in score], dtype=np.int64) for f in (
        lambda s: -(-mining.low * s // 100), lambda s: mining.high * s // 100))
    keys = spark.createDataFrame(
        [(k, int(ids[o]), p, s) for k, (o, _, p, s) in enumerate(positives)],
        "window long, anchor_id long, positive_id long, positive_score long")
    windows = replace(windows, owner=owner, low=low, high=high, same=False,
                      first=mining.negatives)
    lows = [np.maximum(low, (high - (high - low) * depth).astype(np.int64)) for depth in DEPTHS]
    wanted = np.where(high >= low, mining.negatives, 0)
    for found in _rounds(rows, windows, wanted, [*lows, low]):
        yield found.join(F.broadcast(keys), "window").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
            F.col("row").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))


SQL = """
WITH valid AS (
  SELECT vec_id, label, [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, x
  FROM valid),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
    list_inner_product(a.x, r.x)::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER w)::INTEGER AS rank,
  s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id
  AND NOT s.same AND 80 * p.positive_score <= 100 * s.score
  AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id)
QUALIFY rank <= 5
"""
