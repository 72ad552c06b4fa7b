"""Quality classifier by co-training of two views: a text's content, and its metadata.

Each view has a linear classifier of its own. In each round both are trained, and what one is
confident of among all documents without labels becomes a label for the other: a pass over them
adds up their features by label and by how the other view sees them so far. At the end each view is
calibrated on labelled rows that were held out, and a calibrated sum of both scores every
document. There are two such classifiers: for quality, and for toxic content.

Only the labelled rows are a bounded sample, which is documented in :class:`Sample`; all other
documents take part, and scoring reads every document whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.repetition import SYMBOLS
from millrace.llm.words import ALPHANUMERIC, Words, slices, split_words, translated, word_hashes

# Words and their beginnings are hashed to so many features each.
HASHED = 1 << 16

# The beginning of a word, in bytes.
PREFIX = 5

# Sources are hashed to so many features.
SOURCES = 64

# Confident documents are added up by the other view's logit, rounded down and cut at so much.
MARGIN = 4
MARGINS = 2 * MARGIN + 1

# Sums of features are whole numbers of so many parts: any order of adding gives the same.
PARTS = 1 << 20

STYLE = ("upper", "symbols", "marks", "word length", "distinct", "lines", "log words")


@dataclass(frozen=True)
class Sample:
    """What the classifiers are trained on.

    About ``labelled`` rows of the labels for each of quality and toxic, half of them of each
    class, by hash of their id; a class with fewer rows has them all, and the other one has the
    rest. They are weighed by how many rows each stands for. A share of ``held_out`` of each class
    is for calibration. All other documents are the pool (``pool`` bounds it to so many of least
    hash; None: all), labelled ones that are not in the sample too. What a view
    is at least ``confident`` of is a label for the other; together such labels of a class weigh at
    most ``pool_weight`` of its labelled rows. All words count, those of the pool too.
    """

    labelled: int = 6000
    pool: int | None = None
    held_out: float = 0.25
    rounds: int = 3
    confident: float = 0.98
    pool_weight: float = 0.1


def _distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the distinct words of each text, by text."""
    text = np.repeat(np.arange(len(words.starts) - 1), np.diff(words.starts))
    width = max(len(words.vocabulary), 1)
    pairs = np.unique(text * width + words.codes)
    return pairs // width, pairs % width


def _word_features(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The two features of each word: itself, and its beginning."""
    starts = pa.array([w[:PREFIX] for w in vocabulary.cast(pa.binary()).to_pylist()], pa.binary())
    size = np.uint64(HASHED)
    return ((word_hashes(vocabulary) % size).astype(np.int64),
            (word_hashes(starts) % size).astype(np.int64) + HASHED)


def _style(text: str, n_words: int, distinct: int) -> list[float]:
    """How a text is written, as numbers of about the same size."""
    chars = max(len(text), 1)
    letters = sum(map(str.isupper, text)) if not text.islower() else 0
    return [letters / chars, sum(map(text.count, SYMBOLS)) / chars * 10,
            (text.count("!") + text.count("?")) / chars * 10, min(chars / max(n_words, 1), 20) / 10,
            distinct / max(n_words, 1), min(text.count("\n") / max(n_words, 1), 1.0),
            np.log1p(n_words) / 10]


def text_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """(text, code, ...) of distinct words, the style of each text, and the words."""
    words = split_words(translated(texts, ALPHANUMERIC))
    owner, code = _distinct_words(words)
    distinct = np.bincount(owner, minlength=len(texts))
    counts = np.diff(words.starts)
    style = np.array([_style(t, int(n), int(d)) for t, n, d in zip(
        texts.to_pylist(), counts, distinct)]).reshape(len(texts), len(STYLE))
    return owner, code, style, words


def metadata_view(langs: list, sources: list, n_chars: list) -> np.ndarray:
    """The features of each row's language, source and stated length, one column each."""
    size = np.uint64(SOURCES)
    out = np.zeros((len(langs), 2 * SOURCES + 2))
    for shift, values in ((0, langs), (SOURCES, sources)):
        names = pa.array([v or "" for v in values], pa.string())
        at = (word_hashes(names) % size).astype(np.int64) + shift
        out[np.arange(len(at)), at] = 1
    length = np.log1p(np.maximum(np.array([v or 0 for v in n_chars], dtype=float), 0)) / 10
    out[:, -2], out[:, -1] = length, length ** 2
    return out


class Rows:
    """Sparse rows of numbers, which know two products with a vector."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray,
                 width: int) -> None:
        self.starts, self.columns, self.values, self.width = starts, columns, values, width
        self.owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.values * weights[self.columns], minlength=len(self))

    def transposed_dot(self, amounts: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * amounts[self.owner], minlength=self.width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted(rows: Rows, labels: np.ndarray, weight: np.ndarray, ridge: float = 1.0,
           steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression by limited-memory quasi-Newton steps."""
    total = max(weight.sum(), 1e-9)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.dot(w)
        value = (weight * np.logaddexp(0, np.where(labels > 0, -z, z))).sum()
        slope = rows.transposed_dot(weight * (_sigmoid(z) - labels))
        return ((value + ridge / 2 * w @ w) / total, (slope + ridge * w) / total)

    w = np.zeros(rows.width)
    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        step = slope.copy()
        kept = []
        for s, y in reversed(past):
            a = (s @ step) / (y @ s)
            kept.append(a)
            step -= a * y
        if past:
            s, y = past[-1]
            step *= (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(kept)):
            step += (a - (y @ step) / (y @ s)) * s
        length = 1.0 if past else 1 / max(np.abs(step).sum(), 1e-9)
        while True:
            new = w - length * step
            new_value, new_slope = loss(new)
            if new_value <= value - 1e-4 * length * (slope @ step) or length < 1e-8:
                break
            length /= 2
        change, turn = new - w, new_slope - slope
        done = value - new_value < 1e-6 * abs(value)
        w, value, slope = new, new_value, new_slope
        if done:
            break
        if turn @ change > 1e-12:
            past = [*past[-9:], (change, turn)]
    return w


def calibration(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of (1, scores...) that make them the logit of a probability; none is negative.

    Too few labels of a class give a constant: the share of positives.
    """
    weight = weight * (len(weight) / max(weight.sum(), 1e-9))
    share = (weight @ labels + 1) / (len(labels) + 2)
    constant = np.zeros(scores.shape[1] + 1)
    constant[0] = np.log(share / (1 - share))
    if min(labels.sum(), (1 - labels).sum()) < 5:
        return constant
    columns = np.arange(scores.shape[1] + 1)
    used = columns
    while len(used) > 1:
        values = np.column_stack([np.ones(len(scores)), scores])[:, used]
        rows = Rows(np.arange(len(scores) + 1) * len(used), np.tile(np.arange(len(used)), len(scores)),
                    values.ravel(), len(used))
        found = fitted(rows, labels, weight, ridge=0.1)
        bad = [c for c, w in zip(used, found) if c and w < 0]
        if not bad:
            constant[:] = 0
            constant[used] = found
            return constant
        used = np.array([c for c in used if c not in bad])
    return constant


@dataclass
class Model:
    """The weights of one target: for each view, and for their calibrated sum."""

    words: np.ndarray
    style: np.ndarray
    metadata: np.ndarray
    views: tuple[np.ndarray, np.ndarray]
    both: np.ndarray

    def calibrated(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, ...]:
        """The probabilities by content, by metadata, and by both."""
        logits = [v[0] + v[1] * s for v, s in zip(self.views, (text, metadata))]
        both = self.both[0] + self.both[1] * logits[0] + self.both[2] * logits[1]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(both)


def _held_out(truth: np.ndarray, share: float) -> np.ndarray:
    """For each row the number of rows of its class it stands for when held out; else 0."""
    found = np.zeros(len(truth))
    for label in (0, 1):
        own = np.nonzero(truth == label)[0]
        # Few rows of a class are halved, so that calibration has some of them.
        step = max(2, round(1 / share)) if len(own) >= 20 else 2
        found[own[::step]] = step
    return found


def _fit_weights(truth: np.ndarray, held: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weights of the rows that are fitted: both classes weigh the same, a row 1 on average."""
    use = (truth >= 0) & (held == 0)
    found = np.where(use, weight, 0.0)
    for label in (0, 1):
        own = use & (truth == label)
        found[own] *= use.sum() / 2 / max(found[own].sum(), 1e-9)
    return found


def _stacked(rows: Rows, matrix: np.ndarray) -> Rows:
    """``rows`` and below them those of ``matrix``."""
    owner, columns = np.nonzero(matrix)
    sizes = np.bincount(owner, minlength=len(matrix))
    return Rows(np.concatenate((rows.starts, rows.starts[-1] + np.cumsum(sizes))),
                np.concatenate((rows.columns, columns)),
                np.concatenate((rows.values, matrix[owner, columns])), rows.width)


@dataclass
class Target:
    """Both views' classifiers of one target while they are trained."""

    views: tuple[Rows, Rows]
    truth: np.ndarray
    held: np.ndarray
    weight: np.ndarray
    pool_weight: float

    def __post_init__(self) -> None:
        self.use = _fit_weights(self.truth, self.held, self.weight)
        self.at = np.nonzero(self.held)[0]
        self.weights = [np.zeros(v.width) for v in self.views]
        self.calibrations = [np.zeros(2), np.zeros(2)]

    def calibration(self, scores: np.ndarray) -> np.ndarray:
        at = self.at
        return calibration(scores, self.truth[at].astype(float), self.weight[at] * self.held[at])

    def fit(self, k: int, sums: np.ndarray) -> None:
        """Fit view ``k`` to its labelled rows and to (label, margin, feature) sums of others."""
        rows, labels, weight = self.views[k], np.maximum(self.truth, 0), self.use
        for label in (0, 1):
            number = sums[label, :, -1]  # the last feature is 1 in all documents
            own = number > 0
            if own.any():
                most = self.use[self.truth == label].sum() * self.pool_weight
                rows = _stacked(rows, sums[label, own] / number[own][:, None])
                labels = np.append(labels, np.full(own.sum(), label))
                weight = np.append(weight, number[own] * min(1, most / number.sum()))
        if 0 < (weight * labels).sum() < weight.sum():
            self.weights[k] = fitted(rows, labels.astype(float), weight)
        scores = self.views[k].dot(self.weights[k])[self.at]
        self.calibrations[k] = self.calibration(scores[:, None])

    def both(self) -> np.ndarray:
        return self.calibration(np.column_stack([
            c[0] + c[1] * v.dot(w)[self.at]
            for c, v, w in zip(self.calibrations, self.views, self.weights)]))


def _chosen(docs: DataFrame, labels: DataFrame, sample: Sample) -> DataFrame:
    """(doc_id, quality, toxic, weight) of the labelled sample."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic")
    ).where("quality is not null or toxic is not null").join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = known.groupBy("quality", "toxic").count().collect()
    rate = F.lit(0.0)
    for target in ("quality", "toxic"):
        n = [sum(r["count"] for r in counts if r[target] == label) for label in (0, 1)]
        for label in (0, 1):
            most = max(sample.labelled // 2, sample.labelled - n[1 - label])
            rate = F.greatest(rate, F.when(
                F.col(target) == label, F.lit(min(1.0, most / max(n[label], 1)))).otherwise(0.0))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    return known.withColumn("rate", rate).where(place < F.col("rate")).select(
        "doc_id", "quality", "toxic", (1 / F.col("rate")).alias("weight"))


def _features(rows: DataFrame) -> DataFrame:
    """The sample's rows as features: distinct words with their counts, style, metadata."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                owner, code, style, words = text_view(texts)
                own, begin = _word_features(words.vocabulary)
                pairs, counts = np.unique(np.concatenate([
                    owner * 2 * HASHED + own[code], owner * 2 * HASHED + begin[code]]),
                    return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(texts) + 1) * 2 * HASHED)
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, kind))
                         for v, kind in ((pairs % (2 * HASHED), pa.int32()), (counts, pa.int32()))]
                columns = [part.column(c).to_pylist() for c in ("lang", "source", "n_chars")]
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("doc_id", "quality", "toxic", "weight")), *lists,
                    pa.array(list(style), pa.list_(pa.float64())),
                    pa.array(list(metadata_view(*columns)), pa.list_(pa.float64()))],
                    names=["doc_id", "quality", "toxic", "weight", "words", "counts", "style",
                           "metadata"])

    return rows.mapInArrow(
        describe, "doc_id long, quality int, toxic int, weight double, words array<int>, "
        "counts array<int>, style array<double>, metadata array<double>")


def _dense(matrix: np.ndarray) -> Rows:
    n, width = matrix.shape
    return Rows(np.arange(n + 1) * width, np.tile(np.arange(width), n), matrix.ravel(), width)


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    return np.array(table[name].to_pylist(), dtype=float).reshape(-1, width)


def _lists(table: pa.Table, name: str) -> list[np.ndarray]:
    """The lists of a column, without a Python object for each number."""
    return [np.asarray(chunk.values)[first:end] for chunk in table[name].chunks
            for first, end in zip(chunk.offsets.to_pylist(), chunk.offsets.to_pylist()[1:])]


TARGETS = ("quality", "toxic")


def train(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> dict[str, Model]:
    """The models of ``quality`` and ``toxic``, from labels (doc_id, quality, toxic)."""
    chosen = _chosen(docs, labels, sample)
    texts = docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    table = _features(texts).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    counts, columns = _lists(table, "counts"), _lists(table, "words")
    style = _matrix(table, "style", len(STYLE))
    metadata = _dense(np.column_stack([
        _matrix(table, "metadata", 2 * SOURCES + 2), np.ones(len(table))]))
    views = (_text_rows(columns, counts, style), metadata)
    weight = np.array(table["weight"].to_pylist(), dtype=float)
    targets = []
    for name in TARGETS:
        truth = np.array([-1 if v is None else v for v in table[name].to_pylist()], dtype=int)
        targets.append(Target(views, truth, _held_out(truth, sample.held_out), weight,
                              sample.pool_weight))

    def models() -> dict[str, Model]:
        return {name: Model(target.weights[0][: 2 * HASHED], target.weights[0][2 * HASHED:],
                            target.weights[1], tuple(target.calibrations), target.both())
                for name, target in zip(TARGETS, targets)}

    pool = _pool(docs, table["doc_id"].to_pylist(), sample)
    sums = [[np.zeros((2, MARGINS, v.width)) for v in views] for _ in targets]
    fresh = {(t, k) for t in range(len(targets)) for k in range(len(views))}
    for turn in range(sample.rounds + 1):
        for t, k in sorted(fresh):
            targets[t].fit(k, sums[t][k])
        if turn == sample.rounds:
            break
        new = _pool_sums(pool, models(), sample.confident)
        # A view whose labels come from one that was not fitted again has the same labels.
        fresh = {(t, k) for t in range(len(targets)) for k in range(len(views))
                 if (t, 1 - k) in fresh and (new[t][k].any() or sums[t][k].any())}
        sums = new
        if not fresh:
            break
    return models()


def _pool(docs: DataFrame, sampled: list[int], sample: Sample) -> DataFrame:
    """The documents that have no part in the labelled sample."""
    spark = docs.sparkSession
    ids = spark.createDataFrame([(k,) for k in sampled], "doc_id long")
    pool = docs.join(F.broadcast(ids), "doc_id", "left_anti")
    if sample.pool is None:
        return pool
    least = pool.select("doc_id").where("doc_id is not null").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample.pool)
    return pool.join(F.broadcast(least), "doc_id", "left_semi")


def _pool_sums(pool: DataFrame, models: dict[str, Model],
               confident: float) -> list[list[np.ndarray]]:
    """For each target and view, (label, margin, feature) sums over all documents of the pool
    that the other view is confident of.

    ``margin`` is the view's own logit. Each task adds up its documents; what comes to the driver
    has a number for each feature, however many documents there are.
    """
    widths = (2 * HASHED + len(STYLE) + 1, 2 * SOURCES + 3)
    sizes = [2 * MARGINS * w for w in widths]
    names = list(models)
    shared = pool.sparkSession.sparkContext.broadcast(models)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sums = [[np.zeros((2 * MARGINS, w)) for w in widths] for _ in names]
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                seen = Described.of(rows, texts)
                columns = (seen.own, seen.begin)
                for model, (of_text, of_metadata) in zip(map(known.get, names), sums):
                    logits = [v[0] + v[1] * score for v, score in zip(
                        model.views, seen.scores(model))]
                    margins = [np.clip(np.floor(z), -MARGIN, MARGIN).astype(int) + MARGIN
                               for z in logits]
                    kinds = []
                    for k in (0, 1):
                        chance = _sigmoid(logits[1 - k])
                        kinds.append(np.where(chance >= confident, MARGINS + margins[k], np.where(
                            1 - chance >= confident, margins[k], -1)))
                    sure = kinds[0] >= 0
                    for column in columns if sure.any() else ():
                        here = sure[seen.owner]
                        owner = seen.owner[here]
                        of_text += np.bincount(
                            kinds[0][owner] * widths[0] + column[seen.code[here]],
                            1 / seen.root[owner], minlength=sizes[0]).reshape(of_text.shape)
                    np.add.at(of_text[:, 2 * HASHED:], kinds[0][sure], seen.style[sure])
                    sure = kinds[1] >= 0
                    np.add.at(of_metadata, kinds[1][sure], seen.metadata[sure])
        flat = np.rint(np.concatenate([v.ravel() for own in sums for v in own]) * PARTS)
        at = np.nonzero(flat)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(flat[at].astype(np.int64))], names=["at", "parts"])

    found = pool.mapInArrow(add, "at long, parts long").groupBy("at").agg(
        F.sum("parts").alias("parts")).toArrow()
    flat = np.zeros(len(names) * sum(sizes))
    flat[found["at"].to_numpy()] = found["parts"].to_numpy() / PARTS
    shared.destroy()
    cuts = np.cumsum(sizes * len(names))[:-1]
    parts = [part.reshape(2, MARGINS, -1) for part in np.split(flat, cuts)]
    return [parts[2 * t:2 * t + 2] for t in range(len(names))]


def _text_rows(columns: list[np.ndarray], counts: list[np.ndarray], style: np.ndarray) -> Rows:
    """The content view: words by the root of the number of distinct words, style, and 1."""
    tail = 2 * HASHED + np.arange(len(STYLE) + 1)
    at, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for own, count, manner in zip(columns, counts, style):
        at += (own, tail)
        values += (count / np.sqrt(max(count.sum() / 2, 1)), np.append(manner, 1.0))
    sizes = [len(own) + len(tail) for own in columns]
    return Rows(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), np.concatenate(at),
                np.concatenate(values), 2 * HASHED + len(STYLE) + 1)


@dataclass
class Described:
    """Some documents as both views see them: ``root`` is what words are divided by."""

    owner: np.ndarray
    code: np.ndarray
    own: np.ndarray
    begin: np.ndarray
    root: np.ndarray
    style: np.ndarray
    metadata: np.ndarray

    @classmethod
    def of(cls, rows: pa.RecordBatch, texts: pa.Array) -> Described:
        owner, code, style, words = text_view(texts)
        one = np.ones(len(texts))
        metadata = metadata_view(*(
            rows.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
        return cls(owner, code, *_word_features(words.vocabulary),
                   np.sqrt(np.maximum(np.bincount(owner, minlength=len(texts)), 1)),
                   np.column_stack([style, one]), np.column_stack([metadata, one]))

    def scores(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """The sums of weights by content and by metadata."""
        of_words = model.words[self.own] + model.words[self.begin]
        of_text = np.bincount(self.owner, of_words[self.code], minlength=len(self.root)) / self.root
        return of_text + self.style @ model.style, self.metadata @ model.metadata


SCHEMA = ("doc_id long, quality double, quality_text double, quality_metadata double, "
          "toxic double, toxic_text double, toxic_metadata double, kept boolean")


def scored(docs: DataFrame, models: dict[str, Model]) -> DataFrame:
    """The probabilities of each row of ``docs``, and whether it is good and not toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                seen, columns = Described.of(rows, texts), []
                for target in TARGETS:
                    by_text, by_metadata, both = known[target].calibrated(*seen.scores(known[target]))
                    columns += (both, by_text, by_metadata)
                kept = (columns[0] >= 0.5) & (columns[3] < 0.5)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()), *map(pa.array, [*columns, kept])],
                    names=[part.split()[0] for part in SCHEMA.split(", ")])

    return docs.mapInArrow(score, SCHEMA)


def quality_classifier(docs: DataFrame, labels: DataFrame,
                       sample: Sample = Sample()) -> DataFrame:
    """The quality and the toxicity of each row of ``docs`` (doc_id, text, lang, source, n_chars).

    ``quality`` and ``toxic`` are the calibrated probabilities by both views, beside those by
    the text and by the metadata alone; ``kept`` says that quality is at least, and
    toxicity below, a half. Training takes the bounded ``sample`` of labelled rows and
    all other documents, repeated rows one by one; all rows are scored whole.

    Null texts and metadata count as empty. Labels for unknown or null ids are not used; of
    several labels of an id the greatest counts. Each row gives one row, repeated rows alike; a
    null doc_id stays null; other columns are not read. Without labels of both classes the
    scores are their share (a half without any); an empty table gives no rows.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string"),
        F.col("source").cast("string"), F.col("n_chars").cast("long"))
    return scored(docs, train(docs, labels, sample))
