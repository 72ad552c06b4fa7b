"""Whitening, token files and hard negatives, against brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import negatives, token_files, whitening
from millrace.llm.queries import BYTE_TOKENIZER
from millrace.session import new_folder, stored

VECTORS = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")


# Whitening


def brute_whitening(vectors: list[list[float]], most: int = 16):
    """Whitened values by an eigendecomposition of the exact covariance."""
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit]) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1][:most], parts[:, ::-1][:, :most]
    total = np.trace(centred.T @ centred / n)
    rows = np.array([[n * c - s for c, s in zip(v, sums)] for v in x]) / n
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return n, rows @ parts / np.sqrt(values), values / total, deviations


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(7)
    mixed = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) + 50
    vectors = mixed.tolist() + mixed[:40].tolist()
    rows = [(k, v, 0) for k, v in enumerate(vectors)]
    found = whitening.whitened(spark.createDataFrame(rows, VECTORS)).toPandas()
    n, want, explained, deviations = brute_whitening(vectors)
    assert set(found["n"]) == {n} and n == 300
    table = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((table * want).sum(axis=0))
    assert np.abs(table * signs - want).max() < 1e-9
    assert np.abs(found["explained"].to_numpy()[:16] - explained).max() < 1e-12
    assert found["identity_error"].max() < 1e-10
    firsts = found[found["component"] == 1].sort_values("vec_id")
    assert firsts["deviation"].tolist() == deviations


def test_whitening_of_nearly_and_wholly_dependent_columns(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-10**6, 10**6, (300, 6))
    x[:, 2] = 7
    x[:, 3] = x[:, 0] - x[:, 1]
    x[:, 4] = x[:, 0] * 50 + rng.integers(0, 2, 300)
    table = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>")
    found = whitening.fitted(stored(table, "fit"))
    assert found.weights.shape == (6, 4)
    exact = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)[:4] ** 2
    assert np.allclose(found.explained, exact / exact.sum(), rtol=1e-6)
    assert whitening.identity_error(table, found) < 1e-6


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [3.0, 2.5], 0), (2, None, 0),
            (3, [1.0, None], 0), (4, [NAN, 1.0], 0), (5, [INF, 1.0], 0), (6, [0.5], 0),
            (7, [], 0), (8, [1e30, 1.0], 0)]
    table = spark.createDataFrame(rows, VECTORS).withColumn("x", F.lit("a")).withColumn(
        "n", F.lit(1)).withColumn("component", F.lit(2))
    found = whitening.whitened(table).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == sorted(
        (v, c) for v in (0, 1, 1, 6, 7) for c in (1, 2))
    assert {r.n for r in found} == {4}
    zeros = {r.whitened for r in found if r.vec_id == 7}
    assert len(zeros) == 2
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whitened(empty).count() == 0
    assert whitening.whitened(spark.createDataFrame(rows[:2], VECTORS)).count() == 0


def test_deviations_beyond_a_long_are_null():
    rows = np.array([[1, 2], [2**31, 2**31], [2**40, 0], [3 * 10**9, 0]])
    assert whitening._deviations(rows) == [5, None, None, 9 * 10**18]


# Token files

DOCS = "doc_id long, text string"


def test_pieces_have_the_ids_of_whole_texts():
    tokenizer, encoder = Tokenizer.from_file(BYTE_TOKENIZER), token_files.ByteEncoder(BYTE_TOKENIZER)
    random.seed(4)
    parts = ["a", "ab", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "1", ".", "'s",
             "é", "日", "<|endoftext|>", " ", "́"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(4000)]
    ids, starts = encoder(pa.array(texts))
    for k, text in enumerate(texts):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[starts[k]:starts[k + 1]].tolist() == want, text


def brute_tokens(docs):
    tokenizer, want, start = Tokenizer.from_file(BYTE_TOKENIZER), [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return want


def test_token_files_against_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(token_files, "READ_IDS", 1000)
    random.seed(6)
    docs = [(k * 7 % 501, " ".join(random.choices(["one", "two,", "été", "\n"], k=k % 40)))
            for k in range(500)]
    docs += [(None, "x y"), (None, "x y"), (3, None), (3, ""), (3, ""), (9, "long " * 30_000)]
    table = spark.createDataFrame(docs, DOCS).withColumn("row", F.lit("a")).withColumn(
        "part", F.lit("b"))
    folder = new_folder(spark, "tokens")
    with_parts = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in with_parts.items():
        spark.conf.set(name, value)
    manifest = token_files.write_token_files(table.repartition(5), folder, BYTE_TOKENIZER)
    for name in with_parts:
        spark.conf.unset(name)
    assert manifest.count() > 3
    found = sorted(map(tuple, token_files.read_token_files(spark, folder).collect()),
                   key=lambda r: r[1])
    want = brute_tokens(docs)
    assert [r[0] for r in found] == [r[0] for r in want]
    # Documents that share an id have no order among them but that of the input.
    assert sorted((r[0] or -1, r[2], r[3]) for r in found) == sorted(
        (r[0] or -1, r[2], r[3]) for r in want)
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found])[:-1].tolist()


def test_token_files_of_an_empty_table(spark):
    folder = new_folder(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame([], DOCS), folder, BYTE_TOKENIZER)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_a_part_written_twice_counts_once(spark):
    """The files of an attempt that was not committed are there, but not in the manifest."""
    folder = new_folder(spark, "tokens")
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], DOCS)
    token_files.write_token_files(docs, folder, BYTE_TOKENIZER)
    files, root = token_files.place(folder)
    with files.open_output_stream(f"{root}/tokens-000000-other.bin") as stream:
        stream.write(b"\x01\x02\x03")
    assert [r.doc_id for r in token_files.read_token_files(spark, folder).collect()] == [1, 2]


# Hard negatives


def brute_negatives(rows, is_anchor, mining=negatives.Mining()):
    x = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(
                c is None or not np.isfinite(c) for c in vector):
            continue
        whole = [int(np.floor(256 * c)) for c in vector]
        if sum(c * c for c in whole) <= 2**62:
            x[vec_id] = min(x.get(vec_id, (label, whole)), (label, whole))
    found = []
    for anchor, (label, vector) in x.items():
        if not is_anchor(anchor):
            continue
        scores = sorted((-sum(a * b for a, b in zip(vector, other)), row, its)
                        for row, (its, other) in x.items() if row != anchor)
        for p, positive, _ in [s for s in scores if s[2] == label][:mining.positives]:
            inside = [s for s in scores if s[2] != label
                      and mining.low * -p <= 100 * -s[0] <= mining.high * -p]
            found += [(anchor, positive, k + 1, s[1], -p, -s[0])
                      for k, s in enumerate(inside[:mining.negatives])]
    return sorted(found)


@pytest.mark.parametrize("spread", [0.15, 0.9])
def test_hard_negatives_against_brute_force(spark, monkeypatch, spread):
    for name, value in (("CELLS", 500), ("TILE", 700), ("LISTS", 3), ("BLOCK_BYTES", 2000)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(int(spread * 100))
    rows = []
    for k in range(400):
        vector = rng.normal(size=12) * spread * np.array([3] + [1] * 5 + [0.1] * 6)
        vector[0] += 0.5
        rows.append((k, np.round(vector, 1).tolist(), int(rng.integers(0, 4))))
    rows += [(k, rows[k - 400][1], (k // 3) % 3) for k in range(400, 440)]
    found = negatives.hard_negatives(
        spark.createDataFrame(rows, VECTORS).repartition(3), F.col("label"),
        F.col("vec_id") % 20 == 0)
    want = brute_negatives(rows, lambda v: v % 20 == 0)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


def test_no_pair_above_its_threshold_is_pruned():
    rng = np.random.default_rng(3)
    for lists in (1, 4):
        anchors = rng.integers(-300, 300, (30, 16)) * rng.integers(0, 2, (30, 1))
        rows = (rng.integers(-300, 300, (200, 16)) * rng.random((200, 16)) ** 4).astype(np.int64)
        scores = anchors @ rows.T
        low = np.sort(scores, axis=1)[:, -1 - rng.integers(0, 40)]
        pairs = set()
        negatives_lists, negatives.LISTS = negatives.LISTS, lists
        try:
            for i, j in negatives.candidates(
                    anchors, rows, low, lambda tile, of: np.ones((len(low[tile]), len(of)), bool)):
                pairs |= set(zip(i.tolist(), j.tolist()))
        finally:
            negatives.LISTS = negatives_lists
        reach = {(i, j) for i, j in zip(*np.nonzero(scores >= low[:, None]))}
        assert reach <= pairs | {(i, j) for i, j in reach if low[i] <= 0}
        some = low > 0
        assert len([p for p in pairs if some[p[0]]]) < some.sum() * 200


def test_hard_negatives_of_odd_rows(spark):
    one = [1.0, 0.5]
    rows = [(0, one, 1), (1, one, 1), (1, one, 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 2),
            (4, None, 1), (5, [1.0, None], 1), (6, [NAN, 1.0], 2), (7, [INF, 1.0], 2),
            (8, one, None), (None, one, 1), (9, [1e300, 1.0], 1), (10, [1.2], 3), (11, [], 2),
            (100, [-1.0, 0.0], 5), (200, [0.0, 0.0], 2), (1, [0.0, 0.1], 0)]
    table = spark.createDataFrame(rows, VECTORS).withColumn("x", F.lit(1)).withColumn(
        "v", F.lit(2)).withColumn("window", F.lit(3)).withColumn("rows", F.lit(4))
    found = negatives.hard_negatives(table, F.col("label"), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda v: v % 100 == 0)
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, F.col("label"), F.col("vec_id") == 0).count() == 0
