"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, probed by windows.

Everything here is built-in functions. The words of a text are generated one row each, the
hash of the window that begins there is looked up in the broadcast set, and a window that is
found is verified word by word. A document's first row always stays, so that one pass over
the texts gives both the documents and their hits. All rows of a document are made by one
task, which sums them up before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import unused
from millrace.session import has_at_most, stored

NGRAM = 10

# The hash set is broadcast up to this size. A larger one is dealt by hash into parts of that
# size, each with a scan of its own over all documents.
BROADCAST_BYTES = 32_000_000

# Up to so many contaminated documents (two numbers each) are broadcast to be taken out.
BROADCAST_IDS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def normalised_words(text: Column) -> Column:
    """The words of a text: runs of a-z (A-Z lower-cased), 0-9 and all that is not ASCII."""
    # lower() is the same as translating A-Z for ASCII texts, and several times as fast.
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lower, f"{_BETWEEN}+"), "")


def _window_hash(length: Column, words: Column, first: Column | int, ngram: int) -> Column:
    """The hash of up to ``ngram`` words; words beyond an array's end do not count."""
    return F.xxhash64(length, *(F.get(words, first + F.lit(k)) for k in range(ngram)))


def benchmark_windows(benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """A row for each distinct window: its words, length and hash, and the ids of its items."""
    words, length = F.col("words"), F.col("length")
    return (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                         normalised_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("length", F.least(F.size("words"), F.lit(ngram)))
        .select("item", "length", F.explode(F.transform(
            F.sequence(F.lit(1), F.size("words") - length + 1),
            lambda first: F.slice(words, first, length))).alias("window"))
        .groupBy("window", "length").agg(F.collect_set("item").alias("items"))
        .withColumn("hash", _window_hash(length, F.col("window"), 0, ngram)))


def hits(docs: DataFrame, benchmark: DataFrame, carried: list[str], ngram: int = NGRAM,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row for each row of ``docs`` (text and ``carried``): what of the benchmark it holds.

    Columns: those ``carried``, n_words, ``places`` (sorted structs of first word ``at`` and
    ``length``, a struct for each occurrence of a window) and the distinct ``items``.
    """
    windows = stored(benchmark_windows(benchmark, ngram), "windows")
    size = windows.agg(F.sum(
        F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " "))
        + 16 * F.size("items") + 200)).first()[0] or 0
    parts = max(1, -(-size // broadcast_bytes))
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())
    rows = docs.select(*carried, "text").withColumn("_row", F.monotonically_increasing_id())
    if parts > 1:
        rows = stored(rows, "documents")
    found = reduce(DataFrame.unionByName, (
        _scan(rows, windows.where(F.pmod("hash", F.lit(parts)) == part), lengths or [ngram])
        for part in range(parts)))
    place = F.when(F.col("items").isNotNull(), F.struct("at", "length"))
    return found.groupBy("_row", *carried, "n_words").agg(
        F.sort_array(F.collect_list(place)).alias("places"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")).drop("_row")


def _scan(rows: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """The first word of every row, and every word where one of ``windows`` begins."""
    words, at, length = F.col("_words"), F.col("at"), F.col("length")
    keys = reduce(
        lambda other, k: F.when(length == k, _window_hash(F.lit(k), words, at, k)).otherwise(other),
        lengths[1:], _window_hash(F.lit(lengths[0]), words, at, lengths[0]))
    begun = (
        rows.withColumn("_words", normalised_words(F.col("text"))).drop("text")
        .select("*", F.greatest(F.size("_words"), F.lit(0)).cast("long").alias("n_words"),
                F.posexplode_outer("_words").alias("at", "_word"))
        .withColumn("length", F.explode(F.array(*map(F.lit, lengths))) if len(lengths) > 1
                    else F.lit(lengths[0]))
        .withColumn("_hash", F.when(at + length <= F.size(words), keys)))
    known = F.broadcast(windows.select("hash", "window", F.col("items").alias("_items")))
    same = F.slice(words, at + 1, length) == F.col("window")
    # The first row of a document stays, also if no window begins there.
    first = F.coalesce(at, F.lit(0)) == 0
    return (begun.join(known, F.col("_hash") == F.col("hash"), "left")
            .withColumn("items", F.when(same, F.col("_items")))
            .where(first | F.col("items").isNotNull())
            .drop("_words", "_word", "_hash", "hash", "window", "_items"))


def _merged(places: Column) -> Column:
    """Sorted places as (first, end) spans that neither overlap nor touch."""
    none = F.array().cast("array<struct<first:int,end:int>>")
    def span(first, end):
        return F.array(F.struct(first.alias("first"), end.alias("end")))
    def grown(spans, place):
        end = place["at"] + place["length"]
        last = F.element_at(spans, -1)
        return (F.when(F.size(spans) == 0, span(place["at"], end))
                .when(place["at"] > last["end"], F.concat(spans, span(place["at"], end)))
                .otherwise(F.concat(F.slice(spans, 1, F.size(spans) - 1),
                                    span(last["first"], F.greatest(last["end"], end)))))
    return F.aggregate(places, none, grown)


def _hit_words(places: Column) -> Column:
    """How many words lie in sorted ``places``."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))
    def counted(so_far, place):
        end = F.greatest(so_far["end"], place["at"] + place["length"])
        return F.struct(end.alias("end"), (
            so_far["words"] + end - F.greatest(so_far["end"], place["at"])).alias("words"))
    return F.aggregate(places, start, counted)["words"]


def contamination(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """What of ``benchmark`` (item_id, text) each row of ``docs`` (doc_id, text) holds.

    A window is ``ngram`` consecutive words of an item, or all of an item with fewer words.
    Result: doc_id; ``n_words``; ``n_hit``, the words inside any occurrence of a window;
    ``n_items``, the items with occurring windows; ``items_sha256`` over their ids, sorted as
    strings and comma-joined; ``contaminated``, whether n_hit > 0.

    Null and empty texts and items have no words. Each row of ``docs`` gives one row, so
    repeated rows and a null doc_id stay as they are; items without an id count as one whose
    id is empty. Columns other than those named are not read. An empty benchmark hits nothing;
    an empty table gives no rows.
    """
    found = hits(docs, benchmark, ["doc_id"], ngram, broadcast_bytes)
    n_hit = _hit_words(F.col("places"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("places") > 0).alias("contaminated"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                          ngram: int = NGRAM) -> DataFrame:
    """``docs`` without its contaminated documents, or without the hit words in them.

    With ``remove="spans"``, a hit word goes with what follows it up to the next word. All
    columns are kept, whatever their names; rows are told apart by doc_id and text, so equal
    rows fare alike. A null doc_id is an id like any other.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be documents or spans")
    digest, name, own, spans = unused(docs, "digest", "id", "own", "spans")
    marked = docs.withColumn(digest, F.xxhash64("text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = (hits(marked, benchmark, ["doc_id", digest], ngram).where(F.size("places") > 0)
             .select(F.col("doc_id").alias(name), F.col(digest).alias(own),
                     _merged(F.col("places")).alias(spans)).dropDuplicates([name, own]))
    same = F.col("doc_id").eqNullSafe(F.col(name)) & (F.col(digest) == F.col(own))
    if remove == "documents":
        found = stored(found.select(name, own), "contaminated")
        if has_at_most(found, BROADCAST_IDS):
            found = F.broadcast(found)
        return marked.join(found, same, "left_anti").select(*columns)
    text = F.col("text")
    pieces = F.regexp_extract_all(text, F.lit(f"({_WORD}+{_BETWEEN}*)"), 1)
    kept = F.filter(pieces, lambda _, k: ~F.exists(
        F.col(spans), lambda span: (span["first"] <= k) & (k < span["end"])))
    cut = F.concat(F.regexp_extract(text, f"^{_BETWEEN}*", 0), F.array_join(kept, ""))
    return marked.join(found, same, "left").withColumn(
        "text", F.when(F.col(own).isNull(), text).otherwise(cut)).select(*columns)


SQL = """
WITH split AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, words[p : p + least(len(words), 10) - 1] AS win FROM (
    SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p
    FROM item WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
starts AS (
  SELECT r, n, p, words[p : p + n - 1] AS win FROM (
    SELECT r, n, words, unnest(range(1, len(words) - n + 2)) AS p FROM split, lengths
    WHERE len(words) >= n)),
found AS (SELECT r, p, n, item_id FROM starts JOIN windows USING (win)),
hit AS (
  SELECT r, count(DISTINCT w) AS n_hit FROM (
    SELECT r, unnest(range(p, p + n)) AS w FROM (SELECT DISTINCT r, p, n FROM found))
  GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
    SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
