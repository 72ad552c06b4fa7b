"""URL filters: host-suffix and path-prefix expressions, matched by short hash prefixes.

Every URL is expanded into the expressions a rule for it could be written as: each suffix of
its host (from a label on) with each prefix of its path, of the sizes that rules have. Rules and expressions meet in an
equi-join on the first four bytes of their SHA-256; what meets is confirmed by the whole
digest, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import has_at_most, stored

# Rules up to this many are broadcast; a rule is a short text and a digest (about 200 bytes).
BROADCAST_RULES = 100_000

ALLOW, BLOCK = "allow", "block"

# (verdict, host, path) in order of no meaning: the longest rule that fits wins.
BASE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=BASE_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case and the path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER), F.coalesce(path, F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _prefix(digest: Column) -> Column:
    """The first four bytes of a digest, as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def expressions(host: Column, path: Column, shapes: list[tuple[int, int, bool]]) -> Column:
    """A URL's host suffixes with its path prefixes, of the ``shapes`` that rules have.

    A shape is a number of labels, a length of the path, and whether the path ends in a slash in
    all its rules. Other expressions meet no rule, so for each shape the work is linear in the URL.
    """
    labels = F.size(F.split(host, r"\."))
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(length).alias("length"),
                               F.lit(slash).alias("slash")) for n, length, slash in shapes])
    fitting = F.filter(
        known.cast("array<struct<labels:int,length:int,slash:boolean>>"),
        lambda s: (s["labels"] <= labels) & (s["length"] <= F.length(path)) & (
            ~s["slash"] | (F.substring(path, s["length"], F.lit(1)) == "/")))
    return F.transform(fitting, lambda s: F.concat(
        F.call_function("substring_index", host, F.lit("."), -s["labels"]),
        F.substring(path, F.lit(1), s["length"])))


def judged(pages: DataFrame, rules: DataFrame, default: str = ALLOW,
           broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    A rule (verdict, host, path) fits its host and all subdomains, if the path begins with
    the rule's. Of those that fit, the longest wins (host and path together; a block wins over an
    allow of the same text); ``rule`` is its host and path. Without one, rule is null and
    the verdict is ``default``.

    A null url, or one without ``://``, has an empty host and path. Repeated rows are judged
    one by one; a null page_id stays null; columns other than page_id and url are not
    read. Rules with a null field, a host that is none, or a path without its slash fit nothing.
    Empty tables give no rows.

    Up to ``broadcast_rules`` rules are broadcast. More are joined with the distinct
    expressions, so that one that very many URLs share is looked up once.
    """
    rules = stored(
        rules.where("verdict is not null and host rlike '^[^/?#]*$' and path rlike '^(/|$)'")
        .select(F.translate("host", _UPPER, _LOWER).alias("host"), F.col("path"),
                F.col("verdict"))
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
        .withColumn("digest", _digest(F.col("rule"))).withColumn("prefix", _prefix(F.col("digest"))),
        "rules")
    # At most as many as there are numbers of labels times lengths of paths.
    shapes = [(r.labels, r.length, r.slash) for r in rules.groupBy(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).agg(
        F.min(F.endswith("path", F.lit("/"))).alias("slash")).collect()]
    known = rules.select("prefix", F.col("digest").alias("_digest"), F.col("rule").alias("_rule"),
                         F.col("verdict").alias("_verdict"))
    host, path = host_and_path(F.col("url"))
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("host", host).withColumn("path", path))
    found = rows.select("row", "page_id", "host", "path", F.posexplode_outer(
        expressions(F.col("host"), F.col("path"), shapes)).alias("at", "expression"))
    hashed = (F.col("digest") == F.col("_digest"))
    if has_at_most(known, broadcast_rules):
        met = (found.withColumn("digest", _digest(F.col("expression")))
               .withColumn("_prefix", _prefix(F.col("digest")))
               .join(F.broadcast(known), F.col("_prefix") == F.col("prefix"), "left"))
    else:
        distinct = (found.select("expression").distinct()
                    .withColumn("digest", _digest(F.col("expression")))
                    .withColumn("_prefix", _prefix(F.col("digest")))
                    .join(known, F.col("_prefix") == F.col("prefix")).where(hashed)
                    .select("expression", "digest", "_digest", "_rule", "_verdict"))
        met = found.join(distinct, "expression", "left")
    fits = F.when(hashed, F.struct(F.length("_rule").alias("n"), F.col("_rule").alias("rule"),
                                   F.col("_verdict").alias("verdict")))
    best = (met.withColumn("fits", fits).where("coalesce(at, 0) = 0 or fits is not null")
            .groupBy("row", "page_id", "host", "path").agg(F.max("fits").alias("best")))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))


SQL = """
WITH rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
  SELECT page_id, row_number() OVER () AS r,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
part AS (
  SELECT page_id, r, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
parsed AS (
  SELECT page_id, r, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM part),
fit AS (
  SELECT r, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC,
                            rhost || rpath DESC) AS k
  FROM parsed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
    AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (r)
"""
