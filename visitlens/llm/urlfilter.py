"""URL filters (operator 4) by a sort-merge range join.

A rule (host, path) becomes a canonical key: the host's labels reversed, a
slash, the path. As a prefix it is an interval of keys, and two rules'
intervals either nest or lie apart. A url has one key for each suffix of its
host that some rule names. Keys and interval bounds are sorted together in
ranges; at each bound the sweep knows the innermost rule still open (the top
of the stack: the rule that starts, or the one around the rule that ends), and
a key takes the last top before it, carried over from earlier ranges. All of
it is DataFrame functions; distinct keys are swept, so a hot host or url counts
once, and no range depends on one host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm.common import stage

# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """A literal table (verdict, host, path)."""
    rows = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("verdict", "host", "path"), r)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; path from there up to ``?``, ``#`` or the end. Null, or without
    ``://``: both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _key(host: Column, path: Column) -> Column:
    reverse = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.encode(F.concat(reverse, F.lit("/"), path), "UTF-8")


def _bounds(rules: DataFrame) -> DataFrame:
    """(key, kind, top): where a rule's interval starts (kind 0) and ends, and
    the innermost rule open from there on (top.name null: none)."""
    rule = F.struct(F.concat("host", "path").alias("name"), "verdict")
    # of rules that are alike in host and path the first verdict by name stays
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    keyed = rules.select(_key(F.col("host"), F.col("path")).alias("key"), rule.alias("rule"))
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.octet_length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n - 1)))
    around = (keyed.select(F.col("key").alias("inner"), prefix.alias("key")).join(keyed, "key")
              .groupBy("inner").agg(F.max_by("rule", F.octet_length("key")).alias("outer")))
    none = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("verdict"))
    ends = keyed.join(around, keyed["key"] == around["inner"], "left").select(
        F.concat("key", F.lit(bytes([255]))).alias("key"), F.coalesce("outer", none).alias("top"))
    return (keyed.select("key", F.lit(0).alias("kind"), F.col("rule").alias("top"))
            .unionByName(ends.select("key", F.lit(0).alias("kind"), "top")))


def innermost(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``keys`` (key) with ``top``, the longest rule whose key is a
    prefix (null fields: none)."""
    spark = keys.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = _bounds(rules).schema["top"].dataType.simpleString()
    events = _bounds(rules).unionByName(keys.select("key", F.lit(1).alias("kind"), F.lit(None).cast(empty).alias("top")))
    # written before it is read twice, so both see the same ranges
    ranged = stage(events.repartitionByRange(ranges, "key", "kind").withColumn("range", F.spark_partition_id()), "url-ranges")
    last = (ranged.where("kind = 0").groupBy("range").agg(F.max_by("top", F.struct("key", "kind")).alias("top"))
            .join(ranged.select("range").distinct(), "range", "right"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("range", F.last("top", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("open", F.last("top", ignorenulls=True).over(sweep)).where("kind = 1")
    return swept.join(carried, "range").select("key", F.coalesce("open", "carried").alias("top"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """One row per row of ``pages`` (url and any more columns): its columns and
    host, path, rule (host and path of the longest rule that fits, or null),
    verdict (the rule's, else ``default``). A rule fits its host and all
    subdomains if the url's path starts with the rule's; of two equally long
    ones the longer host wins. A rule with a null host or path is dropped.
    Columns of ``pages`` with the results' names are replaced."""
    host, path = host_and_path(pages["url"])
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    named = pages.select(F.struct(*[pages[c] for c in keep]).alias("_row"), host.alias("_host"), path.alias("_path"))
    rules = rules.where("host is not null and path is not null")
    places = named.select("_host", "_path").distinct()
    labels = F.split("_host", r"\.", -1)
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), ".")))
    tried = (places.withColumn("host", suffix).join(rules.select("host").distinct(), "host", "left_semi")
             .select("_host", "_path", "host", _key(F.col("host"), F.col("_path")).alias("key")))
    top = innermost(tried.select("key").distinct(), rules)
    best = (tried.join(top, "key").where("top.name is not null").groupBy("_host", "_path")
            .agg(F.max_by("top", F.struct(F.length("top.name"), F.length("host"))).alias("top")))
    out = named.join(best, ["_host", "_path"], "left")
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], F.col("_host").alias("host"), F.col("_path").alias("path"),
                      F.col("top.name").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))


def judge_sql() -> str:
    """The same verdicts in SQL, rule by rule."""
    return r"""
WITH r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, row_number() OVER () AS row,
             CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
p AS (SELECT page_id, row, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
m AS (SELECT p.row, first(r.host || r.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS rule,
             first(r.verdict ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS verdict
      FROM p JOIN r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path) GROUP BY p.row)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (row)"""
