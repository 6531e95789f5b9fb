"""URL filter: host-suffix and path-prefix expressions, matched by short hash prefixes and confirmed by full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8  # hex digits of the short hash that the join compares

# The rules of the contract (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, unmatched: str = "allow") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one for each row of ``pages`` (page_id, url).

    ``rules`` has (verdict, host, path). A rule fits its host and every subdomain when the url's path starts with the
    rule's path; of the rules that fit, the longest text wins, then the longer host, then block before allow. Urls
    without a rule get ``unmatched``.

    Each url becomes its host suffixes times those of its path prefixes whose length some rule has. The list of these
    lengths is all that reaches the driver: it is no longer than the longest rule path. Expressions and rules meet in
    an equi-join on short hashes, where Spark broadcasts the rules if they are small and splits common expressions
    otherwise; the full digests then decide.

    Null urls and urls without ``://`` have an empty host and path. Null ids, repeated ids and repeated rows give one
    row each. No rules: every url is unmatched. Rules with a null part fit nothing. Other columns are ignored.
    """
    rules = rules.select("verdict", "host", "path").dropna()
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    known = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.struct((F.length("host") + F.length("path")).alias("n"), F.length("host").alias("h"),
                 F.col("verdict"), F.concat("host", "path").alias("rule")).alias("hit")
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    hashes = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: digest(s, p))))
    # Every expression is looked up by its short hash; urls without an expression keep one empty row.
    asked = urls.select("row", "page_id", "host", "path", F.explode_outer(hashes).alias("digest")).withColumn(
        "short", F.substring("digest", 1, PREFIX_DIGITS))
    hit = F.when(F.col("digest") == F.col("rule_digest"), F.col("hit"))
    return (asked.join(known, "short", "left")
            .groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                F.first("path").alias("path"), F.max(hit).alias("best"))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(unmatched)).alias("verdict")))


def query(spark: SparkSession, root: str) -> DataFrame:
    return judge(table(spark, root, "pages"), spark.createDataFrame(RULES, "verdict string, host string, path string"))


SQL = """
WITH rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls AS (
  SELECT row_number() OVER () AS rid, page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
best AS (
  SELECT rid, arg_max(rhost || rpath, length(rhost || rpath) * 1000 + length(rhost)) AS rule,
         arg_max(verdict, length(rhost || rpath) * 1000 + length(rhost)) AS verdict
  FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (rid)
"""
