"""URL filters: host-suffix / path-prefix expressions joined on hash prefixes.

Every distinct (host, path) is expanded into the expressions a rule could be
stored under: each suffix of the host at a label boundary times each prefix
of the path that ends in ``/`` (and the empty one).  A rule is stored under
its host and its path up to the last ``/``.  Expressions and rules are
equi-joined on the first 32 bits of their SHA-256; a hit counts only if the
full digests agree and the path starts with the rule's path.  The longest
rule wins (ties: longer host, then ``block``).

Expansions longer than any rule are not made; that cannot lose a match.

Defined cases: a null url or one without ``://`` has empty host and path and
fits no rule; repeated rows each get their verdict; empty tables give empty
results (no rules: the default verdict everywhere); extra columns of the
pages are ignored by the query and carried by the operator unless they have
the name of a result column, which the result replaces.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULE_SCHEMA = "host string, path string, verdict string"
# The production rules of query op3.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _prefix(expression: Column) -> Column:
    return F.substring(F.sha2(expression, 256), 1, 8)


def _expressions(host: Column, path: Column, max_labels: int, max_depth: int) -> Column:
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), n - (max_labels - 1)), n),
        lambda i: F.array_join(F.slice(labels, i, F.lit(1 << 30)), "."))
    parts = F.split(path, "/")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(max_depth))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))))
    return F.array_distinct(F.flatten(F.transform(
        suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p)))))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (with ``url``) plus host, path, rule and verdict.

    ``rules`` has host, path and verdict ('allow' or 'block').  The rules'
    depth bounds are one aggregate row; the rules themselves are joined by
    their hash prefix and broadcast only when Spark's size check allows it.
    """
    stored = (rules.select(
        F.translate(F.coalesce("host", F.lit("")), _UPPER, _UPPER.lower()).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"))
        .filter((F.col("r_host") != "") & F.col("r_verdict").isin("allow", "block"))
        .withColumn("r_key", F.concat("r_host", F.regexp_extract("r_path", r"(?s)^.*/", 0)))
        .withColumn("r_prefix", _prefix(F.col("r_key"))))
    bound = stored.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
        F.max(F.size(F.split("r_path", "/")) - 1).alias("depth")).first()
    host, path = url_host_path(F.col("url"))
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*[F.col(f"`{c}`") for c in names], host.alias("host"), path.alias("path"))
    if bound["labels"] is None:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    hits = (parsed.select("host", "path").distinct().filter("host != ''")
            .select("host", "path", F.explode(_expressions(
                F.col("host"), F.col("path"), bound["labels"], bound["depth"])).alias("x"))
            .withColumn("x_prefix", _prefix(F.col("x")))
            .join(stored, F.col("x_prefix") == F.col("r_prefix"))
            .filter((F.sha2("x", 256) == F.sha2("r_key", 256)) & F.col("path").startswith(F.col("r_path"))))
    best = F.max(F.struct(
        F.length(F.concat("r_host", "r_path")).alias("n"), F.length("r_host").alias("n_host"),
        (F.col("r_verdict") == "block").alias("block"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")))
    won = hits.groupBy("host", "path").agg(best.alias("b")).select(
        F.col("host").alias("w_host"), F.col("path").alias("w_path"), "b.rule", "b.verdict")
    return (parsed.join(won, (F.col("host") == F.col("w_host")) & (F.col("path") == F.col("w_path")), "left")
            .select(*[F.col(f"`{c}`") for c in names], "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return (filter_urls(pages, spark.createDataFrame(RULES, RULE_SCHEMA))
            .select("page_id", "host", "path", "rule", "verdict"))


OP3_SQL = r"""
WITH parsed AS (
  SELECT page_id,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0
              THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parsed
), rules(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path,
       (SELECT r_host || r_path FROM rules
        WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
        ORDER BY length(r_host || r_path) DESC LIMIT 1) AS rule,
       coalesce((SELECT r_verdict FROM rules
        WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
        ORDER BY length(r_host || r_path) DESC LIMIT 1), 'allow') AS verdict
FROM split
"""
