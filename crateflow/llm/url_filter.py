"""URL filters: rules on hosts and path prefixes, found by short hash prefixes.

Each url is spelled out into the expressions that a rule could be written as:
its host suffixes crossed with its path prefixes. Expressions and rules meet by
an equal short prefix of their digests, the full digest confirms, and the rule
with the longest text decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.llm.rows import small
from crateflow.plans.spread import spread_join
from crateflow.session import stored

PREFIX_CHARS = 8  # of the hexadecimal digest
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring_index(url, "://", 1)
    rest = F.substr(url, F.length(rest) + 4)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", default: str = "allow"
) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all
    subdomains when the path starts with the rule's path, letter by letter. The
    longest rule text wins; of equally long ones the longer host, then block.
    Without a rule: ``rule`` null and the ``default`` verdict. A url that is
    null or has no ``://`` has an empty host and path and meets no rule, nor
    does a rule with a null or an empty host; a null path of a rule is empty.
    Repeated pages and null ids give a row each; other columns are not read.

    Only suffixes with as many labels, and prefixes as long, as some rule has
    are spelled out: both lists are bounded by the longest rule, not by its
    number of rows. Equal urls are judged once. The join on the digest prefix
    is broadcast when the rules fit, otherwise frequent expressions such as
    ``com/`` are split over salts.
    """
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"),
        F.col("verdict").alias("r_verdict"),
    ).where("r_host <> '' and r_verdict is not null")
    shape = rules.agg(
        F.collect_set(F.size(F.split("r_host", r"\.", -1))).alias("labels"),
        F.collect_set(F.length("r_path")).alias("lengths"),
    ).first()
    rules = rules.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    rules = rules.withColumn("r_digest", F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256))
    rules = rules.withColumn("short", F.substr("r_digest", F.lit(1), F.lit(PREFIX_CHARS)))

    rows = pages.select(F.col(id_column).alias("id"), F.col("url").alias("url"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    if not labels:
        return rows.select(
            F.col("id").alias(id_column), "host", "path",
            F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
        )
    parts = F.size(F.split("host", r"\.", -1))
    suffixes = F.array_compact(F.array(*[
        F.when(parts >= n, F.substring_index("host", ".", -n)) for n in labels
    ]))
    prefixes = F.array_compact(F.array(*[
        F.when(F.length("path") >= n, F.substr("path", F.lit(1), F.lit(n))) for n in lengths
    ]))
    wanted = (
        rows.where("host <> ''").select("host", "path").distinct()
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("digest", F.sha2(F.concat("suffix", F.lit("\n"), "prefix"), 256))
        .withColumn("short", F.substr("digest", F.lit(1), F.lit(PREFIX_CHARS)))
        .select("host", "path", "digest", "short")
    )
    found = spread_join(wanted, rules, ["short"], "inner", F.col("digest") == F.col("r_digest"))
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("length"),
        F.length("r_host").alias("host_length"),
        F.col("r_verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule"),
    )
    best = found.groupBy("host", "path").agg(F.max(rank).alias("best"))
    judged = rows.join(small(stored(best, "judged")), ["host", "path"], "left")
    return judged.select(
        F.col("id").alias(id_column), "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op2_url_filter(spark, sf_dir):
    """Every url of ``pages`` under the stated rules."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(pages, rules)


ORACLE_SQL = r"""
WITH cut AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
  (SELECT arg_max(r_host || r_path, length(r_host || r_path)) FROM rules
   WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
  coalesce((SELECT arg_max(r_verdict, length(r_host || r_path)) FROM rules
   WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)), 'allow') AS verdict
FROM parts
"""
