"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``host/path`` text. It fits its host and all subdomains when the
URL's path starts with the rule's path; ``*`` stands for any run of characters.
Every rule is filed under one literal token, the one that fewest URLs carry.
A URL's tokens fetch the candidate rules by an equi-join, and regular
expressions run on those candidates only. Rules are a table: their expressions and
tokens are columns, and only tokens that some rule holds are counted (a semi-join),
so a list may be as long as a table can be.

Defined results: a null URL or one without ``://`` has empty host and path and
no rule (verdict ``allow``); a URL without a path does not start with a listed
rule's ``/``, but the patterns take it for the host's home page; equal
URLs are matched once and every row keeps its own output row; rows of rules that
repeat a pattern in a tier are one rule (the least verdict); an empty table
gives an empty result; other columns pass through, those named like a result
column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martlet.llm.registry import read_table, register

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    pattern: str


# The rules of the contract.
LISTED = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
          Rule("allow", "com/fr/"), Rule("block", "com/de/"))

# Patterns tried where no listed rule fits.
PATTERNS = tuple(Rule("block", p) for p in (
    "casino-*.*/", "*-casino.*/", "casino.*/", "free-bets.*/", "bets.*/", "poker-*.*/", "cheap-pills.*/",
    "*-pills.*/", "pills-*.*/", "adult-*.*/", "xxx.*/", "porn.*/", "porn-*.*/", "ads-*.*/", "ads.*/",
    "adserver.*/", "spam-*.*/", "warez.*/", "torrent-*.*/", "*/casino/", "*/porn/", "*/warez/",
))


def rule_regex(pattern: Column) -> Column:
    """Regular expression of a rule over host followed by path."""
    quoted = F.regexp_replace(pattern, r"([^\p{L}\p{N}*])", r"\\$1")
    return F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), F.replace(quoted, F.lit("*"), F.lit(".*")))


def rule_tokens(pattern: Column) -> Column:
    """Literal tokens that every fitting URL holds as whole tokens: runs of
    letters and digits with a separator of the rule (or its start) before and
    a separator of the rule behind; [''] for a rule without one."""
    found = F.array_distinct(F.regexp_extract_all(pattern, F.lit("(?<![A-Za-z0-9*])([A-Za-z0-9]+)(?=[^A-Za-z0-9*])"), 1))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def rule_table(spark: SparkSession, listed: Sequence[Rule], patterns: Sequence[Rule]) -> DataFrame:
    """(tier, verdict, pattern): listed rules are tier 1, the method's own tier 0."""
    rows = [F.struct(F.lit(tier).alias("tier"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"))
            for tier, rules in ((1, listed), (0, patterns)) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def url_parts(url) -> tuple:
    """(host, path) expressions; both empty for null or a URL without ``://``."""
    url = F.coalesce(url, F.lit(""))
    part = "(?s)://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, part, 1), UPPER, LOWER), F.regexp_extract(url, part, 2)


def judge_urls(pages: DataFrame, rules: DataFrame | None = None, url: str = "url") -> DataFrame:
    """``pages`` columns plus host, path, rule, verdict and the fitting pattern.
    ``rules``: a table (tier, verdict, pattern); the contract's by default."""
    if rules is None:
        rules = rule_table(pages.sparkSession, LISTED, PATTERNS)
    host, path = url_parts(F.col(url))
    pages = pages.drop("host", "path", "rule", "verdict", "pattern").withColumns({"host": host, "path": path})
    urls = pages.select("host", "path").distinct()
    tokens = urls.select("host", "path", F.explode(F.array_union(
        F.array(F.lit("")), F.split(F.concat("host", "path"), "[^A-Za-z0-9]+"))).alias("token"))

    rules = rules.filter(F.col("pattern").isNotNull()).groupBy("tier", "pattern").agg(F.min("verdict").alias("verdict"))
    filed = rules.select("tier", "pattern", F.explode(rule_tokens(F.col("pattern"))).alias("token"))
    counts = tokens.join(filed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (filed.join(counts, "token", "left").groupBy("tier", "pattern")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    index = rules.withColumn("regex", rule_regex(F.col("pattern"))).join(rarest, ["tier", "pattern"])

    # A host alone is its home page for the patterns.
    page = F.concat("host", F.when((F.col("tier") == 0) & (F.col("path") == "") & (F.col("host") != ""), F.lit("/")).otherwise(F.col("path")))
    fits = tokens.join(index, "token").withColumn("page", page).filter(F.expr("rlike(page, regex)"))
    rank = F.struct("tier", F.length("pattern"), F.length(F.substring_index("pattern", "/", 1)), "pattern")
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("tier", "pattern", "verdict"), rank).alias("_best"))
    return (pages.join(best, ["host", "path"], "left")
            .withColumn("rule", F.when(F.col("_best.tier") == 1, F.col("_best.pattern")))
            .withColumn("verdict", F.coalesce("_best.verdict", F.lit("allow")))
            .withColumn("pattern", F.col("_best.pattern")).drop("_best"))


def _sql_regex(pattern: str) -> str:
    return r"^(?:[^/]*\.)?" + "".join(".*" if c == "*" else c if c.isalnum() else "\\" + c for c in pattern)


_SQL_METHOD = " OR ".join(
    f"regexp_matches(hp, '{_sql_regex(r.pattern)}', 's')" for r in PATTERNS)
_SQL = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(url, '://([^/?#]*)([^?#]*)', 2, 's') AS path FROM u),
r AS (SELECT *, host || CASE WHEN path = '' AND host <> '' THEN '/' ELSE path END AS hp, '.' || host AS h,
      CASE WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
           WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
           WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
           WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
           WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN {_SQL_METHOD} THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


@register("op7_url_filters", _SQL)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
