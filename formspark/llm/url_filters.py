"""URL filters: pattern rules indexed by their rarest literal token (native).

A rule is ``host/path``. It fits its host and all subdomains when the url's path starts
with the rule's path. Each rule becomes a regular expression over ``host/path`` and is
indexed under one token only, the literal token of it that is rarest among the urls. A
url's tokens (host labels and path segments) fetch candidate rules, and only those run
their expression; the longest rule that fits wins (ties: block first, then code point order).

Tokens of a rule are its host labels and its closed path segments (a last segment without
a ``/`` behind it may be the start of a longer one, so it is no token). Every rule has a
host, so every rule has a token and no rule needs to be tried on all urls.

Everything is DataFrame work: one count of the rules' tokens, one explode of url tokens
joined to the index, one aggregation by url. Urls are reduced to distinct ones before the
explode; the join back to the pages is an ordinary join that splits a hot url.

Defined cases: a null url, or one without ``://``, has empty host and path and gets the
default verdict; an empty rule list gives the default everywhere; repeated pages keep their
rows; other columns are kept (own columns ``host``, ``path``, ``rule``, ``verdict`` replace
columns of the same name).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url column; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_tokens(rule: str) -> list[str]:
    """Literal tokens that every url fitting the rule has: ``h:`` host labels, ``p:`` closed segments."""
    host, slash, path = rule.partition("/")
    out = [f"h:{x}" for x in host.translate(str.maketrans(UPPER, LOWER)).split(".") if x]
    closed = path.split("/")[:-1] if slash else []
    return list(dict.fromkeys(out + [f"p:{x}" for x in closed if x]))


def rule_pattern(rule: str) -> str:
    """The rule as a regular expression over ``host + path``."""
    host, slash, path = rule.partition("/")
    quoted = re.escape(host.translate(str.maketrans(UPPER, LOWER)))
    return rf"(?s)^(?:[^/]*\.)?{quoted}" + (f"/{re.escape(path)}" if slash else r"(?:/|\z)")


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url, in the form of :func:`rule_tokens`."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, parts))


def rule_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) pairs as a table with pattern and tokens."""
    rows = [(r, v, rule_pattern(r), rule_tokens(r)) for r, v in dict(rules).items()]
    if bad := [r for r, _, _, t in rows if not t]:
        raise ValueError(f"a rule needs a host: {bad[:5]}")
    return spark.createDataFrame(rows, "rule string, rule_verdict string, pattern string, tokens array<string>")


def judge(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null: none fits) and ``verdict``."""
    spark = pages.sparkSession
    table = rule_frame(spark, rules)
    host, path = url_parts(F.col("_url"))
    urls = (pages.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
            .select("_url", host.alias("_host"), path.alias("_path"))
            .withColumn("_token", F.explode(url_tokens(F.col("_host"), F.col("_path")))))
    # How many urls have each token of a rule; a token that no url has counts 0.
    literal = table.select("rule", F.explode("tokens").alias("token"))
    seen = urls.groupBy("_token").agg(F.count(F.lit(1)).alias("_urls"))  # added up in each task before tokens meet
    rarest = (literal.join(seen, literal.token == seen["_token"], "left")
              .groupBy("rule").agg(F.min(F.struct(F.coalesce("_urls", F.lit(0)).alias("n"), F.col("token"))).alias("m"))
              .select("rule", F.col("m.token").alias("_rarest")))
    index = table.join(rarest, "rule").select("_rarest", "rule", "rule_verdict", "pattern")
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("rule_verdict") == "block").alias("b"),
                          "rule", "rule_verdict"))
    fits = (urls.join(index, urls["_token"] == index["_rarest"])
            .where(F.expr("regexp_like(concat(_host, _path), pattern)"))
            .groupBy("_url").agg(best.alias("_best")))
    host, path = url_parts(F.col(url))
    own = ("host", "path", "rule", "verdict")
    return (pages.drop(*[c for c in own if c != url]).join(fits, F.col(url) == fits["_url"], "left")
            .withColumns({"host": host, "path": path, "rule": F.col("_best.rule"),
                          "verdict": F.coalesce(F.col("_best.rule_verdict"), F.lit(default))})
            .drop("_url", "_best"))
