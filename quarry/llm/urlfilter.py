"""URL filters (operator 9), in DataFrame functions alone.

Each URL is expanded into expressions, a suffix of its host (whole labels) joined with a prefix of its
path. Expressions are equi-joined with the rules on the first eight hex digits of their digests, the
full digests confirm the match, and the longest matching rule decides. Only suffixes of as many
labels, and prefixes of as many characters, as some rule has are made; no other can match.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule; a rule with a
null host, path or action takes no part; of equally long rules the one with the longer host wins, then
block; a null ``page_id`` stays null; repeated rows are judged each; an empty table gives an empty
one; further columns are ignored; without a rule the verdict is ``default``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that the join compares.
SHORT = 8


def url_host(url) -> F.Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UP, _LOW), F.lit(""))


def url_path(url) -> F.Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host, path) -> F.Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action), one per (host, path), with digests; block wins over allow."""
    host, path = F.translate("host", _UP, _LOW), F.col("path")
    clean = rules.filter("host is not null and path is not null and action in ('allow', 'block')")
    keyed = clean.select(host.alias("host"), path.alias("path"), "action").groupBy("host", "path").agg(F.max("action").alias("action"))
    return keyed.select(F.concat("host", "path").alias("rule"), "action", F.length("host").alias("host_length"), F.size(F.split("host", "\\.")).alias("labels"), F.length("path").alias("path_length"), _digest(F.col("host"), F.col("path")).alias("digest"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``.

    The distinct label counts and path lengths of the rules, two short lists of numbers below a URL's
    greatest length, are read first.
    """
    table = rule_table(rules)
    shape = table.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_length").alias("paths")).first()
    numbers = lambda xs: F.array(*(F.lit(x) for x in sorted(xs))).cast("array<int>")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels = rows.withColumn("parts", F.split("host", "\\."))
    suffixes = F.transform(F.filter(numbers(shape["labels"]), lambda n: (n <= F.size("parts")) & (F.col("host") != "")), lambda n: F.array_join(F.slice("parts", F.size("parts") - n + 1, n), "."))
    prefixes = F.transform(F.filter(numbers(shape["paths"]), lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    hosts = labels.select("row", "page_id", "host", "path", prefixes.alias("prefixes"), F.explode_outer(suffixes).alias("suffix"))
    expressions = hosts.select("row", "page_id", "host", "path", "suffix", F.explode_outer("prefixes").alias("prefix")).withColumn("full", _digest(F.col("suffix"), F.col("prefix")))
    posted = table.withColumn("short", F.substring("digest", 1, SHORT))
    found = expressions.withColumn("short", F.substring("full", 1, SHORT)).join(posted, "short", "left")
    best = F.struct((F.col("host_length") + F.col("path_length")).alias("length"), "host_length", "action", "rule")
    confirmed = F.when(F.col("full") == F.col("digest"), best)
    judged = found.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(confirmed).alias("best"))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
