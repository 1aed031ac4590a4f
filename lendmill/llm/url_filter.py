"""URL filter by pattern rules, in DataFrame functions only.

A rule names a host, which stands for its subdomains too, and the start of a path;
``*`` in a path stands for any characters. Each rule is indexed by its rarest literal
token, a run of ASCII letters and digits with a known border on both sides, counted
over the URLs to be judged. A URL's tokens fetch candidate rules, and only those run
as regular expressions. A rule without such a token is fetched by every URL. Of the
rules that fit, higher ``priority``, then the longer host and path wins; then block.

How it runs: rows equal in key and URL are judged once and expanded again; one URL under many
keys is judged for each, in as many tasks. The index is broadcast if its rows are few, counted first; a larger one is
joined by token and a part of the URL's hash, so that a token every URL has is spread.

Defined results: null URL, or one without ``://``: host and path empty, and only rules
that match those apply. Repeated rows stay. No rules: the default verdict. Columns
besides key and URL are not carried, so their names cannot clash. Empty table: empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.columns import written

ALLOW, BLOCK = "allow", "block"

#: An index of up to this many rows is broadcast.
BROADCAST_RULES = 50_000

#: Parts that a token is spread over when the index is too large for that.
SPREAD = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def tokens(host_and_path: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(host_and_path, F.lit(r"[A-Za-z0-9]+"), 0))


def _compiled(rules: DataFrame) -> DataFrame:
    """Rules with ``pattern``, to be found in host and path together, and their ``literals``."""
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    path = F.coalesce("path", F.lit(""))

    def quoted(text: Column) -> Column:
        return F.regexp_replace(text, r"([^A-Za-z0-9\x{80}-\x{10FFFF}])", r"\\$1")

    whole_host = F.when(host == "", r"^[^/]*").otherwise(F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted(host)))
    after = F.when(path == "", r"(?=/|$)").otherwise(F.replace(quoted(path), F.lit(r"\*"), F.lit(r"[\s\S]*")))
    text = F.concat(host, F.when(path == "", "/").otherwise(path))
    return rules.select(
        "rule",
        "verdict",
        "priority",
        (F.length(host) + F.length(path)).alias("size"),
        F.concat(whole_host, after).alias("pattern"),
        F.array_distinct(
            F.regexp_extract_all(
                text, F.lit(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])(?!$)"), 0
            )
        ).alias("literals"),
    )


def rule_index(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Rules with ``token``, the rarest of their literals among the rows of ``url_tokens``
    (column ``token``, a row per URL and token); ties go to the longer, then the smaller token."""
    compiled = _compiled(rules)
    literals = compiled.select(F.explode("literals").alias("literal")).distinct()
    few = literals.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    literals = F.broadcast(literals) if few else literals
    counted = (
        url_tokens.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(literals, F.col("token") == F.col("literal"))
        .select("literal", "n")
    )
    one = compiled.select("*", F.explode_outer("literals").alias("token")).drop("literals")
    one = one.join(counted, F.col("token") == F.col("literal"), "left")
    rarest = F.min_by(
        F.coalesce("token", F.lit("")),
        F.struct(F.coalesce("n", F.lit(0)), -F.length(F.coalesce("token", F.lit(""))), "token"),
    )
    return one.groupBy("rule", "verdict", "priority", "size", "pattern").agg(rarest.alias("token"))


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = ALLOW,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """``key``, ``url``, ``host``, ``path``, ``rule`` (null if none fits), ``priority``, ``verdict``.

    ``rules`` has rule, host, path, verdict and priority.
    """
    rows = (
        pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
        .groupBy("key", "url")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    host, path = url_parts(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    found = tokens(F.concat("host", "path"))
    seen = rows.select(F.explode(found).alias("token"))
    index = written(rule_index(rules, seen).withColumnRenamed("token", "by"), "url-rules")
    asked = rows.select("*", F.explode(F.concat(F.array(F.lit("")), found)).alias("token"))
    if index.limit(broadcast_rules + 1).count() <= broadcast_rules:
        fetched = asked.join(F.broadcast(index), asked.token == index.by, "left")
    else:
        part = F.pmod(F.xxhash64("key", "url"), F.lit(SPREAD))
        spread = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
        fetched = asked.withColumn("own", part).join(
            spread, (F.col("token") == F.col("by")) & (F.col("own") == F.col("part")), "left"
        )
    fits = F.rlike(F.concat("host", "path"), F.col("pattern"))
    best = F.max(F.when(fits, F.struct("priority", "size", "verdict", "rule"))).alias("best")
    judged = fetched.groupBy("key", "url", "host", "path", "times").agg(best)
    return judged.select(
        F.col("key").alias(key),
        F.col("url").alias(url),
        "host",
        "path",
        "best.rule",
        "best.priority",
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"),
    ).drop("time")
