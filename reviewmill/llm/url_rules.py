"""URL filtering by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.rows import column, fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
# Hex digits of a digest that the join compares; the rest is confirmed after it.
SHORT_DIGITS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def _host_suffixes(host: Column, most: int) -> Column:
    labels = F.split(host, r"\.")
    counts = F.slice(F.sequence(F.lit(1), F.lit(most)), F.lit(1), F.size(labels))
    return F.transform(counts, lambda n: F.array_join(F.slice(labels, -n, n), "."))


def _path_prefixes(path: Column, most: int) -> Column:
    """The parts of the path that end in ``/``."""
    parts = F.split(path, "/")
    counts = F.slice(F.sequence(F.lit(1), F.lit(most)), F.lit(1), F.size(parts) - 1)
    return F.transform(counts, lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))


def expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """Every suffix of the host with every prefix of the path, as one array."""
    suffixes = _host_suffixes(host, labels)
    prefixes = _path_prefixes(path, depth)
    return F.flatten(
        F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p)))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host
    and all subdomains, if the url's path starts with the rule's path, which
    has to end in ``/`` (else ValueError). The longest rule wins (host and path
    together), then the one with the longer host, then block. Without a rule
    the verdict is ``default``.

    Each distinct url is expanded once, only as deep as the deepest rule, and
    joined with the rules on the first hex digits of SHA-256; full digests
    confirm. Nothing is broadcast unless Spark measures it as small, and no
    html moves but in the last join, which brings verdicts to the pages.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and gets the default. Repeated pages get equal verdicts. Rules with a null
    host, path or verdict never fit; repeated rules count once. No rules or no
    pages are fine. Very long urls are cut no deeper than the deepest rule.
    """
    usable = rules.select("host", "path", "verdict").dropna().distinct()
    limits = usable.agg(
        F.max(F.size(F.split("host", r"\."))),
        F.max(F.size(F.split("path", "/")) - 1),
        F.count_if(~F.col("path").endswith("/")),
    ).first()
    if limits[2]:
        raise ValueError("the path of a rule has to end in /")
    labels, depth = limits[0] or 1, limits[1] or 1
    digested = usable.select(
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.sha2(F.concat("host", "path"), 256).alias("digest"),
        F.length("path").alias("path_length"),
    ).withColumn("short", F.left("digest", F.lit(SHORT_DIGITS)))

    urls = pages.select(F.col(url_col).alias("u")).filter("u IS NOT NULL").distinct()
    expanded = urls.select(
        "u", F.explode(expressions(host_of(F.col("u")), path_of(F.col("u")), labels, depth)).alias("e")
    ).select("u", F.sha2("e", 256).alias("d"))
    fitting = expanded.join(digested, F.left("d", F.lit(SHORT_DIGITS)) == F.col("short")).filter(
        "d = digest"
    )
    # The host is the shorter the longer the path is; block follows allow in the alphabet.
    order = F.struct(F.length("rule"), -F.col("path_length"), "verdict", "rule")
    winners = fitting.groupBy("u").agg(
        F.max_by(F.struct("rule", "verdict"), order).alias("won")
    )
    plain = pages.drop("host", "path", "rule", "verdict")
    # A column of pages may be called like one of ours.
    own, won = fresh("judged_url", plain), fresh("judged_won", plain)
    winners = winners.select(F.col("u").alias(own), F.col("won").alias(won))
    return plain.join(winners, F.col(url_col) == F.col(own), "left").select(
        *map(column, plain.columns),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
        F.col(f"{won}.rule").alias("rule"),
        F.coalesce(f"{won}.verdict", F.lit(default)).alias("verdict"),
    )
