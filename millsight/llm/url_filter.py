"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes.

Every URL is expanded into the expressions a rule could have been written as: each suffix of its host
at a label boundary, followed by each prefix of its path that is as long as some rule's path. An
equi-join on the first four bytes of the expressions' digests finds candidates, the full digest
confirms them, and the rule that wins is the longest one.

Defined results: a null URL or one without ``://`` has empty host and path; an empty path starts with
no rule's path; no rule at all gives the default verdict. Of two equally long rules the one with the
longer host wins, then ``block``. A rule with a null host, path or verdict is ignored; rules repeated
word for word count once. Rows are judged one by one, so repeated rows stay repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHORT_BYTES = 4


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` -> [``a.b.c``, ``b.c``, ``c``]."""
    labels = F.split(host, r"\.", -1)
    places = F.sequence(F.lit(1), F.size(labels))
    return F.transform(places, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def apply_rules(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``_host``, ``_path``, ``_rule`` and ``_verdict`` (columns of those names are replaced).

    ``rules`` has host, path and verdict. The lookup runs on distinct (host, path) pairs, so a URL that
    fills a third of the table is expanded once; only the URLs with a rule are joined back.
    """
    known = rules.select("host", "path", "verdict").dropna().distinct()
    lengths = known.agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    known = known.select(
        F.col("host").alias("rule_host"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        _digest(F.concat_ws("\n", "host", "path")).alias("full"),
    ).withColumn("short", F.substring("full", 1, SHORT_BYTES))

    host, path = split_url(F.col(url))
    pages = pages.withColumns({"_host": host, "_path": path})
    # One row; its array holds the distinct path lengths of the rules, at most the longest URL's length.
    urls = pages.select("_host", "_path").distinct().join(F.broadcast(lengths))
    fitting = F.filter("lengths", lambda n: n <= F.length("_path"))
    starts = F.transform(fitting, lambda n: F.substring(F.col("_path"), F.lit(1), n))
    asked = (
        urls.withColumn("_suffix", F.explode(host_suffixes(F.col("_host"))))
        .withColumn("_start", F.explode(starts))
        .withColumn("_full", _digest(F.concat_ws("\n", "_suffix", "_start")))
        .withColumn("_short", F.substring("_full", 1, SHORT_BYTES))
    )
    found = asked.join(
        known, (F.col("_short") == F.col("short")) & (F.col("_full") == F.col("full"))
    )
    rank = F.struct(
        F.length("rule"), F.length("rule_host"), F.col("verdict") == "block", F.col("rule")
    )
    won = found.groupBy("_host", "_path").agg(
        F.max_by(F.struct("rule", "verdict"), rank).alias("_won")
    )
    judged = pages.drop("_won").join(won, ["_host", "_path"], "left")
    return judged.withColumns(
        {
            "_rule": F.col("_won.rule"),
            "_verdict": F.coalesce(F.col("_won.verdict"), F.lit(default)),
        }
    ).drop("_won")
