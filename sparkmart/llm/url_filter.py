"""URL filter by hashed expressions: host suffixes and path prefixes against a rule list.

Each distinct (host, path) is expanded into the expressions host suffix + path prefix that some rule could have: only
suffixes with as many labels, and prefixes with as many characters, as occur in the rules, which loses none and keeps
very long URLs cheap. Expressions are joined to the rules on the first ``PREFIX`` hex digits of their SHA-256, then the
full digests are compared. Of the rules that fit, the one with the longest text (host and path) wins; among equally long
ones the block rule, then the smaller text. What no rule fits is allowed. All of it is DataFrame operations.

Nulls: a null URL, or one without ``://``, has empty host and path and is allowed. An empty rule list allows everything.
Rules with a null part are ignored; repeated rules count once. Repeated rows stay. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.frames import col, fresh

PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _rules(rules: DataFrame) -> DataFrame:
    clean = rules.select(lower_ascii(F.col("host")).alias("host"), F.col("path"), F.col("action")).dropna().distinct()
    return clean.select(
        F.concat("host", "path").alias("rule"),
        F.col("action"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("letters"),
        _digest(F.concat("host", F.lit("\n"), "path")).alias("digest"),
    )


def matches(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the winning rule for each distinct (host, path) that some rule fits."""
    listed = _rules(rules)
    shapes = listed.agg(
        F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("letters")).alias("letters")
    )  # one row, at most one entry a length
    first = shapes.first()
    labels, letters = (first["labels"] or [], first["letters"] or []) if first else ([], [])
    if not labels:
        return places.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action")).limit(0)
    parts = F.split("host", r"\.")
    count = F.size(parts)
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(x) for x in labels]), lambda n: n <= count),
        lambda n: F.array_join(F.slice(parts, count - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(x) for x in letters]), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p))))
    expanded = (
        places.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(expressions).alias("expression"))
        .select("host", "path", _digest(F.col("expression")).alias("full"))
    )
    hit = expanded.join(listed, F.substring("full", 1, PREFIX) == F.substring("digest", 1, PREFIX)).where(
        F.col("full") == F.col("digest")
    )
    rank = F.struct(
        (-F.length("rule")).alias("length"), F.when(F.col("action") == "block", 0).otherwise(1).alias("order"), "rule", "action"
    )
    return hit.groupBy("host", "path").agg(F.min(rank).alias("best")).select("host", "path", "best.rule", "best.action")


def verdicts(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict; columns of these names are replaced.

    ``rules`` has host, path and action (``allow`` or ``block``).
    """
    names = ("host", "path", "rule", "verdict")
    others = [c for c in pages.columns if c.lower() not in names]
    row = fresh(names, "row")
    placed = pages.select(F.struct(*[col(c) for c in others]).alias(row), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"))
    found = matches(placed, rules).select(F.struct("*").alias("found"))
    joined = placed.join(found, (F.col("host") == F.col("found.host")) & (F.col("path") == F.col("found.path")), "left")
    return joined.select(
        *[F.col(row)[c].alias(c) for c in others],
        "host", "path", F.col("found.rule").alias("rule"), F.coalesce(F.col("found.action"), F.lit("allow")).alias("verdict"),
    )
