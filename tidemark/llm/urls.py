"""URL filters: host-suffix and path-prefix expressions, matched by hash.

A rule is filed under its host and its path up to the last ``/``; its shape is
how many labels and how many slashes these have. Each distinct (host, path) is
expanded into host suffixes at a label boundary with path prefixes that end
with ``/`` (or are empty), one expression for each shape that a rule has: no
other expression can match, and a URL of any length is read once a shape. The
shapes are collected; k of them need rules of k * sqrt(k) characters or so in
all, so they stay few. Both sides are joined on the first eight hex digits of the expression's SHA-256; a
candidate counts when the full digest is the same and the URL's path starts
with the rule's whole path. The longest rule (host and path together) wins;
among equals the longer host, then ``block``, then the rule text.

Results at the edges: a null URL or one without ``://`` has an empty host and
path and gets the default verdict, as does a URL that no rule fits. Repeated
URLs are matched once and each row gets the verdict. Rules with a null host
or path count as empty ones; a rule with an empty host fits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

PREFIX = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (labels of the host, slashes of the path) of prepared rules."""
    slashes = F.size(F.split("r_path", "/")) - 1
    rows = rules.select(F.size(F.split("r_host", r"\.")).alias("labels"), slashes.alias("slashes")).distinct().collect()
    return sorted((r["labels"], r["slashes"]) for r in rows)


def _expressions(host: Column, path: Column, wanted: list[tuple[int, int]]) -> Column:
    """The (suffix, directory) pair of one URL for each wanted shape that it can have."""
    every = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(d).alias("slashes")) for a, d in wanted])
    labels, slashes = F.size(F.split(host, r"\.")), F.size(F.split(path, "/")) - 1
    fitting = F.filter(every, lambda x: (x["labels"] <= labels) & (x["slashes"] <= slashes))

    def expression(x: Column) -> Column:
        folder = F.concat(F.call_function("substring_index", path, F.lit("/"), x["slashes"]), F.lit("/"))
        return F.struct(
            F.call_function("substring_index", host, F.lit("."), -x["labels"]).alias("h"),
            F.when(x["slashes"] == 0, F.lit("")).otherwise(folder).alias("p"),
        )

    return F.transform(fitting, expression)


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (action, host, path) with their folder's digest."""
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    return (
        rules.select(F.col("action"), host.alias("r_host"), path.alias("r_path"))
        .filter("r_host <> ''")
        .distinct()
        .withColumn("digest", _digest(F.col("r_host"), F.regexp_extract("r_path", r"(?s)^(.*/)?", 0)))
        .withColumn("short", F.substring("digest", 1, PREFIX))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path, or null) and ``verdict``.

    Columns of ``pages`` with these names are replaced.
    """
    named = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict")
    r = cut(prepared(rules))
    wanted = shapes(r)
    if not wanted:
        return named.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    distinct = named.select("host", "path").filter("host <> ''").distinct()
    asked = distinct.withColumn("x", F.explode(_expressions(F.col("host"), F.col("path"), wanted))).select(
        "host", "path", _digest(F.col("x.h"), F.col("x.p")).alias("full")
    )
    hit = asked.withColumn("short", F.substring("full", 1, PREFIX)).join(r, "short")
    hit = hit.filter((F.col("full") == F.col("digest")) & F.startswith(F.col("path"), F.col("r_path")))
    rank = F.struct(
        (F.char_length("r_host") + F.char_length("r_path")).alias("n"),
        F.char_length("r_host").alias("n_host"),
        (F.col("action") == "block").alias("blocks"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("action").alias("action"),
    )
    # written, so that both sides of the join are plain shuffles and a URL of very many rows can be split
    best = cut(hit.groupBy("host", "path").agg(F.max(rank).alias("best")))
    out = named.join(best, ["host", "path"], "left")
    return out.select(
        *[F.col(f"`{c}`") for c in named.columns],
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
