"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = both.join(_least(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node in ``links`` (u, v) but the least ones themselves.

    Links that repeat or link a node to itself change nothing; no links give no rows.
    """
    now = shared.materialize(links.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        now = shared.materialize(_small(_large(now)), "stars")
        last, mark = mark, _mark(now)
        if last == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
