"""Connected components of a stored edge list, with joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.llm.texts import settle


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``vertex, component`` (the least vertex it is joined to) for every vertex of ``links`` (longs ``a, b``).

    Alternates two steps: every vertex hands its larger neighbours to its least one, then its smaller ones
    (large-star and small-star). Neighbourhoods are only ever reduced to their minimum, never collected, and the
    number of edges does not grow. Each round is stored.
    """
    directed = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = settle(directed, "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("low"))
        large = both.join(least.hint("merge"), F.col("a") == F.col("v")).where("b > a")
        large = settle(large.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct(), "large-star")
        least = large.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low"))
        small = large.join(least.hint("merge"), F.col("a") == F.col("v"))
        onto = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = settle(onto.union(least.select(F.col("v").alias("a"), F.col("low").alias("b"))).distinct(), "small-star")
        seen, mark = mark, _mark(edges)
        if mark == seen:
            break
    roots = edges.select(F.col("b").alias("vertex")).distinct()
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
        roots.select("vertex", F.col("vertex").alias("component"))
    )
