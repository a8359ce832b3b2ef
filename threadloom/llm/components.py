"""Connected components by alternating large and small stars, each round a few joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every neighbour is hung on the smallest node that its middle node sees."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
    lower = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(lower.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): for each node ``u`` with links, except the smallest of its component, that smallest ``v``.

    ``edges`` has two comparable columns; direction, repeats and loops do not matter, rows with a null
    are no links. Each round is stored in the shared folder, so lineage stays short; rounds grow with
    the logarithm of the longest chain. An empty table gives an empty one.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct(),
        "edges",
    )
    sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = sign(now)
    while before[0]:
        now = stored(_stars(now), "stars")
        after = sign(now)
        if after == before:
            break
        before = after
    return now
