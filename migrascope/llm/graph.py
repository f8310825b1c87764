"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migrascope.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(v, least): each vertex of the links (a, b) with the least vertex it can reach.

    A large star hangs greater neighbours on a vertex's least neighbour, a small star does so with lesser
    ones; both keep what is connected, and in a logarithmic number of rounds each component is one star. The
    rows never exceed the links, each round is written to the shared folder, and the least neighbours are
    aggregated before the shuffle, so that a vertex with very many links is no more than a skewed join.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.filter("u > v").join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = written(large, "stars")  # read three times below: one plan of both stars would hold the links a dozen times
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        hung = large.join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = hung.unionByName(least.select("v", F.col("m").alias("u")))
        edges = written(small.distinct(), "links")
        now = _state(edges)
        if now == state:
            return edges.select("v", F.col("u").alias("least")).unionByName(edges.select(F.col("u").alias("v"), F.col("u").alias("least")).distinct())
        state = now


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the links."""
    mixed = F.xxhash64("v", "u").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*").alias("n"), F.sum(mixed).alias("digest")).first())
