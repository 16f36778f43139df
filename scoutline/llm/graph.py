"""Connected components of a table of links, in a logarithmic number of distributed rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoutline.session import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node.

    Rounds of large-star and small-star: first every node links its greater neighbours to the
    smallest node it knows, then its smaller ones. Both are a minimum with map-side combine and a
    join that reads the links of a node, two numbers each, one after the other; no more links are made
    than there were. Each round is a written table. Ends when a round changes nothing. NULL ends are left out.
    """
    edges = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter("a > b")
        .distinct()
    )
    edges = stored(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
