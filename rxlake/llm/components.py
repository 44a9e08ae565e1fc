"""Connected components of an edge list, on Spark only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import cut


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u > v)."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.filter("u <> v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of an edge; root is the smallest node of
    its component.

    Alternating large-star/small-star rounds until the star forest stands
    still; each round is written to the checkpoint folder.  Minima are
    partially aggregated before the shuffle and the joins are plain equi-joins
    that Spark can split at a hot centre, so a component holding a third of
    all nodes is not gathered anywhere.  Null ends and self-loops are ignored.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = cut(e.filter((F.col("u") != F.col("v")) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    mark = None
    while True:
        seen = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == mark or not seen["n"]:
            break
        mark = seen
        e = cut(_stars(e))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
