"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import written


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every end of an edge (columns ``a``, ``b``);
    a component is named by its smallest id.

    Each round links, for every vertex, its larger neighbours to the smallest
    one (large star) and then its smaller neighbours to the smallest one (small
    star), until nothing changes: every vertex then points at its component's
    least id.  All steps are joins and minima with map-side aggregation; each
    round's table is written, and only its size and a checksum reach the driver.
    """
    links = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    state = None
    while True:
        # large star: neighbours above v point at the least of v and its neighbours
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: v and its neighbours below point at the least of them
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(low.select("a", F.col("m").alias("b"))).distinct()
        links = written(small, "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")) \
        .union(roots.select("id", F.col("id").alias("component")))
