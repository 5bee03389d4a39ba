"""Connected components of large graphs, as joins on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.skew import split_join
from cellweave.session import written


def components(edges: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group, v, u): for each vertex with a smaller one in its component, the smallest.

    ``edges``: (group, v, u) with vertices of any one orderable type; an edge joins vertices of
    one group. Alternates two steps until nothing changes: every vertex hands its smallest
    neighbour to its larger ones, then to its smaller ones. Trees flatten into stars in few
    rounds, whatever their shape. Minima are pre-aggregated, and a hub's neighbours are dealt
    over several tasks.
    """
    group = group or []
    edges = written(edges.select(*group, F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        turned = edges.select(*group, F.col("u").alias("v"), F.col("v").alias("u"))
        both = edges.unionByName(turned)
        least = written(both.groupBy(*group, "v").agg(F.min("u").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("v", "m")), "least")
        large = split_join(turned, least, [*group, "v"], "n").select(*group, F.col("u").alias("v"), F.col("m").alias("u"))
        large = written(large.where("u <> v").distinct(), "stars")
        least = written(large.groupBy(*group, "v").agg(F.min("u").alias("m"), F.count("*").alias("n")), "least")
        small = split_join(large, least, [*group, "v"], "n").select(*group, F.col("u").alias("v"), F.col("m").alias("u"))
        small = small.unionByName(least.select(*group, "v", F.col("m").alias("u"))).where("u <> v").distinct()
        edges = written(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64(*group, "u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy(*group, "v").agg(F.min("u").alias("u"))
        state = now
