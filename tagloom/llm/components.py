"""Connected components of a graph of long node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import written



def _star(pairs: DataFrame, bigger: bool) -> DataFrame:
    """Hangs neighbours on the smallest node of each neighbourhood.

    ``pairs`` has (node, other). With ``bigger`` only the neighbours larger than
    the node are moved to it, else all of them and the node itself. The
    minimum is written before it is joined back: a node with very many
    neighbours is then a plain skewed join, which Spark splits.
    """
    least = written(
        pairs.groupBy("node").agg(F.least(F.min("other"), "node").alias("least")), "component-minimum"
    )
    moved = pairs.join(least, "node")
    if bigger:
        return moved.filter(F.col("other") > F.col("node")).select("least", F.col("other").alias("far"))
    both = F.array("other", "node")
    return moved.select("least", F.explode(both).alias("far")).filter(F.col("far") > F.col("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two long columns): root is the smallest node it can reach.

    Alternating large and small stars: each round hangs larger neighbours on
    the smallest node of a neighbourhood, then smaller ones, until nothing
    moves. The number of rounds grows with the logarithm of the longest chain.
    Rounds are written to the shared folder. No links give no rows; a link with
    a NULL end or from a node to itself is ignored.
    """
    a, b = links.columns
    edges = written(
        links.filter(F.col(a) != F.col(b))
        .select(F.least(a, b).alias("least"), F.greatest(a, b).alias("far"))
        .distinct(),
        "component-links",
    )
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("least", "far").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == before or state.n == 0:
            return edges.select(F.col("far").alias("node"), F.col("least").alias("root")).unionByName(
                edges.select(F.col("least").alias("node"), F.col("least").alias("root")).distinct()
            )
        before = state
        forth = edges.select(F.col("least").alias("node"), F.col("far").alias("other"))
        back = edges.select(F.col("far").alias("node"), F.col("least").alias("other"))
        large = _star(forth.unionByName(back), True).distinct()
        large = written(large.select(F.col("far").alias("node"), F.col("least").alias("other")), "component-large")
        edges = written(_star(large, False).distinct(), "component-links")
