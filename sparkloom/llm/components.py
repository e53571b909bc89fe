"""Connected components of links that may be more than any machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import keep


def _mark(edges: DataFrame) -> tuple:
    """A number that changes when the edges do."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, root) for the nodes of the links ``a``-``b``, with a not b.

    ``root`` is the smallest node that can be reached, itself included. Two
    steps alternate until nothing changes: each node hands its larger
    neighbours to its smallest one, then each node hands its smaller
    neighbours and itself to the smallest one. The number of rounds grows with
    the logarithm of the longest path. Every step is a grouped minimum and a
    join on the node; its result is written to the shared folder, so a round
    never runs the ones before again, and a join to a written table lets Spark
    split the rows of a node with very many neighbours.
    """
    now = keep(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        label,
    )
    mark = _mark(now)
    while mark[0]:
        # a > b. Large step: to the smallest of the neighbours and the node.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = keep(
            both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), label
        )
        large = keep(
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(),
            label,
        )
        # Small step, over the neighbours that are smaller.
        least = keep(large.groupBy("a").agg(F.min("b").alias("m")), label)
        moved = (
            large.join(least, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        now = keep(
            moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), label
        )
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    own = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return keep(roots.unionByName(own), label)
