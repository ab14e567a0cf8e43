"""Connected components of a graph of long node ids, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """Least node id that each node reaches.

    Alternates the large-star and small-star steps: every node's larger (then smaller) neighbours are tied to
    the least node it knows, until nothing changes, which takes about log(n) rounds. Each step sees edges
    only, a node of many edges is summed in partial aggregates before the shuffle, and each round is
    written to the shared folder, so that no round depends on the memory of an executor.

    :param edges: columns ``a``, ``b`` (long); either order, loops and repeats allowed; null ends are left out.
    :return: ``node``, ``component``; nodes without an edge to another node are absent.
    """
    kept = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b AND a IS NOT NULL AND b IS NOT NULL")
        .distinct()
    )
    kept = materialize(kept)
    mark = None
    while True:
        kept = materialize(_small_star(_large_star(kept)))
        row = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == row:
            return kept.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                kept.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = row


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # a > b in every edge here
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
