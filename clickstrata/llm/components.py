"""Connected components by label stars; every round is written, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickstrata.llm.common import release, store

# Up to this many links a round's joins go by broadcast.
BROADCAST_LINKS = 50_000


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the links (x, y); a component is its least node.

    Alternates two steps, each an aggregation and a join on single nodes: every
    node links its larger neighbours to its least one, then its smaller
    neighbours. Links shrink to stars in a number of rounds that grows with the
    logarithm of the longest path; they never become more.
    """
    links = store(
        links.where(F.col("x") != F.col("y")).select(
            F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
        ),
        "links",
        few=True,
    )
    rows = links.count()
    joined = F.broadcast if rows <= BROADCAST_LINKS else (lambda frame: frame)
    while True:
        # What is linked with a smaller node has one such in a star, and no larger one.
        both = links.select("x", "y", F.col("y").alias("smaller")).unionAll(
            links.select(F.col("y").alias("x"), F.col("x").alias("y"), F.lit(None).cast("long"))
        )
        nodes = both.groupBy("x").agg(
            F.least("x", F.min("y")).alias("low"),
            F.coalesce(
                (F.min("smaller") < F.max("smaller")) | (F.max("y") > F.col("x")) & (F.min("y") < F.col("x")),
                F.lit(False),
            ).alias("open"),
        )
        nodes = store(nodes, "nodes", rows=2 * rows)
        if nodes.where("open").isEmpty():
            release(links)
            return nodes.select(F.col("x").alias("node"), F.col("low").alias("component"))
        least = nodes.select("x", "low")
        large = (
            links.select(F.col("y").alias("x"), F.col("x").alias("y"))
            .join(joined(least), "x")
            .select(F.col("y").alias("x"), F.col("low").alias("y"))
        )
        lower = large.groupBy("x").agg(F.min("y").alias("low"))
        shrunk = (
            large.join(joined(lower), "x")
            .select(
                F.when(F.col("y") == F.col("low"), F.col("x")).otherwise(F.col("y")).alias("x"),
                F.col("low").alias("y"),
            )
            .where(F.col("x") != F.col("y"))
            .distinct()
        )
        after = store(shrunk, "links", rows=rows)
        release(links, nodes)
        links = after
