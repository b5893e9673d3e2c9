"""Connected components of a graph that is a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.store import materialize


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest reachable node, long) for every node of ``links(a, b)``.

    Rounds of contraction: every node hooks to its smallest neighbour, chains of hooks are halved by joining the table
    with itself until all point to a root, and links between roots go into the next round. All joins are between
    written tables, so a node with very many links is split by adaptive execution. No links: no rows.
    """
    edges = materialize(
        links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
        parent = _flatten(materialize(parent, "parents"))
        labels = parent if labels is None else materialize(_relabel(labels, "component", parent), "labels")
        contracted = _relabel(_relabel(edges, "a", parent), "b", parent).where("a <> b")
        edges = materialize(
            contracted.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _relabel(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    to = parent.select(F.col("node").alias("_node"), F.col("component").alias("_to"))
    names = df.columns
    df = df.join(to, df[column] == to["_node"], "left").withColumn(column, F.coalesce("_to", column))
    return df.select(*names)


def _flatten(parent: DataFrame) -> DataFrame:
    while True:
        up = parent.select(F.col("node").alias("_node"), F.col("component").alias("_up"))
        joined = parent.join(up, parent["component"] == up["_node"])
        nearer = materialize(joined.select("node", F.col("_up").alias("component"), (F.col("_up") != F.col("component")).alias("moved")), "parents")
        parent = nearer.select("node", "component")
        if nearer.where("moved").isEmpty():
            return parent
