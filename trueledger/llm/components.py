"""Links between different texts or vectors, turned into one row per document.

Equal documents are one class, known by a key; links are found between classes. What leaves a block of
compared classes is one count per class and a spanning forest of the block's links, never its pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trueledger.llm.common import stored


def forest(link: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first row reachable from it."""
    roots = np.arange(len(link))
    while True:
        lowest = np.where(link, roots[None, :], len(link)).min(axis=1, initial=len(link))
        new = np.minimum(roots, lowest)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: every node of ``edges (a, b)`` with the smallest node reachable from it.

    Alternates the large-star and small-star steps, whose rounds grow with the logarithm of the nodes.
    A node with very many neighbours is met as a skewed join key, never as one group. Each round is
    written to the shared folder.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        edges = new


def per_document(rows: DataFrame, classes: DataFrame, links: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, key, n_links, component_id, kept`` for each of ``rows (id, key)``.

    ``classes (key, rep, n)`` has each key's smallest id and number of rows, ``links (key, links)``
    partial counts of linked rows of other classes, ``edges (a, b)`` linked keys. A null key links
    with nothing. ``kept`` marks the rows with the smallest id of their component.
    """
    found = stored(components(edges), "components")
    named = found.join(classes.select(F.col("key").alias("node"), "rep"), "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_key = named.select(F.col("node").alias("key"), "component").join(smallest, "component").drop("component")
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    decided = classes.join(of_key, "key", "left").join(counts, "key", "left")
    decided = decided.where("n > 1 OR component_id IS NOT NULL OR links > 0").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")
    )
    return rows.join(stored(decided, "decided"), "key", "left").select(
        "id",
        "key",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
