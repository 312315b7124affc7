"""Connected components of an edge table, in rounds of stored tables.

Edges with a missing end, loops and repeated edges count for nothing; without edges there are
no rows. Other columns are ignored. A vertex in very many edges is joined by a shuffle, which
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspan.session import materialize


def jumped(parents: DataFrame) -> DataFrame:
    """(v, root) out of (v, p) where every p is smaller than its v: pointers double each round."""
    current = materialize(parents.select("v", F.col("p").alias("root")), "pointers")
    while True:
        up = current.select(F.col("v").alias("w"), F.col("root").alias("above"))
        step = current.join(up, F.col("root") == F.col("w"), "left")
        step = materialize(
            step.select(
                "v", F.coalesce("above", "root").alias("root"), F.col("w").isNotNull().alias("moved")
            ),
            "pointers",
        )
        current = step.select("v", "root")
        if step.filter("moved").isEmpty():
            return current


def relabelled(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """`df` with the vertex in `column` replaced by its root, if `roots` (v, root) has one."""
    named = roots.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
    joined = df.join(named, F.col(column) == F.col("_v"), "left")
    return joined.withColumn(column, F.coalesce("_root", column)).drop("_v", "_root")


def composed(first: DataFrame, second: DataFrame) -> DataFrame:
    """Roots (v, root) of `first` whose own roots `second` joins further."""
    return materialize(relabelled(first, "root", second).unionByName(second), "roots")


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of `edges` (a, b) that isn't its component's smallest.

    Each round hooks a vertex onto its smallest smaller neighbour, follows the pointers to
    their roots and contracts the edges. Vertices that survive a round have no smaller
    neighbour, so at most half of them do, and the rounds grow with the logarithm.
    """
    left = materialize(_oriented(edges), "edges")
    found: DataFrame | None = None
    while not left.isEmpty():
        roots = jumped(left.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")))
        found = roots if found is None else composed(found, roots)
        contracted = relabelled(relabelled(left, "a", roots), "b", roots)
        left = materialize(_oriented(contracted), "edges")
    if found is None:
        return left.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return found
