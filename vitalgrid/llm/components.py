"""Connected components of an edge table by repeated contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import written


def components(edges: DataFrame) -> DataFrame:
    """One row (id, component) per id of `edges` (columns a, b): the smallest id that it can reach.

    Each round points every id at its smallest neighbour or itself, renames the ends of the edges
    so and drops loops and repeats, so the edge table shrinks; the pointers of all rounds are
    followed as they arise. An id with very many edges only adds partial minima.
    """
    left = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                   "edges")
    found = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointer = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")), "pointers")
        if found is None:
            found = pointer.select(F.col("a").alias("id"), F.col("to").alias("component"))
        else:
            follow = pointer.select(F.col("a").alias("component"), "to")
            found = attach(found, follow, ["component"], computed=True).select(
                "id", F.coalesce("to", "component").alias("component")
            )
        found = written(found, "components")
        renamed = attach(left, pointer.select("a", F.col("to").alias("x")), ["a"], computed=True)
        renamed = attach(renamed, pointer.select(F.col("a").alias("b"), F.col("to").alias("y")), ["b"], computed=True)
        left = written(
            renamed.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
    if found is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found
