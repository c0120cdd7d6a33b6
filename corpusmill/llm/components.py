"""Connected components of a distributed edge list, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, salted_join


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node that has an edge; component is the smallest id reachable.

    Each round hooks every node to its smallest neighbour, follows two hooks, and contracts the
    edges, so stars finish in one round and paths in logarithmically many. Only counts and the hashes of
    hubs reach the driver; hubs are handled by partial minima and salted joins. Nodes may be of any
    type that can be ordered. The result's table is the only one left.
    """
    e = cut(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    labels = None
    while e.limit(1).count():
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v"), F.col("u")))
        near = cut(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("y")))
        second = near.select(F.col("x").alias("y"), F.col("y").alias("z"))
        hook = cut(salted_join(near, second, ["y"], "left").select("x", F.coalesce("z", "y").alias("to")))
        last = [near, e]
        if labels is None:
            labels = cut(hook.select(F.col("x").alias("id"), F.col("to").alias("component")))
        else:
            step = hook.select(F.col("x").alias("component"), "to")
            last.append(labels)
            labels = cut(salted_join(labels, step, ["component"], "left").select("id", F.coalesce("to", "component").alias("component")))
        half = cut(salted_join(e, hook.select(F.col("x").alias("u"), F.col("to").alias("tu")), ["u"]).select("tu", "v"))
        left = salted_join(half, hook.select(F.col("x").alias("v"), F.col("to").alias("tv")), ["v"])
        e = cut(left.where("tu != tv").select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v")).distinct())
        forget(*last, hook, half)
    if labels is None:
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    forget(e)
    return labels
