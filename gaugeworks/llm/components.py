"""Connected components of a graph of links, by contraction.

Each round every vertex hooks on to its smallest neighbour if that is smaller, the hooks are
followed to their ends, and the links are rewritten to the ends. Only local minima are left, so the
graph shrinks fast whatever its shape. Minima are combined on the map side, so a vertex with very
many links costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import materialise


def _ends(hooks: DataFrame) -> DataFrame:
    """(v, to) with ``to`` followed until it has no hook itself."""
    while True:
        onward = hooks.select(F.col("v").alias("to"), F.col("to").alias("next"))
        moved = materialise(
            lookup_join(hooks, onward, ["to"]).select(
                "v", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")
            ),
            "hooks",
        )
        hooks = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """(v, root) of every vertex with a link in ``links`` (a, b); the root is the smallest one."""
    links = materialise(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = links.select(F.col("a").alias("v")).union(links.select("b")).distinct()
    labels = materialise(labels.withColumn("root", F.col("v")), "labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("to")).filter("to < v")
        ends = _ends(materialise(hooks, "hooks"))
        to = ends.select(F.col("v").alias("root"), "to")
        labels = materialise(
            lookup_join(labels, to, ["root"]).select("v", F.coalesce("to", "root").alias("root")),
            "labels",
        )
        left = lookup_join(links, ends.withColumnsRenamed({"v": "a", "to": "ta"}), ["a"])
        left = lookup_join(left, ends.withColumnsRenamed({"v": "b", "to": "tb"}), ["b"])
        left = left.select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b"))
        links = materialise(left.filter("a <> b").distinct(), "links")
    return labels
