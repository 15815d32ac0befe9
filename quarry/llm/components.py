"""Connected components by label propagation with shortcuts, on DataFrames only.

Every node carries the smallest node known to be in its component.  A round
takes the smallest label among a node's neighbours, then the label of that
label (pointer jumping, so chains shrink by half), and is written to the shared
folder: lineage is cut, a lost executor costs one stage, and only "did any
label change" reaches the driver.  Minima combine map-side and the joins
read plain or freshly shuffled rows on both sides, so Spark splits a hub's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import discard, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another; component is the smallest node.

    Loops, repeated edges and null ends are ignored; no edges give an empty table.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = written(ends.union(ends.select("v", "u")).distinct(), "components")
    labels = written(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select("node", F.least("node", "v").alias("label")), "components")
    while True:
        near = e.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        moved = hooked.join(jump, "next").select("node", F.least("next", "beyond").alias("label"), (F.least("next", "beyond") != F.col("label")).alias("changed"))
        before, labels = labels, written(moved, "components")
        discard(before)
        if labels.where("changed").isEmpty():
            discard(e)
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.drop("changed")
