"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node it reaches.

    Each round contracts the links to links between labels, hooks every label to the smallest
    label next to it and follows that step twice, so long chains shrink by powers; rounds end
    when no link joins two labels. Labels are written tables; nothing comes to the driver.
    """
    open_ = written(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "links")
    nodes = open_.select(F.col("lo").alias("node")).union(open_.select("hi")).distinct()
    labels = nodes.withColumn("component", F.col("node"))
    while not open_.isEmpty():
        hook = open_.groupBy("hi").agg(F.min("lo").alias("lo"))
        for _ in range(2):
            nxt = hook.select(F.col("hi").alias("lo"), F.col("lo").alias("next"))
            hook = hook.join(nxt, "lo", "left").select("hi", F.coalesce("next", "lo").alias("lo"))
        hook = written(hook, "hooks")
        labels = written(labels.join(hook, labels["component"] == hook["hi"], "left")
                         .select("node", F.coalesce("lo", "component").alias("component")), "labels")
        # The links between the new labels.
        to = lambda c: hook.select(F.col("hi").alias(c), F.col("lo").alias(f"_{c}"))
        ends = open_.join(to("lo"), "lo", "left").join(to("hi"), "hi").select(F.coalesce("_lo", "lo").alias("x"), F.col("_hi").alias("y"))
        open_ = written(ends.where("x <> y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct(), "links")
    return labels
