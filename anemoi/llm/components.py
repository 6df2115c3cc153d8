"""Connected components of a distributed link table: smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b): comp is the smallest node reachable.

    Each round a node takes the smallest label among its own and its neighbours', then the
    label of its label. Labels are minima, so groups of any size combine on the map side;
    chains halve every round. The labels are written once a round, which cuts the lineage.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near")))
        low = (labels.join(near, labels.node == near.a)
               .select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")))
        low = saved(low, "low")
        top = low.select(F.col("node").alias("t_node"), F.col("comp").alias("t_comp"))
        new = saved(low.join(top, low.comp == top.t_node)
                    .select("node", "old", F.least("comp", "t_comp").alias("comp")), "labels")
        labels = new.select("node", "comp")
        if new.where("old <> comp").isEmpty():
            return labels
