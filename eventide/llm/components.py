"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable from every node of ``links`` (a, b).

    Each round every node takes the smallest label among its neighbours (an aggregation that
    combines in each task before the shuffle, so a node with very many links is no hot spot),
    then the label of its label. Rounds grow with the logarithm of the longest chain; every
    round is written to the shared folder, so no lineage builds up. Only the number of
    changed labels reaches the driver.
    """
    both = materialize(links.select("a", "b").where("a <> b").unionByName(
        links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("comp"))
    labels = materialize(labels, "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        hooked = labels.join(near, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        up = hooked.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = hooked.join(up, "comp").select("node", "old", F.least("comp", "up").alias("comp"))
        jumped = materialize(jumped, "labels")
        if not jumped.where("comp <> old").limit(1).count():
            return jumped.select("node", "comp")
        labels = jumped.select("node", "comp")
