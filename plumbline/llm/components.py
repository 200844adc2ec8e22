"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import written

MAX_ROUNDS = 200


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node that it reaches.

    Every round a node takes the smallest label around it and then its label's own label, so labels
    reach double as far each round. All sums are minima, which tasks take before they shuffle: a
    node with very many edges is no burden. Each round is written to the shared folder.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(around, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = closer.join(jump, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "old")
        new = written(new, "labels")
        moved = new.where("label <> old").limit(1).count()
        labels = new.drop("old")
        if not moved:
            return labels
    raise RuntimeError("a component is too long a chain")
