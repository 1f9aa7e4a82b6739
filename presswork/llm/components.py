"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.shared import BROADCAST_ROWS
from presswork.plans.lookup import lookup_join
from presswork.plans.stage import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` is connected with.

    Every round takes the smallest label among the neighbours, then the label of that label, so
    the number of rounds grows with the logarithm of a long chain. Each round is a written table.
    """
    one, other = F.col(a), F.col(b)
    both = staged(
        edges.select(one.alias("from"), other.alias("to")).union(edges.select(other, one)).distinct(), "edges"
    )
    degree = F.count(F.lit(1)).alias("degree")
    labels = staged(
        both.groupBy(F.col("from").alias("node")).agg(degree, F.min("to").alias("least")).select(
            "node", F.least("node", "least").alias("label"), "degree"
        ),
        "labels",
    )

    def looked_up(rows: DataFrame, key: str, weight: str) -> DataFrame:
        keyed = labels.select(F.col("node").alias(key), F.col("label").alias("found"), F.col("degree").alias("_weight"))
        return lookup_join(rows, keyed, key, weight=weight, broadcast_rows=BROADCAST_ROWS)

    while True:
        near = looked_up(both, "from", "_weight").groupBy(F.col("to").alias("node")).agg(F.min("found").alias("least"))
        lower = near.join(labels, "node").select(
            "node", F.least("label", "least").alias("label"), "degree", F.col("label").alias("before")
        )
        jumped = looked_up(lower.withColumnRenamed("label", "middle"), "middle", "_weight")
        jumped = jumped.select(
            "node", F.least("middle", "found").alias("label"), "degree", (F.least("middle", "found") < F.col("before")).alias("moved")
        )
        labels = staged(jumped, "labels")
        if labels.where("moved").isEmpty():
            return labels.select("node", "label")
