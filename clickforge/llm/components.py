"""Connected components of an undirected graph of long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b), label being the
    smallest id of its component.

    Labels spread along the edges and then follow their own labels (pointer
    jumping), until nothing changes; each state is written to the shared
    folder.  Stars of any size are safe: joins split on skew and minima are
    combined before the shuffle.
    """
    both = edges.select("a", "b").where("a <> b")
    both = keep_written(both.union(both.select("b", "a")).distinct(), "cc-edges")
    labels = keep_written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        heard = both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("n")).agg(F.min("label").alias("heard"))
        lower = labels.join(heard, F.col("node") == F.col("n")).select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("j"), F.col("label").alias("far"))
        new = keep_written(lower.join(jump, F.col("label") == F.col("j"), "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "cc-labels")
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
