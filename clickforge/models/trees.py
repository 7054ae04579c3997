"""Fitted boosted trees as a table, and what is read off it: importance
(M-IMP) and the validation AUC of every prefix with early stopping (M-STOP).

The node table is the model's own saved form: one row per node, a few MB for
the largest models of the reference.  Rows of data never pass the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickforge.models.auc import auc_of_blocks
from clickforge.session import shared_path

# The scan below runs in Python workers that may lack this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def node_table(model: PipelineModel, spark: SparkSession | None = None) -> DataFrame:
    """One row per node: tree, node, feature, threshold (null at a categorical
    split), categories that go left (null at a threshold), arity, left and right
    child (-1 in leaves), prediction, gain, weight (weighted training rows)."""
    spark = spark or SparkSession.getActiveSession()
    path = shared_path(spark, "trees")
    model.stages[-1].write().save(path)
    n, split = F.col("nodeData"), F.col("nodeData.split")
    categorical = split.getField("numCategories") >= 0
    where = split.getField("leftCategoriesOrThreshold")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n.getField("id").alias("node"), split.getField("featureIndex").alias("feature"),
        F.when(~categorical, F.get(where, F.lit(0))).alias("threshold"), F.when(categorical, where).alias("categories"),
        split.getField("numCategories").alias("arity"), n.getField("leftChild").alias("left"), n.getField("rightChild").alias("right"),
        n.getField("prediction").alias("prediction"), n.getField("gain").alias("gain"), F.get(n.getField("impurityStats"), F.lit(0)).alias("weight"))


def importance(model: PipelineModel, predictors) -> DataFrame:
    """M-IMP: (feature, gain, split).  Gain is the loss reduction of the
    feature's splits, each weighted by its training rows, in per cent of all
    features'; split is the number of its splits."""
    inner = node_table(model).filter(F.col("left") >= 0)
    per = inner.groupBy("feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"), F.count(F.lit(1)).alias("split"))
    names = inner.sparkSession.createDataFrame(list(enumerate(predictors)), "feature int, name string")
    # one row per predictor
    whole = F.sum("g").over(Window.partitionBy(F.lit(0)))
    out = F.broadcast(names).join(per, "feature", "left").fillna(0, ["g", "split"])
    return out.select(F.col("name").alias("feature"), F.coalesce(F.try_divide(100 * F.col("g"), whole), F.lit(0.0)).alias("gain"),
                      F.col("split").cast("int").alias("split")).orderBy(F.desc("gain"), "feature")


class PackedTrees:
    """Trees as arrays."""

    def __init__(self, nodes: list, weights: list[float]):
        self.weights, self.trees = list(weights), []
        by_tree: dict[int, list] = {}
        for r in nodes:
            by_tree.setdefault(r["tree"], []).append(r)
        for i in range(len(self.weights)):
            rows = sorted(by_tree[i], key=lambda r: r["node"])
            sets = [(r["node"], r["categories"]) for r in rows if r["categories"] is not None and r["left"] >= 0]
            goes = np.zeros((len(sets) + 1, max([r["arity"] for r in rows] + [1]) + 1), bool)
            which = np.zeros(len(rows), np.int64)
            for k, (node, cats) in enumerate(sets, 1):
                which[node] = k
                goes[k, np.array(cats, int)] = True
            col = lambda c, kind, empty: np.array([empty if r[c] is None else r[c] for r in rows], kind)
            self.trees.append((col("feature", np.int64, 0), col("threshold", float, np.nan), col("left", np.int64, -1), col("right", np.int64, -1),
                               col("prediction", float, 0.0), which, goes))


def running_sums(weights: list[float], arrays: list[tuple], x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Weighted sums after each tree, from ``start``: rows by trees.  All rows of
    ``x`` go down one level at a time."""
    out, at = np.empty((len(x), len(arrays))), np.arange(len(x))
    for t, (feature, threshold, left, right, prediction, which, goes) in enumerate(arrays):
        node = np.zeros(len(x), np.int64)
        while (inner := left[node] >= 0).any():
            v = x[at, np.maximum(feature[node], 0)]
            # a missing value is not under any threshold, nor in any set
            go = v <= threshold[node]
            cat = which[node]
            if cat.any():
                code = np.where(np.isfinite(v) & (v >= 0) & (v < goes.shape[1]), v, goes.shape[1] - 1).astype(np.int64)
                go = np.where(cat > 0, goes[cat, code], go)
            node = np.where(inner, np.where(go, left[node], right[node]), node)
        start = start + weights[t] * prediction[node]
        out[:, t] = start
    return out


def packed_trees(model: PipelineModel, spark: SparkSession | None = None) -> PackedTrees:
    """The model's nodes as arrays (as large as the model, which is on the driver
    anyway).  A thread without an active session gives its own."""
    return PackedTrees(node_table(model, spark).collect(), list(model.stages[-1].treeWeights))


def packed_rows(matrix: DataFrame, label: str = "label") -> DataFrame:
    """Labelled rows of an assembled matrix as written blocks: number of rows,
    labels as bytes, features as doubles, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y = np.asarray(b.column(0)).astype(np.int8)
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([y.tobytes()]),
                                                  pa.array([np.asarray(b.column(1).flatten()).tobytes()], pa.binary())], ["n", "y", "x"])

    rows = matrix.select((F.col(label) == 1).cast("int").alias("y"), vector_to_array("features").alias("x")).filter("y IS NOT NULL")
    path = shared_path(matrix.sparkSession, "rows")
    rows.mapInArrow(run, "n long, y binary, x binary").write.parquet(path)
    return matrix.sparkSession.read.schema("n long, y binary, x binary").parquet(path)


def scored_blocks(blocks: DataFrame, models: list[tuple[list[float], list[tuple]]], staged: bool = False) -> DataFrame:
    """Written blocks with their scores: the sums of each of ``models`` (weights
    and trees), or with ``staged`` those after each tree of the only one, carried
    on from the last score of the blocks, if they have any."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(models)
    carried = "scores" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n, x = b.column("n")[i].as_py(), np.frombuffer(b.column("x")[i].as_buffer(), np.float64)
                x = x.reshape(n, -1)
                start = np.frombuffer(b.column("scores")[i].as_buffer(), np.float64)[-n:] if carried else np.zeros(n)
                sums = [running_sums(*m, x, start) for m in sent.value]
                out = sums[0].T if staged else np.stack([m[:, -1] for m in sums])
                row = b.slice(i, 1)
                yield pa.RecordBatch.from_arrays([row.column("n"), row.column("y"), row.column("x"), pa.array([out.tobytes()], pa.binary())],
                                                 ["n", "y", "x", "scores"])

    path = shared_path(spark, "margins")
    scored = blocks.mapInArrow(run, "n long, y binary, x binary, scores binary")
    (scored if staged else scored.drop("x")).write.parquet(path)
    sent.unpersist()
    return spark.read.schema(scored.schema if staged else scored.drop("x").schema).parquet(path)


def aucs_of(models: list[PackedTrees], blocks: DataFrame) -> list[float | None]:
    """Exact AUC of every model's sums over ``packed_rows``, all in one pass."""
    scored = scored_blocks(blocks, [(m.weights, m.trees) for m in models])
    return auc_of_blocks(scored.select("n", "y", "scores"), len(models))


def staged_auc(model: PipelineModel, matrix: DataFrame, label: str = "label", patience: int | None = None,
               block_trees: int = 50, rows: DataFrame | None = None) -> list[tuple[int, float | None]]:
    """(iteration, AUC) of the prefixes of the model on ``matrix`` (features,
    label), in order, until the best is ``patience`` iterations old (None: all).
    ``rows``: the matrix by ``packed_rows``, where it is there already.

    Trees are evaluated in blocks: one pass over the rows per block carries each
    row's running sum on from the block before and writes the block's sums;
    blocks behind the stop are never evaluated.  AUC only needs ranks, so the
    sums stand for probabilities."""
    trees = packed_trees(model)
    rows = packed_rows(matrix, label) if rows is None else rows
    out: list[tuple[int, float | None]] = []
    best, best_at = -1.0, 0
    for first in range(0, len(trees.trees), block_trees):
        last = first + block_trees
        rows = scored_blocks(rows, [(trees.weights[first:last], trees.trees[first:last])], staged=True)
        got = auc_of_blocks(rows.select("n", "y", "scores"), len(trees.trees[first:last]))
        for it, auc in enumerate(got, first + 1):
            out.append((it, auc))
            if (auc if auc is not None else -1.0) > best:
                best, best_at = auc, it
            elif patience is not None and it - best_at >= patience:
                return out
    return out
