"""Exact, tie-aware ROC AUC as a distributed job.

AUC = sum over positives of (negatives ranked below + half the tied
negatives) / (P * N).  The job:

1. aggregates rows to one row per distinct score (pos, neg) with partial
   aggregation, so a score shared by a third of the rows is one row;
2. range-partitions the distinct scores and sorts inside each partition;
3. a per-partition scan (``mapInPandas``) emits one summary row per
   partition: its lowest score, its positives, negatives and its local
   numerator (negatives below *within* the partition);
4. the summaries (one row per partition, a proven bound) get the
   negatives of all lower partitions by a window and are summed.

Nothing larger than one partition is ever in one task or on the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The per-partition scan below runs in Python workers.  Pickle this module's
# functions by value so executors need only pandas / numpy, not this package
# on their path (no zip to ship, nothing to install on the cluster).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMMARY_SCHEMA = "g long, lo double, pos double, neg double, local_num double"


def _partition_summary(batches):
    """One summary row per (partition, group); rows arrive sorted by
    (group, score), so a group is one contiguous run, possibly spanning
    batches."""
    cur = None                      # [g, lo, pos, neg, num]
    for pdf in batches:
        if pdf.empty:
            continue
        for g, seg in pdf.groupby("g", sort=False):
            neg = seg["neg"].to_numpy(dtype="float64")
            pos = seg["pos"].to_numpy(dtype="float64")
            if cur is not None and cur[0] != g:
                yield pd.DataFrame([cur], columns=["g", "lo", "pos", "neg", "local_num"])
                cur = None
            if cur is None:
                cur = [int(g), float(seg["score"].iloc[0]), 0.0, 0.0, 0.0]
            below = neg.cumsum() - neg + cur[3]
            cur[4] += float((pos * (below + 0.5 * neg)).sum())
            cur[2] += float(pos.sum())
            cur[3] += float(neg.sum())
    if cur is not None:
        yield pd.DataFrame([cur], columns=["g", "lo", "pos", "neg", "local_num"])


def auc_by(df: DataFrame, score: str, label: str, group: str | None = None,
           n_parts: int | None = None) -> DataFrame:
    """Exact AUC per value of ``group`` (a long column), or overall.

    Returns ``group, auc`` (or just ``auc``).  Distinct (group, score) rows
    are range-partitioned on (group, score), so neither a large group nor a
    frequent score lands in one task."""
    s = F.col(score).cast("double")
    y = F.col(label)
    gcol = F.col(group).cast("long") if group else F.lit(0).cast("long")
    per_score = (df.filter(y.isNotNull() & s.isNotNull())
                 .groupBy(gcol.alias("g"), s.alias("score"))
                 .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("double").alias("pos"),
                      F.sum(F.when(y == 1, 0).otherwise(1)).cast("double").alias("neg")))
    ranged = (per_score.repartitionByRange(n_parts, "g", "score") if n_parts else
              per_score.repartitionByRange("g", "score")).sortWithinPartitions("g", "score")
    out = _stitched(ranged.mapInPandas(_partition_summary, SUMMARY_SCHEMA), group or "g")
    return out if group else out.select("auc")


def _stitched(summ: DataFrame, group: str) -> DataFrame:
    """``group, auc`` from one summary row per (partition, group)."""
    # one row per (partition, group): negatives of the same group in lower partitions
    w = Window.partitionBy("g").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    parts = summ.select("g", "pos", "neg",
                        (F.col("local_num") + F.col("pos") * F.coalesce(F.sum("neg").over(w), F.lit(0.0))).alias("num"))
    tot = parts.groupBy("g").agg(F.sum("num").alias("num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return tot.select(F.col("g").alias(group), F.try_divide(F.col("num"), F.col("P") * F.col("N")).alias("auc"))


#: Rows whose scores a task sorts at once, and about as many as a range of a score holds.
SORT_ROWS = 1 << 20
#: Ranges whose limits are taken from a sample; with more, scores go row by row through ``auc_by``.
MAX_RANGES = 2048
#: Blocks and rows of each that the limits of the ranges are taken from.
SAMPLE_BLOCKS, SAMPLE_ROWS = 2048, 16

BLOCK_SCHEMA = "n long, y binary, scores binary"


def _scores(n: int, scores: bytes) -> np.ndarray:
    return np.frombuffer(scores, np.float64).reshape(-1, n)


def _counts(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores in order, with their positives and negatives."""
    values, at = np.unique(score, return_inverse=True)
    return values, np.bincount(at, pos, len(values)), np.bincount(at, neg, len(values))


def _limits(blocks: DataFrame, n_blocks: int, ranges: int) -> np.ndarray:
    """Upper limits of all ranges but the last, for each score.  They only deal
    the rows: no result depends on them."""
    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, scores in zip(b.column("n").to_pylist(), b.column("scores").to_pylist()):
                at = np.linspace(0, n - 1, min(n, SAMPLE_ROWS)).astype(int)
                yield pa.RecordBatch.from_pydict({"n": [len(at)], "scores": [_scores(n, scores)[:, at].tobytes()]})

    if n_blocks > SAMPLE_BLOCKS:
        blocks = blocks.sample(SAMPLE_BLOCKS / n_blocks, seed=0)
    # at most about SAMPLE_BLOCKS * SAMPLE_ROWS rows
    got = blocks.select("n", "scores").mapInArrow(some, "n long, scores binary").collect()
    if not got:
        return np.empty((0, ranges - 1))
    drawn = np.sort(np.concatenate([_scores(r["n"], r["scores"]) for r in got], axis=1), axis=1)
    return drawn[:, (np.arange(1, ranges) * drawn.shape[1]) // ranges]


def auc_of_blocks(blocks: DataFrame, n_scores: int) -> list[float | None]:
    """Exact AUC of each of ``n_scores`` scores of the same rows.

    ``blocks`` (``BLOCK_SCHEMA``) holds a row per block of rows: their labels as
    bytes (1: positive), and score by score their values as doubles.  A task
    sorts up to ``SORT_ROWS`` rows by each score and sends distinct values with
    their counts as one binary per range of the score, so neither rows nor values
    are dealt one by one; a task per range counts pairs inside it, and ranges are
    stitched as those of ``auc_by``."""
    size = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    ranges = max(1, -(-size["rows"] // SORT_ROWS))
    if ranges > MAX_RANGES:
        got = auc_by(_exploded(blocks), "score", "y", "g").collect()
    else:
        limits = _limits(blocks, size["blocks"], ranges) if ranges > 1 else np.empty((0, 0))
        dealt = blocks.mapInArrow(_dealt(limits, SORT_ROWS), "g long, part int, score binary, pos binary, neg binary")
        got = _stitched(dealt.groupBy("g", "part").applyInArrow(_range_summary, SUMMARY_SCHEMA), "g").collect()
    # one number per score
    aucs = {r["g"]: r["auc"] for r in got}
    return [aucs.get(i) for i in range(n_scores)]


def _exploded(blocks: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, y, scores in zip(*(b.column(c).to_pylist() for c in ("n", "y", "scores"))):
                for g, score in enumerate(_scores(n, scores)):
                    yield pa.RecordBatch.from_pydict({"g": np.full(n, g, np.int64), "y": np.frombuffer(y, np.int8).astype(np.int32), "score": score})

    return blocks.mapInArrow(rows, "g long, y int, score double")


def _dealt(limits: np.ndarray, most: int):
    def deal(held: list) -> Iterator[pa.RecordBatch]:
        y = np.concatenate([np.frombuffer(y, np.int8) for _, y, _ in held]) == 1
        for g, score in enumerate(np.concatenate([_scores(n, s) for n, _, s in held], axis=1)):
            values, pos, neg = _counts(score, y, ~y)
            cuts = np.searchsorted(values, limits[g], "right") if len(limits) else []
            edges = [0, *cuts, len(values)]
            out = [(g, k, *(x[a:b].tobytes() for x in (values, pos, neg))) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.binary()] * 3))],
                                             ["g", "part", "score", "pos", "neg"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        rows = 0
        for b in batches:
            for block in zip(*(b.column(c).to_pylist() for c in ("n", "y", "scores"))):
                if held and rows + block[0] > most:
                    yield from deal(held)
                    held, rows = [], 0
                held.append(block)
                rows += block[0]
        if held:
            yield from deal(held)

    return run


def _range_summary(table: pa.Table) -> pa.Table:
    score, pos, neg = (np.concatenate([np.frombuffer(x, np.float64) for x in table.column(c).to_pylist()]) for c in ("score", "pos", "neg"))
    _, pos, neg = _counts(score, pos, neg)
    below = neg.cumsum() - neg
    return pa.table({"g": table.column("g")[:1], "lo": pa.array([float(table.column("part")[0].as_py())]), "pos": [pos.sum()], "neg": [neg.sum()],
                     "local_num": [(pos * (below + 0.5 * neg)).sum()]})


def auc(df: DataFrame, score: str, label: str, n_parts: int | None = None) -> DataFrame:
    """One-row frame ``auc`` (null when a class is missing)."""
    out = auc_by(df, score, label, None, n_parts)
    # an input without both classes still yields one row
    return out.unionByName(df.sparkSession.range(1).select(F.lit(None).cast("double").alias("auc"))) \
              .agg(F.max("auc").alias("auc"))


def auc_evaluator(df: DataFrame, score: str, label: str) -> float:
    """Same number from MLlib's evaluator (exact with numBins=0)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName="areaUnderROC",
                                       numBins=0)
    return ev.evaluate(df.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label)))
