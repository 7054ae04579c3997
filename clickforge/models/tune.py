"""M-TUNE by successive halving: all trials start on a small slice of the rows
with few rounds; the best third goes on with three times the rows.  The matrix
is assembled and written once, fits of one rung run at the same time, and the
trial table is typed (M-BEST takes its parameters from there)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.models import gbt as G
from clickforge.models import trees
from clickforge.session import shared_path

#: Slices of a rung: rows whose index leaves less than this, modulo SLICES.
SLICES = 9
RUNGS = ((1, 2), (3, 4), (9, 8))  # (slices, boosting rounds)
#: Rows for each core that fits running at the same time may hold in memory; larger
#: fits run one by one, as each has work for all cores.
ROWS_AT_ONCE = 1 << 20
PARAMS = {"max_depth": "int", "min_child_samples": "int", "scale_pos_weight": "double", "subsample": "double",
          "colsample_bytree": "double", "max_bin": "int", "learning_rate": "double", "seed": "int"}
TRIALS = "trial int, rung int, slices int, num_boost_round int, rows long, auc double, survives boolean, " + ", ".join(f"{k} {v}" for k, v in PARAMS.items())


def written_matrix(df: DataFrame, predictors, label: str, order: str, keep=()) -> DataFrame:
    """(order, label, features, columns of ``keep``), assembled once and written:
    every fit reads it."""
    spark = df.sparkSession
    path = shared_path(spark, "matrix")
    data = G.assembler(predictors).transform(G.numeric(df, predictors))
    data = data.select(order, F.col(label).cast("double").alias(label), "features", *keep)
    data.write.parquet(path)
    # the schema holds which features are categorical
    return spark.read.schema(data.schema).parquet(path)


def successive_halving(spark: SparkSession, train: DataFrame, valid: DataFrame, trials: list[dict], *, label: str = "label",
                       order: str = "row_id", rungs=RUNGS, keep: int = 3, parallel: int = 8, blocks: DataFrame | None = None) -> DataFrame:
    """The trial table: a row per trial and rung it took part in.

    ``train`` and ``valid`` are written matrices (``blocks``: ``valid`` by
    ``trees.packed_rows``, where it is there already).  Of the trials of a rung the
    best 1/``keep`` by exact validation AUC (ties: the earlier trial) survive,
    one at least; the last rung has no survivors."""
    base = {k: G.DEFAULT_PARAMS[k] for k in PARAMS}
    trials = [dict(base, **t) for t in trials]
    blocks = trees.packed_rows(valid, label) if blocks is None else blocks
    alive, out = list(range(len(trials))), []
    for rung, (slices, rounds) in enumerate(rungs):
        part = train if slices >= SLICES else train.filter(F.pmod(F.col(order), F.lit(SLICES)) < slices)
        # a fit reads its rows four times; they stay in the partitions they are read in
        rows = G.fit_rows(part).select(label, "features").persist(StorageLevel.DISK_ONLY)
        n = rows.count()
        at_once = max(1, min(parallel, ROWS_AT_ONCE * spark.sparkContext.defaultParallelism // max(n, 1)))

        @inheritable_thread_target(spark)
        def fit_one(i: int, rows=rows, rounds=rounds) -> trees.PackedTrees:
            p = G.merge_params(dict(trials[i], num_boost_round=rounds))
            model = G.gbt_estimator(p, label).fit(G.with_weight(rows, label, p["scale_pos_weight"]))
            return trees.packed_trees(G.of_matrix(model), spark)

        with ThreadPoolExecutor(at_once) as pool:
            fitted = list(pool.map(fit_one, alive))
        rows.unpersist()
        aucs = trees.aucs_of(fitted, blocks)
        ranked = sorted(zip(alive, aucs), key=lambda x: (-(x[1] if x[1] is not None else -1.0), x[0]))
        left = [] if rung == len(rungs) - 1 else sorted(i for i, _ in ranked[:max(1, len(alive) // keep)])
        for i, a in zip(alive, aucs):
            out.append((i, rung, slices, rounds, n, a, i in left, *(_typed(trials[i][k], t) for k, t in PARAMS.items())))
        alive = left
    return spark.createDataFrame(out, TRIALS)


def _typed(value, kind: str):
    return int(value) if kind == "int" else float(value)


def best_trial(table: DataFrame) -> DataFrame:
    """M-BEST: the best trial of the last rung, one typed row."""
    return table.orderBy(F.desc("rung"), F.desc_nulls_last("auc"), "trial").limit(1)


def params_of(best: DataFrame, **more) -> dict:
    """Parameters of the best trial as the trainer takes them."""
    row = best.first()
    return {**{k: row[k] for k in PARAMS}, **more}
