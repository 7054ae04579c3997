"""Model operators on Spark MLlib: assemble, weighted gradient-boosted
trees, best-iteration selection, scoring, importance, random-forest pseudo
labels, random-search tuning, parameter variants and re-scoring from a
saved model.

Training, scoring and evaluation are distributed MLlib / DataFrame jobs;
the driver only holds parameter maps and the (small) fitted model.
"""

from __future__ import annotations

import random

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.functions.policy import hard_label, overwrite_unlabelled
from clickforge.models import trees
from clickforge.models.auc import auc

# Defaults of the trainer wrapper; a params map overrides them (M-DEF).
DEFAULT_PARAMS = {
    "learning_rate": 0.1, "num_boost_round": 20, "max_depth": 5, "min_child_samples": 20,
    "max_bin": 32, "subsample": 1.0, "colsample_bytree": 1.0, "scale_pos_weight": 1.0, "seed": 0,
}

WEIGHT = "__w"


def merge_params(params: dict | None) -> dict:
    """Defaults overridden by ``params``; raises on keys MLlib has no equivalent for."""
    unsupported = sorted(set(params or {}) - set(DEFAULT_PARAMS))
    if unsupported:
        raise ValueError(f"unsupported parameters: {', '.join(unsupported)}")
    out = dict(DEFAULT_PARAMS)
    out.update(params or {})
    return out


def _subset_strategy(colsample: float) -> str:
    # MLlib samples features per node, not per tree; a fraction is accepted.
    return "all" if colsample >= 1.0 else str(max(min(colsample, 1.0), 1e-3))


def gbt_estimator(params: dict, label: str = "label") -> GBTClassifier:
    """Map the reference's parameter names onto GBTClassifier (M-GBT)."""
    p = merge_params(params)
    return GBTClassifier(
        featuresCol="features", labelCol=label, weightCol=WEIGHT,
        stepSize=float(p["learning_rate"]), maxIter=int(p["num_boost_round"]), maxDepth=int(p["max_depth"]),
        minInstancesPerNode=int(p["min_child_samples"]), maxBins=int(p["max_bin"]),
        subsamplingRate=float(p["subsample"]), featureSubsetStrategy=_subset_strategy(float(p["colsample_bytree"])),
        seed=int(p["seed"]))


def with_weight(df: DataFrame, label: str, scale_pos_weight: float) -> DataFrame:
    """M-WEIGHT: positives weighted by ``scale_pos_weight``."""
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0)))


def assembler(predictors) -> VectorAssembler:
    """M-ASM over what ``numeric`` gives."""
    return VectorAssembler(inputCols=list(predictors), outputCol="features", handleInvalid="keep")


#: What a missing value of a numeric predictor is to the trees: less than all
#: others, so that a split can part it from them.
MISSING = -1e18


def numeric(df: DataFrame, predictors) -> DataFrame:
    """Predictors as doubles without missing values; those that are nominal
    (``categories.with_codes``) keep what their column says of them."""
    nominal = {f.name for f in df.schema if "ml_attr" in f.metadata}
    value = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(MISSING)), F.lit(MISSING)).alias(c)
    return df.select(*[value(c) if c in predictors and c not in nominal else F.col(c) for c in df.columns])


#: Partitions of a fit's rows, for each core.  Every level of every tree sends the
#: statistics of all nodes (up to 100 MB at ten levels) from each partition.
FIT_TASKS = 4


def fit_rows(train: DataFrame) -> DataFrame:
    """The rows of a fit in few partitions: what a level shuffles then does not
    grow with the rows."""
    return train.coalesce(FIT_TASKS * train.sparkSession.sparkContext.defaultParallelism)


def fit(train: DataFrame, predictors, label: str = "label", params: dict | None = None) -> PipelineModel:
    """Assemble + weighted GBT in one Pipeline."""
    p = merge_params(params)
    data = with_weight(numeric(train, predictors), label, p["scale_pos_weight"]).withColumn(
        label, F.col(label).cast("double"))
    return Pipeline(stages=[assembler(predictors), gbt_estimator(p, label)]).fit(fit_rows(data))


def with_trees(model: PipelineModel, which: list[int], weights: list[float] | None = None) -> PipelineModel:
    """The model made of some of its trees (weights: theirs)."""
    gbt = model.stages[-1]
    trees_, own = gbt._java_obj.trees(), gbt.treeWeights
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    kept = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(which))
    shares = gateway.new_array(gateway.jvm.double, len(which))
    for i, t in enumerate(which):
        kept[i], shares[i] = trees_[t], float(own[t] if weights is None else weights[i])
    java = ml.classification.GBTClassificationModel(gbt.uid, kept, shares, gbt.numFeatures, gbt.numClasses)
    return PipelineModel([*model.stages[:-1], GBTClassificationModel(java)])


def first_trees(model: PipelineModel, n_trees: int) -> PipelineModel:
    """The model as it was after ``n_trees`` boosting rounds."""
    return with_trees(model, list(range(max(1, min(int(n_trees), model.stages[-1].getNumTrees)))))


def score(model: PipelineModel, df: DataFrame, predictors, prob: str = "p", n_trees: int | None = None) -> DataFrame:
    """M-SCORE / M-HARD: probability of class 1 and the hard prediction, by
    the first ``n_trees`` rounds (the best iteration) or all of them."""
    out = (model if n_trees is None else first_trees(model, n_trees)).transform(numeric(df, predictors))
    return out.withColumn(prob, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability")


def of_matrix(model: GBTClassificationModel) -> PipelineModel:
    """A model fitted on an assembled matrix, as the functions here take it."""
    return PipelineModel([model])


def score_matrix(model: PipelineModel, matrix: DataFrame, prob: str = "p", keep=("click_id",)) -> DataFrame:
    """Probability of class 1 for the rows of an assembled matrix."""
    return model.stages[-1].transform(matrix).select(*keep, vector_to_array("probability")[1].alias(prob))


def best_iteration(model: PipelineModel, valid: DataFrame, predictors, label: str = "label",
                   patience: int = 60) -> int:
    """M-STOP: 1-based iteration with the lowest validation log-loss, with
    patience (stop scanning after ``patience`` rounds without improvement).
    ``evaluateEachIteration`` is one distributed pass over ``valid``."""
    gbt = model.stages[-1]
    data = model.stages[0].transform(numeric(valid, predictors)).withColumn(
        label, F.col(label).cast("double")).withColumn(WEIGHT, F.lit(1.0))
    losses = gbt.evaluateEachIteration(data)
    best, best_i, since = float("inf"), 0, 0
    for i, loss in enumerate(losses):
        if loss < best:
            best, best_i, since = loss, i, 0
        else:
            since += 1
            if since >= patience:
                break
    return best_i + 1


def prefix_auc(model: PipelineModel, valid: DataFrame, predictors, label: str = "label",
               patience: int | None = None, block_trees: int = 50) -> DataFrame:
    """Validation AUC of every tree prefix, up to the early stop if ``patience``
    is given: ``(iteration, auc)`` (see ``trees.staged_auc``)."""
    matrix = model.stages[0].transform(numeric(valid, predictors))
    got = trees.staged_auc(model, matrix, label, patience, block_trees)
    return valid.sparkSession.createDataFrame(got, "iteration long, auc double")


def best_iteration_auc(model: PipelineModel, valid: DataFrame, predictors, label: str = "label",
                       patience: int = 60, block_trees: int = 50) -> int:
    """M-STOP as the reference does it: the iteration with the best
    validation AUC, scanning with ``patience`` rounds without improvement."""
    matrix = model.stages[0].transform(numeric(valid, predictors))
    got = trees.staged_auc(model, matrix, label, patience, block_trees)
    return max(got, key=lambda x: (x[1] if x[1] is not None else -1.0, -x[0]))[0]


def importance(spark: SparkSession, model: PipelineModel, predictors) -> DataFrame:
    """M-IMP: gain share (of 100) and split count per feature, from the saved node table."""
    return trees.importance(model, predictors)


def save(model: PipelineModel, path: str) -> None:
    """S-MODEL."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def rf_pseudo_labels(train: DataFrame, unlabelled_flag, predictors, label: str = "label",
                     num_trees: int = 20, max_depth: int = 5, scale_pos_weight: float = 1.0,
                     subsample: float = 1.0, seed: int = 0, df: DataFrame | None = None) -> DataFrame:
    """M-RF: forest fitted on ``train``; on rows where ``unlabelled_flag``
    holds, the label is replaced by the forest's hard label (P-THRESH +
    P-OVER).  Returns ``df`` (default ``train``'s source) with the new label."""
    data = with_weight(numeric(train, predictors), label, scale_pos_weight).withColumn(
        label, F.col(label).cast("double"))
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=WEIGHT, numTrees=num_trees,
                                maxDepth=max_depth, subsamplingRate=subsample, seed=seed)
    model = Pipeline(stages=[assembler(predictors), rf]).fit(fit_rows(data))
    target = df if df is not None else train
    scored = model.transform(numeric(target, predictors)).withColumn("__p", vector_to_array("probability")[1])
    out = scored.withColumn(label, overwrite_unlabelled(F.col(label), unlabelled_flag, hard_label(F.col("__p"))))
    return out.drop("features", "rawPrediction", "probability", "prediction", "__p")


# ---------------------------------------------------------------------------
# M-TUNE / M-BEST / M-VARIANT
# ---------------------------------------------------------------------------
SEARCH_SPACE = {
    "max_depth": (3, 10), "min_child_samples": (20, 200), "scale_pos_weight": (250.0, 400.0),
    "subsample": (0.2, 0.7), "colsample_bytree": (0.2, 0.7), "max_bin": (50, 255),
}


def sample_params(n_trials: int, seed: int = 0, space: dict | None = None, base: dict | None = None) -> list[dict]:
    rnd = random.Random(seed)
    out = []
    for _ in range(n_trials):
        p = dict(base or {})
        for k, (lo, hi) in (space or SEARCH_SPACE).items():
            p[k] = rnd.randint(lo, hi) if isinstance(lo, int) else round(rnd.uniform(lo, hi), 4)
        out.append(p)
    return out


def evaluate_params(spark: SparkSession, train: DataFrame, valid: DataFrame, predictors, param_sets,
                    label: str = "label", tag: str = "trial") -> DataFrame:
    """Fit each parameter set (a distributed fit each) and score the
    validation split with the exact AUC.  Returns ``(tag, params, auc)``."""
    frames = []
    for i, p in enumerate(param_sets):
        m = fit(train, predictors, label, p)
        a = auc(score(m, valid, predictors), "p", label)
        params_json = ", ".join(f"{k}={p[k]}" for k in sorted(p))
        frames.append(a.select(F.lit(i).alias(tag), F.lit(params_json).alias("params"), "auc"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
