"""Exact AUC (vs brute force and MLlib), splits, model operators."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from clickforge.models import auc as AUC
from clickforge.operators import split as T


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("seed,n_parts", [(0, 1), (1, 3), (2, 7)])
def test_auc_exact_with_ties(spark, seed, n_parts):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 12)), int(rnd.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = AUC.auc(df, "s", "y", n_parts=n_parts).first()["auc"]
    assert abs(got - brute_auc(*zip(*rows))) < 1e-12
    assert abs(got - AUC.auc_evaluator(df, "s", "y")) < 1e-9


def test_auc_missing_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert AUC.auc(df, "s", "y").first()["auc"] is None


def test_split_partitions_table(spark):
    df = spark.range(100).withColumnRenamed("id", "row_id")
    out = T.assign_split(df, 80, 20).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in out} == {"train": 60, "val": 20, "test": 20}
    assert T.train_slice(df, 80, 50, 20).count() == 30


def test_day_filter_pushes_timestamp_range(spark):
    from clickforge.plans.queries import clicks
    from conftest import SF_SMALL
    df = T.day_filter(clicks(spark, SF_SMALL, ("hour",)), "2024-01-09 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(click_time" in pushed and "LessThan(click_time" in pushed


def test_gbt_fit_score_importance(spark):
    from clickforge.models import gbt as M
    rnd = random.Random(0)
    rows = [(float(a), float(b), int(a + rnd.random() > 1.2)) for a, b in
            ((rnd.random(), rnd.random()) for _ in range(400))]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    model = M.fit(df, ["a", "b"], "label", {"num_boost_round": 5, "max_depth": 2, "min_child_samples": 1})
    scored = M.score(model, df, ["a", "b"])
    auc = AUC.auc(scored, "p", "label").first()["auc"]
    assert auc > 0.8
    imp = {r.feature: r for r in M.importance(spark, model, ["a", "b"]).collect()}
    assert imp["a"].gain > imp["b"].gain and imp["a"].split >= 1
    assert abs(sum(r.gain for r in imp.values()) - 100.0) < 1e-6
    best = M.best_iteration(model, df, ["a", "b"], "label", patience=2)
    assert 1 <= best <= 5
    by_prefix = {r.iteration: r.auc for r in M.prefix_auc(model, df, ["a", "b"]).collect()}
    for k in (1, 3, 5):
        some = AUC.auc(M.score(model, df, ["a", "b"], n_trees=k), "p", "label").first()["auc"]
        assert abs(some - by_prefix[k]) < 1e-12
    with pytest.raises(ValueError, match="num_leaves"):
        M.fit(df, ["a", "b"], "label", {"num_leaves": 7})
