"""Category codes, trees as a table, early stopping in blocks, successive halving."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickforge import schema as S
from clickforge.models import auc as AUC
from clickforge.models import categories as K
from clickforge.models import gbt as M
from clickforge.models import trees as TR
from clickforge.models import tune as TU

PREDS = ["c", "x"]


def data(spark, n=1200, values=60, seed=1):
    rnd = random.Random(seed)
    rate = {v: rnd.random() for v in range(values)}
    rows = []
    for i in range(n):
        v = min(int(rnd.expovariate(0.08)), values - 1)
        x = rnd.random()
        rows.append((i, None if i % 50 == 0 else v * 7 + 3, x if i % 31 else float("nan"), int(rate[v] * 0.7 + x * 0.3 + rnd.gauss(0, .1) > .55)))
    return spark.createDataFrame(rows, "row_id long, c int, x double, label int").cache()


@pytest.fixture(scope="module")
def fitted(spark):
    df = data(spark)
    codes = [K.fit_codes(df, "c", "label", max_bins=16, rare_codes=4)]
    coded = K.with_codes(df, codes).cache()
    model = M.fit(coded, PREDS, "label", {"num_boost_round": 6, "max_depth": 4, "min_child_samples": 2})
    return df, codes, coded, model


def test_codes_of_common_rare_missing_and_unseen_values(spark, fitted, monkeypatch):
    df, (codes,), coded, _ = fitted
    assert codes.n_codes == 16 and codes.common.count() == 11
    counts = {r["c"]: r["n"] for r in df.where("c is not null").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    top = sorted(counts, key=lambda v: (-counts[v], v))[:11]
    new = spark.createDataFrame([(i, v) for i, v in enumerate([*counts, None, 10**6])], "row_id long, c int")
    got = {r["v"]: int(r["c"]) for r in K.with_codes(new.withColumn("v", F.col("c")), [codes]).collect()}
    assert [got[v] for v in top] == list(range(11)) and got[None] == got[10**6] == codes.other == 15
    rare = [v for v in counts if v not in top]
    rates = {r["c"]: r["r"] for r in df.where("c is not null").groupBy("c").agg(F.avg("label").alias("r")).collect()}
    assert {got[v] for v in rare} <= set(range(11, 15)) and len({got[v] for v in rare}) > 1
    # the order of the target rate is the order of codes
    assert all(got[a] <= got[b] for a in rare for b in rare if rates[a] < rates[b])
    # more rare values than may be broadcast: the salted join gives the same
    monkeypatch.setattr(S, "MAX_BROADCAST_ROWS", 0)
    again = K.with_codes(new.withColumn("v", F.col("c")), [codes])
    assert {r["v"]: int(r["c"]) for r in again.collect()} == got
    assert coded.count() == df.count() and coded.columns == df.columns


def test_few_values_keep_their_own_codes(spark):
    df = spark.createDataFrame([(1, 5, 0), (2, 9, 1), (3, None, 1), (4, 5, 0)], "row_id long, c int, label int")
    codes = K.fit_codes(df, "c", "label", max_bins=8, rare_codes=2)
    assert codes.n_codes == 3 and codes.rare is None
    assert [r["c"] for r in K.with_codes(df, [codes]).orderBy("row_id").collect()] == [0.0, 1.0, 2.0, 0.0]
    none = K.fit_codes(df.limit(0), "c", "label", max_bins=8, rare_codes=2)
    assert [r["c"] for r in K.with_codes(df, [none]).collect()] == [0.0] * 4


def test_saved_nodes_hold_categorical_splits(fitted):
    _, _, _, model = fitted
    nodes = TR.node_table(model)
    inner = nodes.where("left >= 0")
    assert inner.where("categories is not null and feature = 0").count() > 0
    assert inner.where("categories is null and threshold is null").count() == 0
    own = model.stages[-1].featureImportances.toArray()
    got = {r["feature"]: r for r in TR.importance(model, PREDS).collect()}
    assert all(abs(got[p]["gain"] - 100 * g) < 1e-9 for p, g in zip(PREDS, own))
    assert sum(r["split"] for r in got.values()) == inner.count()


def test_running_sums_equal_the_model(spark, fitted):
    _, _, coded, model = fitted
    matrix = model.stages[0].transform(M.numeric(coded, PREDS))
    got = dict(TR.staged_auc(model, matrix, "label", block_trees=4))
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    for k in (1, 4, 5, 6):
        want = AUC.auc(M.score(model, coded, PREDS, n_trees=k), "p", "label").first()["auc"]
        assert abs(got[k] - want) < 1e-12


def test_three_hundred_trees_stop_early(spark, fitted):
    _, _, coded, model = fitted
    many = M.with_trees(model, [i % 6 for i in range(300)], [0.1] * 300)
    matrix = model.stages[0].transform(M.numeric(coded, PREDS))
    some = TR.staged_auc(many, matrix, "label", patience=20, block_trees=30)
    assert len(some) < 300  # blocks behind the stop are not evaluated
    best = max(some, key=lambda x: (x[1], -x[0]))
    assert some[-1][0] - best[0] == 20
    every = TR.staged_auc(many, matrix, "label", block_trees=150)
    assert len(every) == 300 and all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-12 for a, b in zip(every, some))
    assert M.best_iteration_auc(many, coded, PREDS, "label", patience=20, block_trees=30) == best[0]


def test_successive_halving(spark, fitted):
    _, _, coded, _ = fitted
    matrix = TU.written_matrix(coded, PREDS, "label", "row_id")
    trials = M.sample_params(7, seed=3, space={"max_depth": (2, 4), "min_child_samples": (1, 5)})
    table = TU.successive_halving(spark, matrix, matrix, trials, rungs=((1, 1), (3, 1), (9, 2)))
    rows = table.collect()
    n = {k: [r for r in rows if r["rung"] == k] for k in range(3)}
    assert [len(n[k]) for k in range(3)] == [7, 2, 1]
    assert [{r["rows"] for r in n[k]} for k in range(3)] == [{coded.where(f"row_id % 9 < {s}").count()} for s in (1, 3, 9)]
    for k in range(3):
        left = {r["trial"] for r in n[k] if r["survives"]}
        assert left == ({r["trial"] for r in n[k + 1]} if k < 2 else set())
        assert min([r["auc"] for r in n[k] if r["survives"]], default=1) >= max([r["auc"] for r in n[k] if not r["survives"]], default=0) or k == 2
    best = TU.best_trial(table)
    params = TU.params_of(best, num_boost_round=2)
    assert params["max_depth"] == trials[best.first()["trial"]]["max_depth"] and M.merge_params(params)


def test_auc_of_blocks_is_exact_over_ranges_ties_and_one_class(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(int(rnd.random() < .3), [rnd.random(), float(rnd.randrange(4)), 1.0, -i * 1.0]) for i in range(700)]

    def block(some):
        return (len(some), bytes(y for y, _ in some), np.array([s for _, s in some]).T.tobytes())

    def brute(k, ys):
        pos, neg = ([s[k] for (_, s), y in zip(rows, ys) if y == c] for c in (1, 0))
        return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))

    frame = lambda some: spark.createDataFrame([block(some[a:a + 90]) for a in range(0, len(some), 90)], AUC.BLOCK_SCHEMA).repartition(3)
    want = [brute(k, [y for y, _ in rows]) for k in range(4)]
    for most, ranges in ((1 << 20, 2048), (64, 2048), (64, 0)):  # one range; many; row by row
        monkeypatch.setattr(AUC, "SORT_ROWS", most)
        monkeypatch.setattr(AUC, "MAX_RANGES", ranges)
        got = AUC.auc_of_blocks(frame(rows), 4)
        assert all(abs(a - b) < 1e-12 for a, b in zip(got, want))
        assert AUC.auc_of_blocks(frame([(1, s) for _, s in rows]), 4) == [None] * 4
        assert AUC.auc_of_blocks(frame(rows).limit(0), 2) == [None] * 2


def test_a_rung_scores_the_validation_rows_once_and_large_fits_run_alone(spark, fitted, monkeypatch):
    _, _, coded, _ = fitted
    matrix = TU.written_matrix(coded, PREDS, "label", "row_id")
    passes, workers = [], []
    scored, pool = TR.scored_blocks, TU.ThreadPoolExecutor
    monkeypatch.setattr(TR, "scored_blocks", lambda blocks, models, **k: (passes.append(len(models)), scored(blocks, models, **k))[1])
    monkeypatch.setattr(TU, "ThreadPoolExecutor", lambda n: (workers.append(n), pool(n))[1])
    monkeypatch.setattr(TU, "ROWS_AT_ONCE", 100)
    trials = M.sample_params(3, seed=3, space={"max_depth": (2, 4), "min_child_samples": (1, 5), "subsample": (0.4, 0.8)})
    table = TU.successive_halving(spark, matrix, matrix, trials, rungs=((1, 2), (9, 3)))
    assert passes == [3, 1]
    # 134 rows in the first rung, then 1,200; 400 at once in four cores
    assert workers == [2, 1]
    # the AUC is that of MLlib's own scores of the same fit
    for r in table.collect():
        rows = matrix if r["slices"] == 9 else matrix.where("row_id % 9 < 1")
        p = M.merge_params(dict(trials[r["trial"]], num_boost_round=r["num_boost_round"]))
        model = M.gbt_estimator(p, "label").fit(M.with_weight(M.fit_rows(rows), "label", p["scale_pos_weight"]))
        own = M.score_matrix(M.of_matrix(model), matrix, keep=["label"])
        assert abs(AUC.auc(own, "p", "label").first()["auc"] - r["auc"]) < 1e-12
