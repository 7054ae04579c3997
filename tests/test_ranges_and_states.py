"""Row index on any frame, zones, lag in any order, mergeable group states."""

import math
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickforge import schema as S
from clickforge.functions import policy as P
from clickforge.functions import scalar as X
from clickforge.operators import ordered as W
from clickforge.operators import states
from clickforge.plans.features import build_features
from clickforge.plans.specs import FeatureSpec
from clickforge.session import shared_path
from clickforge.sources import clicks as C
from clickforge.sources import store as ST


def dense(df, n):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("a"), F.max("row_id").alias("b"), F.count_distinct("row_id").alias("d")).first()
    return (r["n"], r["a"], r["b"], r["d"]) == (n, 0, n - 1, n)


def test_row_index_is_dense_on_any_frame(spark):
    path = shared_path(spark, "plain")
    spark.range(5000).repartition(7).write.parquet(path)
    scan = spark.read.parquet(path)
    other = spark.range(10, 60).withColumnRenamed("id", "k")
    frames = {
        "scan": (scan, 5000), "filter": (scan.where("id % 3 = 0").select((F.col("id") * 2).alias("x")), 1667),
        "repartition": (scan.repartition(8), 5000), "coalesce": (scan.coalesce(2), 5000), "union": (scan.unionAll(scan), 10_000),
        "join": (scan.join(other, scan.id == other.k), 50), "sort": (scan.orderBy(F.desc("id")), 5000), "distinct": (scan.distinct(), 5000),
        "explode": (scan.select("id", F.explode(F.array(F.lit(1), F.lit(2)))), 10_000), "limit": (scan.limit(77), 77),
        "window": (scan.repartition(5, "id").sortWithinPartitions("id"), 5000), "empty": (scan.limit(0), 0)}
    for name, (df, n) in frames.items():
        out = C.assign_row_id(df)
        assert out.count() == n and (n == 0 or dense(out, n)), name
    # a sorted frame is numbered in its order
    assert C.assign_row_id(scan.orderBy(F.desc("id"))).where("row_id <> 4999 - id").count() == 0


def test_range_reads_open_only_the_files_of_the_range(spark):
    path = shared_path(spark, "zoned")
    df = spark.range(20_000).select(F.col("id").alias("row_id"), (F.col("id") % 7).cast("int").alias("app"))
    df.repartitionByRange(10, "row_id").write.parquet(path)
    C.write_zones(spark, path)
    part = C.read_rows(spark, path, 4_100, 6_050)
    assert sorted(r["row_id"] for r in part.select("row_id").collect()) == list(range(4_100, 6_050))
    assert len(part.inputFiles()) < 5 < len(spark.read.parquet(path).inputFiles())
    pushed = part._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(row_id,4100)" in pushed and "LessThan(row_id,6050)" in pushed
    assert C.read_rows(spark, path, 20_000, 30_000).count() == 0
    # the zones are no rows of the log
    assert spark.read.parquet(path).count() == 20_000


def test_ingest_checks_the_id_domains(spark):
    ok = spark.range(100).select(F.col("id").alias("row_id"), F.lit(5).alias("app"))
    assert C.ingest(ok, shared_path(spark, "ingest")).count() == 100
    for bad in (S.KEY_DOMAIN["app"], -1):
        with pytest.raises(ValueError, match="app has values"):
            C.ingest(ok.withColumn("app", F.when(F.col("row_id") == 7, bad).otherwise(F.col("app"))), shared_path(spark, "ingest"))


def test_global_lag_in_any_order(spark):
    rnd = random.Random(3)
    ids = rnd.sample(range(-10**12, 10**12), 3000)  # no dense index
    rows = [(i, rnd.choice(["a", "b", None]), rnd.random()) for i in ids]
    df = spark.createDataFrame(rows, "row_id long, s string, x double").repartition(9)
    got = {r["row_id"]: r["s_shift"] for r in W.global_lag(df, "s").collect()}
    ordered = sorted(rows)
    assert got == {b[0]: a[1] for a, b in zip([(None, None)] + ordered, ordered)}
    by_x = {r["row_id"]: r["before"] for r in W.global_lag(df, "row_id", "before", [F.desc("x")]).collect()}
    ordered = sorted(rows, key=lambda r: -r[2])
    assert by_x == {b[0]: a[0] for a, b in zip([(None,)] + ordered, ordered)}
    assert W.global_lag(df.limit(0), "s").count() == 0
    plan = W.global_lag(df, "s")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_states_of_ranges_merge_to_one_pass(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([1, 2, 3, None]), rnd.randrange(3), rnd.choice([None, 5.0, 1e9, 1e9 + 1, -3.25])) for i in range(400)]
    rows += [(400 + i, 9, 0, 0.1) for i in range(50)] + [(500, 8, 0, 2.0), (501, 8, 1, None)]
    df = spark.createDataFrame(rows, "row_id long, k int, j int, x double")
    specs = [FeatureSpec(op, ("k", "j"), "x", f"f_{op}", "double", "keep") for op in ("count", "countnn", "mean", "var", "skew", "nunique")]
    cuts = [0, 37, 38, 250, 425, 10**6]
    parts = [C.row_range(df, a, b) for a, b in zip(cuts, cuts[1:])]
    cols = states.moment_columns(specs)
    got = states.group_table([states.moments(p, ["k", "j"], cols) for p in parts],
                             {c: [states.distinct_values(p, ["k", "j"], c) for p in parts] for c in states.distinct_columns(specs)}, ["k", "j"], specs)
    pdf = pd.DataFrame(rows, columns=["row_id", "k", "j", "x"]).dropna(subset=["k"])
    seen = {(r["k"], r["j"]): r for r in got.collect()}
    groups = dict(list(pdf.groupby(["k", "j"])))
    assert set(seen) == {(int(a), int(b)) for a, b in groups}
    for key, g in groups.items():
        r, x = seen[key], g["x"].dropna()
        assert (r["f_count"], r["f_countnn"], r["f_nunique"]) == (len(g), len(x), x.nunique())
        for name, want in (("f_mean", x.mean()), ("f_var", x.var()), ("f_skew", 0.0 if x.nunique() == 1 and len(x) > 2 else x.skew())):
            assert (r[name] is None and pd.isna(want)) or math.isclose(r[name], want, rel_tol=1e-6, abs_tol=1e-9), (key, name)


def test_range_cache_adds_only_new_ranges_and_sees_changed_files(spark):
    root, day = shared_path(spark, "ranges"), [shared_path(spark, f"day{i}") for i in range(3)]
    frame = lambda a, b: spark.range(a, b).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("int").alias("ip"), (F.col("id") % 3).cast("int").alias("app"))
    for i in range(3):
        frame(100 * i, 100 * i + 100).write.parquet(day[i])
    specs = [FeatureSpec("count", ("ip",), None, "n"), FeatureSpec("nunique", ("ip",), "app", "u"), FeatureSpec("mean", ("ip",), "app", "m", "double", "keep")]
    local = root.removeprefix("file:")

    def build(k):
        parts = [spark.read.parquet(p) for p in day[:k]]
        whole = spark.read.parquet(*day[:k])
        out = build_features(whole, specs, cache_root=root, input_tag="log", cache_parts=parts)
        plain = build_features(whole, specs)
        assert out.exceptAll(plain).count() == plain.exceptAll(out).count() == 0
        return {d: os.stat(f"{local}/{d}/_SUCCESS").st_mtime_ns for d in os.listdir(local)}

    two = build(2)
    three = build(3)
    # what was there stays; the third day adds one table of moments and one of values
    assert {d: t for d, t in three.items() if d in two} == two and len(three) == len(two) + 2
    frame(100, 230).write.mode("overwrite").parquet(day[1])
    assert len(build(3)) == len(three) + 2  # the rewritten day only


def test_snapshot_statistics_and_manifest_come_from_the_written_table(spark):
    path = shared_path(spark, "snap")
    df = spark.range(50).select(F.col("id").alias("row_id"), (F.col("id") % 4).cast("int").alias("app"), (F.col("id") / 2).alias("x"), F.lit("train").alias("split"))
    marked = ST.with_roles(df, ["app"], other=["row_id", "split"])
    row = ST.write_snapshot_stats(marked, path, ["x", "app"]).first()
    assert (row["n_rows"], row["x_max"], row["x_min"], row["x_mean"], row["app_max"]) == (50, 24.5, 0.0, 12.25, 3)
    got = ST.snapshot_manifest(spark, path, shared_path(spark, "mani")).orderBy("ordinal").collect()
    assert [(r["name"], r["role"], r["dtype"], r["n_rows"]) for r in got] == [("app", "categorical", "int", 50), ("x", "numeric", "double", 50)]
    with pytest.raises(FileExistsError):
        ST.write_snapshot_stats(marked, path, ["x"])


def test_samples_nest_and_minutes_are_truncated_toward_zero(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    small, large = (set(r[0] for r in C.debug_sample(df.repartition(k), fraction=f, seed=1).collect()) for k, f in ((2, .05), (7, .2)))
    assert small < large and 150 < len(small) < 350 and 850 < len(large) < 1150
    got = spark.createDataFrame([(-90,), (90,), (-59,)], "t long").select(X.minutes_since("t", F.lit(0))).collect()
    assert [r[0] for r in got] == [-1, 1, 0]


def test_categorical_index_by_frequency(spark, monkeypatch):
    rows = [(i, v) for i, v in enumerate([5] * 4 + [7] * 4 + [1] * 9 + [None] * 2 + [3])]
    df = spark.createDataFrame(rows, "row_id long, c int")
    want = {1: 0, 5: 1, 7: 2, 3: 4}
    for bound in (1 << 17, 0):
        monkeypatch.setattr(S, "MAX_BROADCAST_ROWS", bound)
        got = P.categorical_index(df, "c").collect()
        assert len(got) == 20 and all(r["c_idx"] == want[r["c"]] for r in got if r["c"] is not None)
