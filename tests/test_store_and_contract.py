"""Written tables and the driver contract."""

import os

from pyspark.sql import functions as F

from clickforge.session import shared_path
from clickforge.sources import store as ST
from conftest import SF_CHECK, SF_SMALL


def test_snapshot_written_once_and_split_pruned(spark):
    df = spark.range(50).withColumnRenamed("id", "row_id").withColumn(
        "split", F.when(F.col("row_id") < 40, "train").otherwise("test"))
    path = shared_path(spark, "snap-test")
    assert ST.write_snapshot(df, path) is True
    assert ST.write_snapshot(df, path) is False          # present: not rewritten
    assert ST.read_snapshot(spark, path, "test").count() == 10


def test_load_or_build_does_not_rebuild(spark):
    path = shared_path(spark, "lob-test")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    ST.load_or_build(spark, path, build, None)
    ST.load_or_build(spark, path, build, None)
    assert len(calls) == 1


def test_submission_format(spark):
    df = spark.createDataFrame([(0, 0.1234567891234), (1, 1.0)], "click_id long, p double")
    rows = ST.submission_frame(df, "p").orderBy("click_id").collect()
    assert rows[0].is_attributed == "0.123456789" and rows[1].is_attributed == "1.000000000"


def test_entry_runs_on_smoke_data(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "X0" in df.columns


def test_every_query_has_callable_and_oracle_subset():
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 60


def test_oracle_subset_matches_duckdb(spark):
    """A fast slice of the driver's check at sf0.001."""
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import compare, duck
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(SF_SMALL)
    for name in ["count_by_key", "nunique", "var_mean_imputed", "next_gap_chunked", "expanding_mean",
                 "features_nb977", "auc_rank", "split_assign", "ip_stats_hot_split"]:
        res = compare(qs[name](spark, SF_SMALL).toPandas(), con.execute(sqls[name]).df())
        assert res == "ok", (name, res)


def test_group_table_cache_is_read_back(spark):
    from clickforge.plans.features import build_features
    from clickforge.plans.queries import clicks
    from clickforge.plans.specs import FeatureSpec
    specs = [FeatureSpec("count", ("ip", "app"), None, "n"), FeatureSpec("var", ("ip",), "hour", "v")]
    root = shared_path(spark, "gcache-test")
    first = build_features(clicks(spark, SF_SMALL), specs, cache_root=root, input_tag="all")
    second = build_features(clicks(spark, SF_SMALL), specs, cache_root=root, input_tag="all")
    plan = second._jdf.queryExecution().optimizedPlan().toString()
    # no group-by of the log is left (only the one-row imputation fit over
    # the cached tables): both group tables are cached reads
    assert "Aggregate [ip" not in plan and "Aggregate [app" not in plan
    assert plan.count("__n#") >= 2 and "parquet" in plan
    a = first.select("row_id", "n", "v").toPandas().sort_values("row_id").reset_index(drop=True)
    b = second.select("row_id", "n", "v").toPandas().sort_values("row_id").reset_index(drop=True)
    assert a.equals(b)
    plain = build_features(clicks(spark, SF_SMALL), specs).select("row_id", "n", "v").toPandas()
    assert (plain.sort_values("row_id").reset_index(drop=True).round(6) == a.round(6)).all().all()


def test_group_cache_tells_filters_and_fit_slices_apart(spark):
    import pytest
    from clickforge.plans.features import build_features
    from clickforge.plans.queries import clicks
    from clickforge.plans.specs import FeatureSpec
    specs = [FeatureSpec("count", ("ip",), None, "n")]
    root = shared_path(spark, "gcache-two")
    base = clicks(spark, SF_SMALL)
    half = base.filter(F.col("row_id") < 500)
    with pytest.raises(ValueError):
        build_features(base, specs, cache_root=root)
    whole = build_features(base, specs, cache_root=root, input_tag="t")
    fitted = build_features(base, specs, cache_root=root, input_tag="t", fit_on=half)
    assert whole.filter("row_id = 0").first()["n"] == base.filter(F.col("ip") == whole.filter("row_id = 0").first()["ip"]).count()
    got = {r["ip"]: r["n"] for r in fitted.select("ip", "n").distinct().collect()}
    want = {r["ip"]: r["count"] for r in half.groupBy("ip").count().collect()}
    assert all(got[k] == v for k, v in want.items())


def test_long_sums_stay_exact_in_every_plan(spark):
    from clickforge.plans.features import build_features
    from clickforge.plans.specs import FeatureSpec
    big = 2 ** 53
    df = spark.range(40).selectExpr("id as row_id", "id % 3 as k", "id % 2 as j", f"{big}L + id as v")
    specs = [FeatureSpec("cumsum", ("k",), "v", "s", "long"), FeatureSpec("nunique", ("j",), "v", "d", "long")]
    for kw in ({}, {"chunk_rows": 7, "max_broadcast_rows": 0}, {"chunk_rows": 7, "max_broadcast_rows": 0, "hot_rows": 16}):
        for r in build_features(df, specs, **kw).collect():
            assert r["s"] == sum(big + i for i in range(r["row_id"] % 3, r["row_id"] + 1, 3)) and r["d"] == 20, kw
