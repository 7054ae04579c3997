"""Group aggregates, null keys, null / type policies against pandas."""

import numpy as np
import pandas as pd
import pytest

from clickforge.functions import policy as P
from clickforge.plans.features import build_features
from clickforge.plans.specs import FeatureSpec, dedup, families
from helpers import as_float_dict, close, pandas_feature

SCHEMA = "row_id long, ip int, app int, hour int, epoch long"


def hand():
    rows = [(0, 1, 1, 3, 0), (1, 1, 1, 3, 1), (2, 1, 1, 5, 2), (3, 2, 1, 7, 3),   # singleton (2,1)
            (4, None, 1, 9, 4), (5, 1, 2, 9, 5), (6, 1, 2, 9, 6), (7, 1, 2, 9, 7),   # constant group
            (8, 3, 3, 1, 8), (9, 3, 3, 2, 9), (10, 3, 3, 8, 10), (11, 3, 3, 23, 11)]
    return pd.DataFrame(rows, columns=["row_id", "ip", "app", "hour", "epoch"])


def spark_df(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), SCHEMA)


@pytest.mark.parametrize("op,col", [("count", None), ("nunique", "hour"), ("mean", "hour"),
                                    ("var", "hour"), ("skew", "hour")])
@pytest.mark.parametrize("chunk_rows,hot_rows", [(2, 1), (2, 3), (1 << 22, None)])
def test_group_aggregates_keep(spark, op, col, chunk_rows, hot_rows):
    pdf = hand()
    spec = FeatureSpec(op, ("ip", "app"), col, "f", "double", "keep")
    got = as_float_dict(build_features(spark_df(spark, pdf), [spec], chunk_rows=chunk_rows,
                                       hot_rows=hot_rows, n_rows=len(pdf), max_broadcast_rows=0).toPandas(), "f")
    exp = pandas_feature(pdf, op, ("ip", "app"), col)
    for r, e in exp.items():
        assert close(None if pd.isna(e) else float(e), got[r]), (op, r, e, got[r])


def test_null_key_count_is_zero_after_fill(spark):
    # pandas groupby drops the null key; the left merge gives NaN -> fillna(0)
    pdf = hand()
    out = build_features(spark_df(spark, pdf), [FeatureSpec("count", ("ip",), None, "n")]).toPandas()
    assert out.set_index("row_id").loc[4, "n"] == 0


def test_singleton_variance_is_null_then_mean_imputed_row_weighted(spark):
    pdf = hand()
    keep = build_features(spark_df(spark, pdf), [FeatureSpec("var", ("ip", "app"), "hour", "v", "double", "keep")])
    imp = build_features(spark_df(spark, pdf), [FeatureSpec("var", ("ip", "app"), "hour", "v", "double", "mean")])
    k = keep.toPandas().set_index("row_id")["v"]
    i = imp.toPandas().set_index("row_id")["v"]
    assert pd.isna(k.loc[3]) and pd.isna(k.loc[4])
    expected = k.dropna().mean()          # row-weighted, like sklearn's Imputer after the merge
    assert abs(i.loc[3] - expected) < 1e-9 and abs(i.loc[4] - expected) < 1e-9


def test_wrap_uint8_over_255_distinct(spark):
    pdf = pd.DataFrame({"row_id": range(600), "ip": [1] * 300 + [2] * 300, "app": 1,
                        "hour": list(range(300)) + [5] * 300, "epoch": range(600)})
    spec = FeatureSpec("nunique", ("ip",), "hour", "x", "uint8")
    wide = build_features(spark_df(spark, pdf), [spec]).toPandas().set_index("row_id")["x"]
    wrapped = build_features(spark_df(spark, pdf), [spec], wrap=True).toPandas().set_index("row_id")["x"]
    assert wide.loc[0] == 300 and wrapped.loc[0] == 300 % 256 and wrapped.loc[400] == 1


def test_dedup_and_families():
    a = FeatureSpec("nunique", ("ip",), "device", "X5", "uint16")
    b = FeatureSpec("nunique", ("ip",), "device", "ip_device_countuniq", "uint16")
    c = FeatureSpec("count", ("ip", "app"), None, "n1")
    d = FeatureSpec("mean", ("app", "ip"), "hour", "m1")
    uniq, aliases = dedup([a, b, c, d])
    assert aliases == {"ip_device_countuniq": "X5"} and len(uniq) == 3
    fam = families(uniq)
    assert set(fam) == {("ip",), ("app", "ip")} and len(fam[("app", "ip")]) == 2


def test_duplicate_specs_share_one_column(spark):
    pdf = hand()
    a = FeatureSpec("nunique", ("ip",), "hour", "X5")
    b = FeatureSpec("nunique", ("ip",), "hour", "other")
    out = build_features(spark_df(spark, pdf), [a, b]).toPandas()
    assert (out["X5"] == out["other"]).all()


def test_cast_policies(spark):
    df = spark.createDataFrame([(300.7,), (None,), (-1.0,)], "x double")
    from pyspark.sql import functions as F
    r = df.select(P.cast_to(F.col("x"), "uint8", wrap=True).alias("w"),
                  P.cast_to(F.col("x"), "uint8").alias("widened"),
                  P.fill_zero(F.col("x")).alias("z")).collect()
    assert [x.w for x in r] == [300 % 256, None, 255]
    assert [x.widened for x in r] == [300, None, -1]
    assert r[1].z == 0


def test_categorical_index_frequency_order(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([5, 5, 5, 2, 2, 9, 1, 1])], "row_id long, channel int")
    out = {r.channel: r.idx for r in P.categorical_index(df, "channel", "idx").collect()}
    assert out == {5: 0, 1: 1, 2: 2, 9: 3}   # ties broken by value


def test_distinct_counts_by_bitmaps(spark):
    from clickforge.operators.aggregate import distinct_counts, hot_group_stats
    rows = [(k, v, w) for k in (1, 2) for v in (0, 1, -1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**31 - 1, None) for w in (5, 6, None)] + [(3, None, None)]
    df = spark.createDataFrame(rows, "k int, v int, w long")
    got = distinct_counts(df, ["k"], {"nv": "v", "nw": "w"})
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in got.collect()} == {(1, 9, 2), (2, 9, 2)}
    both = hot_group_stats(df, ["k"], [("n", "count", None), ("nv", "nunique", "v"), ("nw", "nunique", "w")])
    assert {tuple(r) for r in both.select("k", "n", "nv", "nw").collect()} == {(1, 30, 9, 2), (2, 30, 9, 2), (3, 1, 0, 0)}
