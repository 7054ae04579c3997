"""One key holding a third of all rows: the large-input plans give the same
features as the window plan, and the hot key is spread over many tasks."""

import pandas as pd
from pyspark.sql import functions as F

from clickforge.plans.features import build_features
from clickforge.plans.queries import _features_out, clicks
from clickforge.plans.specs import FeatureSpec
from conftest import SF_CHECK

SPECS = [
    FeatureSpec("count", ("ip", "app"), None, "ip_app_count"),
    FeatureSpec("nunique", ("ip",), "channel", "X0"),
    FeatureSpec("var", ("ip", "app", "channel"), "hour", "v", "double", "mean"),
    FeatureSpec("cumcount", ("ip", "device", "os"), None, "X1"),
    FeatureSpec("next", ("ip", "app", "device", "os"), None, "next_click", "long"),
    FeatureSpec("expmean", ("ip", "app"), "is_attributed", "em", "double", "zero"),
]


def skewed(spark):
    # every third row moves to ip 0: one key with a third of the log
    base = clicks(spark, SF_CHECK)
    return base.withColumn("ip", F.when(F.col("row_id") % 3 == 0, F.lit(0)).otherwise(F.col("ip")))


def test_hot_key_features_equal_plain_windows(spark):
    df = skewed(spark)
    ref = _features_out(build_features(df, SPECS), SPECS).toPandas().sort_values("row_id").reset_index(drop=True)
    for chunk, hot in ((211, None), (211, 30), (97, 2000)):
        out = build_features(df, SPECS, chunk_rows=chunk, hot_rows=hot, max_broadcast_rows=0)
        got = _features_out(out, SPECS).toPandas().sort_values("row_id").reset_index(drop=True)
        pd.testing.assert_frame_equal(ref.round(6), got.round(6), check_dtype=False)


def test_a_third_of_rows_without_a_key(spark):
    df = skewed(spark).withColumn("ip", F.when(F.col("ip") != 0, F.col("ip"))).withColumn("device", F.when(F.col("row_id") % 5 > 0, F.col("device")))
    ref = _features_out(build_features(df, SPECS), SPECS).toPandas().sort_values("row_id").reset_index(drop=True)
    got = _features_out(build_features(df, SPECS, chunk_rows=211, hot_rows=300, max_broadcast_rows=0), SPECS).toPandas()
    pd.testing.assert_frame_equal(ref.round(6), got.sort_values("row_id").reset_index(drop=True).round(6), check_dtype=False)


def moved(df):
    """Rows written by all shuffles of the plan, when it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        subs = node.subqueries()
        todo += [subs.apply(i) for i in range(subs.size())]
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
    return total


def test_rows_moved_are_bounded(spark):
    """All keys cold: the log moves once per shared column, however many rows;
    one hot ip with a third of the log: in addition its rows, and one move of
    the log by row id."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 10_000
        base = clicks(spark, SF_CHECK)
        keep = [FeatureSpec(s.op, s.keys, s.column, s.name, s.dtype, "keep" if s.nulls == "mean" else s.nulls) for s in SPECS]
        # families of ip only; no ip has 1,000 rows
        cold = moved(build_features(base, keep, chunk_rows=211, hot_rows=1000, max_broadcast_rows=0))
        assert cold == n
        hot = moved(build_features(skewed(spark), keep, chunk_rows=211, hot_rows=1000, max_broadcast_rows=0))
        third = n / 3 + 50
        # log by ip and by row id; hot rows: one table per next key column, chunks and their
        # tables, aggregates of the hot key, all pieces by row id
        assert hot <= 2 * n + 12 * third
        # a third of the rows being hot does not make the tables of cold keys grow
        assert cold < hot
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_key_is_split_over_tasks(spark):
    """Rows partitioned by (ip, chunk): the hot ip's ~3,334 rows land in
    groups of at most chunk_rows and in many partitions."""
    df = skewed(spark)
    chunk_rows = 211
    parts = (df.withColumn("__chunk", F.expr(f"row_id div {chunk_rows}"))
             .repartition(16, "ip", "__chunk").withColumn("pid", F.spark_partition_id()))
    hot = parts.filter(F.col("ip") == 0)
    per_group = hot.groupBy("__chunk").count().agg(F.max("count")).first()[0]
    n_parts = hot.select("pid").distinct().count()
    assert per_group <= chunk_rows
    assert n_parts >= 8
