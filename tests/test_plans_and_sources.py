"""Plan equivalence on the events fixture and the typed sources."""

import pandas as pd
from pyspark.sql import functions as F

from clickforge import schema as S
from clickforge.plans.features import build_features
from clickforge.plans.queries import _features_out, clicks
from clickforge.plans.specs import catalogue_all, catalogue_v27
from clickforge.session import shared_path
from clickforge.sources import clicks as C
from conftest import SF_SMALL


def _frame(df):
    pdf = df.toPandas().sort_values("row_id").reset_index(drop=True)
    return pdf.round(6)


def test_chunked_plan_equals_window_plan_v27(spark):
    base = clicks(spark, SF_SMALL)
    specs = catalogue_v27()
    small = _frame(_features_out(build_features(base, specs), specs))
    for chunk, hot in ((97, 60), (333, None), (41, 5)):
        big = _frame(_features_out(build_features(base, specs, chunk_rows=chunk, hot_rows=hot, max_broadcast_rows=0), specs))
        pd.testing.assert_frame_equal(small, big, check_dtype=False)


def test_chunked_plan_equals_window_plan_all58(spark):
    base = clicks(spark, SF_SMALL)
    specs = catalogue_all()
    small = _frame(_features_out(build_features(base, specs), specs))
    big = _frame(_features_out(build_features(base, specs, chunk_rows=101, hot_rows=20), specs))
    pd.testing.assert_frame_equal(small, big, check_dtype=False)


def test_read_click_csv_in_log_format(spark):
    """Write the fixture as a click CSV (seconds resolution, header) and read
    it back with the explicit schema and column pruning."""
    src = C.load_clicks(spark, SF_SMALL).select(
        F.col("ip").cast("long").alias("ip"), "app", "device", "os", "channel",
        F.date_format("click_time", "yyyy-MM-dd HH:mm:ss").alias("click_time"),
        F.lit(None).cast("string").alias("attributed_time"), "is_attributed")
    path = shared_path(spark, "train-csv")
    src.write.option("header", True).csv(path)
    back = C.read_click_csv(spark, path, S.TRAIN_SCHEMA)
    assert back.columns == ["ip", "app", "device", "os", "channel", "click_time", "is_attributed"]
    assert back.schema["click_time"].dataType.simpleString() == "timestamp_ntz"
    assert back.count() == src.count()
    assert back.filter(F.col("click_time").isNull()).count() == 0


def test_assign_row_id_file_order_and_ordered(spark):
    ev = C.table(spark, SF_SMALL, "events").select("event_id", "ts")
    idx = C.assign_row_id(ev).toPandas()
    assert sorted(idx["row_id"]) == list(range(len(idx)))
    ordered = C.assign_row_id(ev, [F.desc("ts"), F.col("event_id")]).toPandas().sort_values("row_id")
    assert list(ordered["ts"]) == sorted(ordered["ts"], reverse=True)


def test_union_sets_sentinels(spark):
    df = C.load_clicks(spark, SF_SMALL)
    train = df.filter("row_id < 800").select("row_id", "ip", "is_attributed")
    test = df.filter("row_id >= 800").select("row_id", "ip", (F.col("row_id") - 800).alias("click_id"))
    u = C.union_labelled(train, test).toPandas()
    assert (u[u.row_id < 800].click_id == S.MISSING).all()
    assert (u[u.row_id >= 800].is_attributed == S.MISSING).all()
    assert len(u) == 1000


def test_file_order_index_over_unequal_files(spark, tmp_path):
    from clickforge.sources import clicks as C

    path, at = str(tmp_path / "log"), 0
    for k, n in enumerate((40, 2000, 300)):  # Spark reads the larger files first
        spark.range(at, at + n).selectExpr("id AS v").coalesce(1).write.parquet(f"{path}/part={k}")
        at += n
    got = C.assign_row_id(spark.read.parquet(path).select("v"))
    assert got.where("row_id = v").count() == at and got.where("row_id <> v").count() == 0


def test_file_order_index_over_splits(spark, tmp_path):
    from clickforge.sources import clicks as C

    path = str(tmp_path / "csv")
    spark.range(5000).selectExpr("id AS v", "repeat('x', 50) AS pad").coalesce(1).write.csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        log = spark.read.schema("v long, pad string").csv(path)
        assert log.rdd.getNumPartitions() > 4
        assert C.assign_row_id(log).where("row_id = v").count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_half_written_table_is_built_again(spark, tmp_path):
    import os

    from clickforge.sources import store

    path = str(tmp_path / "snap")
    spark.range(3).write.parquet(path)
    os.rename(os.path.join(path, "_SUCCESS"), str(tmp_path / "was"))
    assert store.load_or_build(spark, path, lambda: spark.range(7).toDF("id")).count() == 7
    assert store.load_or_build(spark, path, lambda: spark.range(9).toDF("id")).count() == 7


def test_a_cluster_must_name_its_shared_folder():
    import types

    import pytest

    from clickforge.session import ensure_checkpoint_dir

    conf = types.SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None)
    sc = types.SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=sc, conf=conf))
