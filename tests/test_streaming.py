"""Streaming re-score equals batch scoring of the same snapshot."""

import random

from pyspark.sql import functions as F

from clickforge.models import gbt as M
from clickforge.session import shared_path
from clickforge.streaming.rescore import run_rescore


def test_stream_rescore_matches_batch(spark):
    rnd = random.Random(1)
    rows = [(i, float(rnd.random()), float(rnd.random()), int(rnd.random() > 0.7)) for i in range(300)]
    df = spark.createDataFrame(rows, "click_id long, a double, b double, label int")
    model = M.fit(df, ["a", "b"], "label", {"num_boost_round": 3, "max_depth": 2, "min_child_samples": 1})
    mpath = shared_path(spark, "stream-model")
    M.save(model, mpath)
    src = shared_path(spark, "stream-src")
    df.drop("label").repartition(3).write.parquet(src)
    out, ckpt = shared_path(spark, "stream-out"), shared_path(spark, "stream-ckpt")
    q = run_rescore(spark, mpath, src, df.drop("label").schema, ["a", "b"], out, ckpt)
    q.awaitTermination(120)
    got = spark.read.option("header", True).schema("click_id long, is_attributed string").csv(out)
    batch = M.score(model, df, ["a", "b"]).select("click_id", F.format_string("%.9f", "p").alias("is_attributed"))
    assert got.count() == 300
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
