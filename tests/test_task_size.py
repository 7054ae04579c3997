"""What one task of the window plan and of a fit takes does not grow with the log."""

from pyspark.sql import functions as F

from clickforge import schema as S
from clickforge.models import gbt as M
from clickforge.plans import features as P
from clickforge.plans.specs import FeatureSpec

SPECS = [FeatureSpec("next", ("ip",), None, "gap", "long"), FeatureSpec("count", ("ip", "app"), None, "n", "long"),
         FeatureSpec("nunique", ("app",), "ip", "nu", "long"), FeatureSpec("next", ("app", "ip"), None, "gap2", "long")]


def _clicks(spark, n, ips):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % ips).alias("ip"),
                                 (F.col("id") % 3).cast("int").alias("app"), (F.col("id") * 7).alias("epoch"))


def test_shuffles_have_a_partition_for_so_many_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "TASK_ROWS", 50)
    out = P.build_features(_clicks(spark, 1000, 200), SPECS[:1])
    assert out.rdd.getNumPartitions() == 20
    assert out.agg(F.count("gap")).first()[0] == 1000


def test_a_key_with_more_rows_than_a_task_takes_is_hot_by_default(spark):
    n = 150_000
    out = P.build_features(_clicks(spark, n, 1), SPECS[:1], n_rows=n)
    assert "__salt0" in out._jdf.queryExecution().analyzed().toString()
    r = out.agg(F.count_if(F.col("gap") == 7).alias("gaps"), F.count("gap").alias("n")).first()
    assert (r["gaps"], r["n"]) == (n - 1, n)


def test_many_hot_keys_are_not_forced_into_a_broadcast(spark, monkeypatch):
    df = _clicks(spark, 600, 60)
    plain = P.build_features(df, SPECS, max_broadcast_rows=0)
    monkeypatch.setattr(S, "MAX_HOT_KEYS", 10)
    many = P.build_features(df, SPECS, max_broadcast_rows=0, hot_rows=7, chunk_rows=13)
    assert "strategy=broadcast" not in many._jdf.queryExecution().analyzed().toString()
    rows = lambda d: sorted(tuple(r) for r in d.select("row_id", "gap", "n", "nu", "gap2").collect())
    assert rows(many) == rows(plain)


def test_a_fit_reads_its_rows_in_few_partitions(spark):
    df = spark.range(1000).repartition(300)
    assert M.fit_rows(df).rdd.getNumPartitions() == M.FIT_TASKS * spark.sparkContext.defaultParallelism
    assert M.fit_rows(df).count() == 1000
