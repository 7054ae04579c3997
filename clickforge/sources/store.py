"""Written tables: feature snapshots, load-or-build caches, per-feature
caches, the predictor manifest and the CSV sinks (submission, importance).

Every path is expected on a shared filesystem (the session's checkpoint
folder by default, see ``session.shared_path``); writes are whole-table
Spark writes, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge import schema as S
from clickforge.plans.specs import FeatureSpec


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the table at path was written to its end."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def file_stamps(spark: SparkSession, files: list[str]) -> str:
    """Digest of the files' names, lengths and modification times, by one
    listing per folder: a file rewritten in place changes it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    wanted, digest = set(files), hashlib.sha1()
    for folder in sorted({f.rpartition("/")[0] for f in files}):
        # names come percent-encoded, as URIs
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for st in sorted(path.getFileSystem(conf).listStatus(path), key=lambda x: x.getPath().toString()):
            name = st.getPath().toUri().toString()
            if name in wanted or f"{folder}/{st.getPath().getName()}" in wanted:
                digest.update(f"{name}\n{st.getLen()}\n{st.getModificationTime()}\n".encode())
    digest.update("\n".join(files).encode())
    return digest.hexdigest()


# ---------------------------------------------------------------------------
# S-SNAPW / S-SNAPR / S-CACHE
# ---------------------------------------------------------------------------
def write_snapshot(df: DataFrame, path: str, partition_by: str | None = "split") -> bool:
    """Write the feature table unless it is already there, complete.
    Partitioned by split so a later read of one split prunes the others."""
    spark = df.sparkSession
    if _exists(spark, path):
        return False
    # what is there without a success mark is the rest of a failed write
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return True


def write_snapshot_stats(df: DataFrame, path: str, columns: list[str], partition_by: str | None = "split") -> DataFrame:
    """A-STAT / A-SHAPE of a snapshot as it is written: its rows counted and least,
    largest and mean of ``columns`` taken from the written columns alone, so the
    plan of ``df`` runs once; one row: n_rows, <column>_max, _min, _mean.
    (Observed metrics would do it in the same pass, but a session that has used
    them can't serialize a forest's scoring function.)"""
    if not write_snapshot(df, path, partition_by):
        raise FileExistsError(path)
    stats = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.max, "max"), (F.min, "min"), (F.avg, "mean"))]
    return df.sparkSession.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *stats)


def read_snapshot(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("split") == split) if split else df


def load_or_build(spark: SparkSession, path: str, build, partition_by: str | None = "split") -> DataFrame:
    """S-CACHE: read the snapshot if present, else build, write, read back."""
    if not _exists(spark, path):
        write_snapshot(build(), path, partition_by)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# S-FCACHE: per-feature group table cache keyed by spec + input range
# ---------------------------------------------------------------------------
def spec_key(spec: FeatureSpec, input_tag: str) -> str:
    raw = json.dumps([spec.op, list(spec.keys), spec.column, spec.out_dtype, spec.null_policy,
                      list(spec.options), input_tag], sort_keys=True)
    return hashlib.sha1(raw.encode()).hexdigest()[:16]


def cached_feature(spark: SparkSession, root: str, spec: FeatureSpec, input_tag: str, compute) -> DataFrame:
    """One Parquet table per (spec, input range).  ``compute()`` returns the
    feature table (group keys + value, or row_id + value for ordered
    features); on a hit it is read instead of recomputed."""
    path = f"{root.rstrip('/')}/{spec.name}-{spec_key(spec, input_tag)}"
    if not _exists(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# S-MANI: predictor / categorical manifest
# ---------------------------------------------------------------------------
MANIFEST_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("role", T.StringType()),
    T.StructField("dtype", T.StringType()), T.StructField("ordinal", T.IntegerType()),
    T.StructField("n_rows", T.LongType()),
])


def manifest_frame(spark: SparkSession, df: DataFrame, predictors, categorical,
                   rows_of: DataFrame | None = None) -> DataFrame:
    """One row per predictor (name, role, type, position) plus the row count
    of the table it describes (``rows_of``, default ``df``; a scalar
    subquery, nothing collected)."""
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    rows = [(p, "categorical" if p in categorical else "numeric", types.get(p, "?"), i)
            for i, p in enumerate(predictors)]
    names = T.StructType(MANIFEST_SCHEMA.fields[:-1])
    src = rows_of if rows_of is not None else df
    return spark.createDataFrame(rows, names).withColumn("n_rows", src.select(F.count(F.lit(1))).scalar())


def with_roles(df: DataFrame, categorical, other=()) -> DataFrame:
    """Columns marked with their role (categorical, numeric, or none for
    ``other``); written tables keep the marks."""
    role = lambda c: {} if c in other else {"role": "categorical" if c in categorical else "numeric"}
    return df.select(*[F.col(c).alias(c, metadata=role(c)) for c in df.columns])


def snapshot_manifest(spark: SparkSession, snapshot_path: str, path: str) -> DataFrame:
    """S-MANI from the written snapshot alone: its marked columns in their order,
    their types and its row count, written to ``path`` and read back."""
    snap = spark.read.parquet(snapshot_path)
    marked = [f for f in snap.schema.fields if "role" in f.metadata]
    write_manifest(spark, path, snap, [f.name for f in marked], [f.name for f in marked if f.metadata["role"] == "categorical"])
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def write_manifest(spark: SparkSession, path: str, df: DataFrame, predictors, categorical,
                   rows_of: DataFrame | None = None) -> None:
    manifest_frame(spark, df, predictors, categorical, rows_of).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Predictor and categorical name lists, in their original order.  The
    manifest has one row per predictor (tens of rows), fine to collect."""
    rows = spark.read.schema(MANIFEST_SCHEMA).json(path).orderBy("ordinal").collect()
    preds = [r["name"] for r in rows]
    return preds, [r["name"] for r in rows if r["role"] == "categorical"]


# ---------------------------------------------------------------------------
# S-SUB / S-IMP
# ---------------------------------------------------------------------------
def submission_frame(scored: DataFrame, prob_col: str, id_col: str = "click_id") -> DataFrame:
    """``click_id, is_attributed`` with the probability printed to 9 decimals."""
    return scored.select(F.col(id_col).cast("long").alias("click_id"),
                         F.format_string(S.SUBMISSION_FLOAT_FORMAT, F.col(prob_col)).alias(S.LABEL))


def write_submission(scored: DataFrame, prob_col: str, path: str, id_col: str = "click_id") -> None:
    submission_frame(scored, prob_col, id_col).write.mode("overwrite").option("header", True).csv(path)


def write_importance(imp: DataFrame, path: str) -> None:
    imp.orderBy(F.desc("gain"), "feature").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
