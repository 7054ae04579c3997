"""Click-log sources: typed CSV read, the click view over ``events``,
row ranges, head / debug reads, dense row index and train+test union.

Row identity is an explicit ``row_id BIGINT`` made once at ingest.  All
ordered features order by it; it is the file (= time) order of the log.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge import schema as S
from clickforge.functions.scalar import digest_number

CLICK_COLUMNS = ["row_id", "ip", "app", "device", "os", "channel", "click_time", "is_attributed"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _app_code(event_type: Column) -> Column:
    expr = None
    for name, code in S.APP_CODES.items():
        expr = F.when(event_type == name, F.lit(code)) if expr is None else expr.when(event_type == name, F.lit(code))
    return expr.otherwise(F.lit(S.APP_CODE_OTHER))


def click_view(events: DataFrame, extra=()) -> DataFrame:
    """The click log emulated over the driver's ``events`` table.

    event_id is dense and in time order, so it is the row index directly.
    Only the referenced source columns are read (the Parquet ReadSchema
    shrinks with the projection of whatever query sits on top).
    """
    # The JSON field is parsed once; Catalyst keeps the two projections apart
    # instead of inlining the parse into both columns that use it.
    parsed = events.select("event_id", "user_id", "event_type", "value", "ts",
                           F.get_json_object(F.col("props"), "$.k").cast("int").alias("__k"),
                           *[c for c in extra if c not in ("value",)])
    k = F.col("__k")
    return parsed.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").cast("long").alias("ip"),
        _app_code(F.col("event_type")).alias("app"),
        (k % 4).alias("device"),
        (F.floor(F.col("value")).cast("int") % 10).alias("os"),
        k.alias("channel"),
        F.col("ts").alias("click_time"),
        (F.col("event_type") == F.lit("purchase")).cast("int").alias("is_attributed"),
        *[F.col(c) for c in extra],
    )


def load_clicks(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    return click_view(table(spark, sf_dir, "events"), extra)


def ingest(df: DataFrame, path: str, order: str = "row_id") -> DataFrame:
    """Write the typed click table once and read it back as Parquet.

    Every feature family scans the log again; reading narrow typed columns
    (with column pruning and row-group skipping on ``row_id``) is far cheaper
    than re-parsing the source each time.  When the source has fewer
    partitions than the cluster has cores (small inputs), the table is
    range-split on ``row_id`` so later scans run in parallel; on large
    inputs the source partitioning is kept and nothing is shuffled.
    """
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        df = df.repartitionByRange(par, order)
    df.write.mode("overwrite").parquet(path)
    write_zones(spark, path, order)
    # the id columns' bounds are what broadcasts rely on (schema.KEY_DOMAIN)
    bounded = [c for c in S.KEY_DOMAIN if c in df.columns]
    seen = read_zones(spark, path).select(F.explode("ids").alias("c", "v")).groupBy("c").agg(F.min("v.low").alias("low"), F.max("v.high").alias("high"))
    for r in seen.collect() if bounded else ():
        if r["low"] is not None and not 0 <= r["low"] <= r["high"] < S.KEY_DOMAIN[r["c"]]:
            raise ValueError(f"{r['c']} has values from {r['low']} to {r['high']}, outside 0 to {S.KEY_DOMAIN[r['c']] - 1}")
    return spark.read.parquet(path)


# --------------------------------------------------------------------------
# S-RANGE over written tables: a zone per file
# --------------------------------------------------------------------------
IDS = "map<string, struct<low: bigint, high: bigint>>"


def write_zones(spark: SparkSession, path: str, order: str = "row_id") -> None:
    """Zone table of a written log: file, least and largest ``order``, rows, the
    range of each id column, and the log's schema, in a folder of it that scans
    skip.  One pass over these columns."""
    df = spark.read.parquet(path)
    ids = [c for c in S.KEY_DOMAIN if c in df.columns]
    ranges = [x for c in ids for x in (F.lit(c), F.struct(F.min(c).cast("long").alias("low"), F.max(c).cast("long").alias("high")))]
    zones = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(order).cast("long").alias("low"), F.max(order).cast("long").alias("high"), F.count(F.lit(1)).alias("n"),
        (F.create_map(*ranges) if ranges else F.lit(None).cast(IDS)).alias("ids"))
    zones.withColumn("schema", F.lit(df.schema.json())).coalesce(1).write.mode("overwrite").parquet(f"{path}/_zones")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"file string, low long, high long, n long, ids {IDS}, schema string").parquet(f"{path}/_zones")


def read_rows(spark: SparkSession, path: str, start: int, stop: int, order: str = "row_id") -> DataFrame:
    """Rows [start, stop) of a written log.  Only files whose zone meets the
    range are listed and opened; inside them the literal bounds are pushed to
    the scan, whose statistics skip row groups.  The driver holds the names of
    the range's files."""
    zones = read_zones(spark, path)
    hit = zones.filter((F.col("high") >= start) & (F.col("low") < stop)).select("file").orderBy("low").collect()
    schema = T.StructType.fromJson(json.loads(zones.select("schema").first()["schema"]))
    if not hit:
        return spark.createDataFrame([], schema)
    # names in the zone table are URIs, percent-encoded
    df = spark.read.schema(schema).parquet(*[unquote(r["file"]) for r in hit])
    return df.filter((F.col(order) >= F.lit(int(start)).cast("long")) & (F.col(order) < F.lit(int(stop)).cast("long")))


# --------------------------------------------------------------------------
# S-CSV: typed, column-pruned CSV read with a timestamp parse
# --------------------------------------------------------------------------
def read_click_csv(spark: SparkSession, path: str, schema: T.StructType = S.TRAIN_SCHEMA,
                   columns: list[str] | None = None, time_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Explicit schema (never inferSchema); only ``columns`` are kept, so the
    CSV reader parses only those fields.  A malformed row raises."""
    df = (spark.read.schema(schema).option("header", True)
          .option("timestampNTZFormat", time_format)
          .option("mode", "FAILFAST").csv(path))
    return df.select(*(columns or [f.name for f in schema.fields if f.name != "attributed_time"]))


# --------------------------------------------------------------------------
# O-ROW: dense row index
# --------------------------------------------------------------------------
def _plain_scan(plan) -> bool:
    kind, children = plan.nodeName(), plan.children()
    if children.isEmpty():
        return kind in ("LogicalRelation", "Relation")
    return kind in ("Project", "Filter", "SubqueryAlias") and children.size() == 1 and _plain_scan(children.head())


def _file_order(df: DataFrame, name: str) -> DataFrame | None:
    """Dense index of a file scan in file order, None if df is anything but
    projections and filters over one.

    The rows of a split stand together in one partition, in file order; a count
    per split and a running sum over splits ordered by path and start give each
    split its offset.  One row per split, so the broadcast is bounded by them.
    """
    # a shuffle, join, sort or union in between would deal a split's rows anew
    if not _plain_scan(df._jdf.queryExecution().analyzed()):
        return None
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"))
    except AnalysisException:
        return None
    rows = rows.withColumn("__mono", F.monotonically_increasing_id())
    splits = rows.groupBy("__file", "__start").agg(F.min("__mono").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("__file", "__start", "__first", F.coalesce(before, F.lit(0)).alias("__off"))
    out = rows.join(F.broadcast(splits), ["__file", "__start"])
    return out.withColumn(name, (F.col("__off") + F.col("__mono") - F.col("__first")).cast("long")).drop("__file", "__start", "__mono", "__first", "__off")


def assign_row_id(df: DataFrame, order_cols: list[str] | None = None, name: str = "row_id") -> DataFrame:
    """Dense 0-based row index.

    With ``order_cols`` the index follows that total order, without it the
    input order.  Over a file scan that is file order: files by path, and the
    rows of each in their order in the file, however Spark has sorted and packed
    the splits into partitions.  Other frames are taken in partition order.
    Implemented as the usual two-pass scan: a
    per-partition count, a prefix sum over partition counts (one row per
    partition, so bounded by the partition count) and a local row number.
    No single task sees more than one partition.

    With an order, the range-partitioned, sorted rows are first written as a
    reliable checkpoint to the shared folder: the partition counts and the
    rows must see the *same* partitions, and range bounds are sampled anew
    each time a range exchange is recomputed.  So are the rows of any frame that
    is not a plain scan, as its partitions may be dealt anew by a second run.
    File-order input needs no checkpoint (file splits are deterministic).
    """
    from clickforge.session import cut_lineage
    if order_cols:
        df = cut_lineage(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols))
    else:
        by_file = _file_order(df, name)
        if by_file is not None:
            return by_file
        df = cut_lineage(df)
    pid = "__pid"
    with_pid = df.withColumn(pid, F.spark_partition_id()).withColumn(
        "__mono", F.monotonically_increasing_id())
    # monotonically_increasing_id = (partition << 33) + local position.
    local = F.col("__mono") - F.shiftleft(F.col(pid).cast("long"), 33)
    counts = with_pid.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        pid,
        (F.sum("__n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    # offsets has one row per input partition: a proven size bound.
    out = with_pid.join(F.broadcast(offsets), pid, "left").withColumn(
        name, (F.coalesce(F.col("__off"), F.lit(0)) + local).cast("long"))
    return out.drop(pid, "__mono", "__off")


# --------------------------------------------------------------------------
# S-RANGE / S-HEAD / S-DEBUG / O-ILOC
# --------------------------------------------------------------------------
def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def row_range(df: DataFrame, start, stop) -> DataFrame:
    """Rows [start, stop) of the log.  A literal bound on row_id is pushed to
    the Parquet scan, whose min/max statistics skip whole row groups."""
    return df.filter((F.col("row_id") >= _lit(start)) & (F.col("row_id") < _lit(stop)))


def head(df: DataFrame, n: int) -> DataFrame:
    """First n rows in row order (top-k plan, no global sort)."""
    return df.orderBy("row_id").limit(n)


def row_at(df: DataFrame, n) -> DataFrame:
    """O-ILOC: the row at position n."""
    return df.filter(F.col("row_id") == _lit(n))


def debug_sample(df: DataFrame, n_rows: int | None = None, fraction: float | None = None,
                 seed: int = 0, key: str = "row_id") -> DataFrame:
    """Small-sample mode: the rows whose key's digest falls into a fraction of
    its range, or the first n rows.  A row is in or out whatever the layout of
    the input, and a larger fraction holds the smaller one's rows."""
    if fraction is not None:
        return df.filter(digest_number(F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string"))) < int(fraction * (1 << 32)))
    if n_rows is None:
        raise ValueError("give a fraction or a number of rows")
    return head(df, n_rows)


# --------------------------------------------------------------------------
# Train / test framing of the click view
# --------------------------------------------------------------------------
def n_rows(df: DataFrame) -> Column:
    """Row count as a scalar subquery (stays lazy, no driver round trip)."""
    return df.select(F.count(F.lit(1))).scalar()


def label_rows(df: DataFrame, len_train: Column | int, sentinel: int | None = None) -> DataFrame:
    """Hide the label of the unlabelled tail and give those rows a click id.

    ``label`` is null on test rows (or ``sentinel`` in sentinel mode);
    ``click_id`` is the 0-based position inside the test part, and null
    (or ``sentinel``) on train rows.
    """
    lt = F.lit(len_train) if isinstance(len_train, int) else len_train
    is_test = F.col("row_id") >= lt
    fill = F.lit(None).cast("int") if sentinel is None else F.lit(sentinel)
    fill_id = F.lit(None).cast("long") if sentinel is None else F.lit(sentinel).cast("long")
    return df.withColumn("label", F.when(is_test, fill).otherwise(F.col(S.LABEL)).cast("int")) \
             .withColumn("click_id", F.when(is_test, F.col("row_id") - lt).otherwise(fill_id).cast("long"))


# --------------------------------------------------------------------------
# U-UNION / P-CONST
# --------------------------------------------------------------------------
def union_labelled(train: DataFrame, test: DataFrame, sentinel: int | None = S.MISSING) -> DataFrame:
    """Append test below train.  Each side gets the other's id column as a
    sentinel constant; columns missing on one side stay null otherwise."""
    if "click_id" not in train.columns:
        train = train.withColumn("click_id", F.lit(sentinel).cast("long"))
    if S.LABEL not in test.columns:
        test = test.withColumn(S.LABEL, F.lit(sentinel).cast("int"))
    return train.unionByName(test, allowMissingColumns=True)
