"""Positional splits: train / validation / test and the helper-model slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def assign_split(df: DataFrame, len_train, val_size, label: str = "label", order: str = "row_id") -> DataFrame:
    """T-SPLIT as one ``split`` column instead of three frames.

    Rows at or after ``len_train`` are ``test``, the last ``val_size``
    labelled rows are ``val``, the rest ``train``.  A written snapshot
    partitioned by ``split`` then reads one split with partition pruning.
    """
    lt, vs = _lit(len_train), _lit(val_size)
    split = (F.when(F.col(order) >= lt, F.lit("test"))
              .when(F.col(order) >= lt - vs, F.lit("val"))
              .otherwise(F.lit("train")))
    return df.withColumn("split", split)


def train_slice(df: DataFrame, len_train, size, val_size, order: str = "row_id") -> DataFrame:
    """T-SLICE: rows [len_train - size, len_train - val_size)."""
    lt = _lit(len_train)
    return df.filter((F.col(order) >= lt - _lit(size)) & (F.col(order) < lt - _lit(val_size)))


def day_filter(df: DataFrame, day_start: str, time_col: str = "click_time") -> DataFrame:
    """P-DAY: keep one calendar day.  Written as a half-open timestamp range
    (not ``dayofmonth(ts) = d``) so Parquet can push it and skip row groups."""
    start = F.lit(day_start).cast("timestamp_ntz")
    return df.filter((F.col(time_col) >= start) & (F.col(time_col) < start + F.expr("INTERVAL 1 DAY")))
