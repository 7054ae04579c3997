"""Scalar column functions (calendar parts, epoch, keys, hashes, ratios).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge import schema as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour(c="click_time") -> Column:
    return F.hour(_c(c)).cast("int")


def day(c="click_time") -> Column:
    return F.dayofmonth(_c(c)).cast("int")


def minute(c="click_time") -> Column:
    return F.minute(_c(c)).cast("int")


def second(c="click_time") -> Column:
    return F.floor(F.second(_c(c))).cast("int")


def weekday(c="click_time") -> Column:
    """Day of week with Monday = 0 (Spark's ``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(c)).cast("int")


def parse_time(c, fmt: str | None = None) -> Column:
    """Text -> timestamp without time zone."""
    return F.to_timestamp_ntz(_c(c), F.lit(fmt)) if fmt else F.to_timestamp_ntz(_c(c))


def to_text(c) -> Column:
    return _c(c).cast("string")


def epoch_seconds(c="click_time", dtype: T.DataType | None = None) -> Column:
    """Whole seconds since 1970-01-01.  For a timestamp without time zone the
    difference is taken in wall-clock time, so the session zone never
    matters; for a zoned timestamp it is the UTC instant."""
    col = _c(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(col)
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col).cast("long")


def with_calendar(df: DataFrame, parts=("hour", "day"), time_col: str = "click_time") -> DataFrame:
    """Add calendar columns (and ``epoch``) in one projection."""
    dtype = df.schema[time_col].dataType
    fns = {"hour": hour, "day": day, "minute": minute, "second": second, "wday": weekday}
    cols = []
    for p in parts:
        if p == "epoch":
            cols.append(epoch_seconds(time_col, dtype).alias("epoch"))
        else:
            cols.append(fns[p](time_col).alias(p))
    return df.select("*", *cols)


def composite_key(*cols, sep: str = "_") -> Column:
    """String key ``a_b_c`` of integer ids."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def digest_number(key) -> Column:
    """The first 32 bits of a key's MD5: the same number in every engine."""
    return F.conv(F.substring(F.md5(_c(key).cast("binary")), 1, 8), 16, 10).cast("long")


def hash_bucket(key, buckets: int = S.HASH_BUCKETS, portable: bool = False) -> Column:
    """Stable key -> bucket in [0, buckets).  Same role as a per-process
    string hash mod 2^26, but reproducible across runs and executors;
    ``portable`` (a string key, at most 2^32 buckets): in other engines too."""
    if portable:
        return digest_number(key) % F.lit(buckets)
    return F.pmod(F.xxhash64(_c(key)), F.lit(buckets)).cast("long")


def log2p1(c, as_smallint: bool = False) -> Column:
    """log2(1 + x) compression of gaps; optionally truncated to int16."""
    v = F.log2(_c(c) + F.lit(1))
    return v.cast("smallint") if as_smallint else v


def safe_ratio(num, den) -> Column:
    """num / den with 0/0 and x/0 -> null (ANSI ``/`` would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def share_pct(c, total: Column) -> Column:
    """100 * x / total."""
    return F.lit(100.0) * _c(c).cast("double") / total


def minutes_since(epoch_col, first_epoch: Column) -> Column:
    """Whole minutes since the first row (truncated)."""
    # a cast drops the fraction toward zero, a floor would not before the first row
    return ((_c(epoch_col) - first_epoch) / F.lit(60)).cast("long")
