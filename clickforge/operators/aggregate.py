"""Group aggregates (one row per key) and the log-level reports.

Every aggregate here is a built-in, mergeable Spark aggregate, so Spark plans
partial aggregation before the shuffle: a key holding a third of the log is
reduced to one partial row per input partition before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agg_expr(op: str, column: str | None) -> Column:
    """Aggregate expression for one op (the group-level value)."""
    if op == "count":
        return F.count(F.lit(1))
    c = F.col(column)
    if op == "countnn":
        return F.count(c)
    if op == "nunique":
        return F.count_distinct(c)
    if op == "mean":
        return F.avg(c)
    if op == "var":
        return F.var_samp(c)
    if op == "skew":
        return sample_skewness(c)
    raise ValueError(op)


def sample_skewness(c: Column) -> Column:
    """Bias-corrected sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2).

    Spark's ``skewness`` is the population form g1 and is null for a
    constant group; the reference's is G1, null for n < 3 and 0 for a
    constant group.
    """
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return (F.when(n < 3, F.lit(None).cast("double"))
             .when(F.var_pop(c) == 0, F.lit(0.0))
             .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def group_stats(df: DataFrame, keys, named_ops) -> DataFrame:
    """``groupBy(keys).agg(...)`` for a list of (name, op, column)."""
    return df.groupBy(*keys).agg(*[agg_expr(op, col).alias(name) for name, op, col in named_ops])


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def distinct_counts(df: DataFrame, keys, columns: dict[str, str]) -> DataFrame:
    """A-NUNIQ by bitmaps: per key the exact number of distinct values of each
    column ({name: column}) of whole numbers.

    Values are bits of 32,768-bit maps, one map per key and block of values:
    maps merge in partial aggregation, so a key with a third of the log moves
    as one map per block and task, and no row is expanded per column.  Meant
    for few keys; a map has 4 KB."""
    out = None
    for name, column in columns.items():
        c = F.col(column).cast("long")
        maps = (df.filter(F.col(column).isNotNull()).groupBy(*keys, F.bitmap_bucket_number(c).alias("__block"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("__bits")))
        counts = maps.groupBy(*keys).agg(F.sum(F.bitmap_count("__bits")).alias(name))
        out = counts if out is None else out.join(counts, list(keys), "full")
    return out.fillna(0, list(columns))


def hot_group_stats(df: DataFrame, keys, named_ops) -> DataFrame:
    """``group_stats`` of few keys with many rows each: distinct counts of whole
    numbers by bitmaps, everything else in one pass."""
    kinds = dict(df.dtypes)
    bits = {name: col for name, op, col in named_ops if op == "nunique" and kinds[col] in _WHOLE}
    plain = [x for x in named_ops if x[0] not in bits]
    out = group_stats(df, keys, plain) if plain else df.select(*keys).distinct()
    return out.join(distinct_counts(df, keys, bits), list(keys), "left").fillna(0, list(bits)) if bits else out


# ---------------------------------------------------------------------------
# Log-level reports
# ---------------------------------------------------------------------------
def rows_per(df: DataFrame, col: str, name: str = "n_rows") -> DataFrame:
    """A-DAY / A-LABEL / A-SHAPE: rows per value of one column."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, cond: Column, name: str = "n_rows") -> DataFrame:
    """P-BOOL: boolean mask + row count, as a one-row frame."""
    return df.agg(F.count(F.when(cond, F.lit(1))).alias(name))


def feature_stats(df: DataFrame, columns) -> DataFrame:
    """A-STAT: max / min / mean of every feature in a single pass (one row)."""
    exprs = []
    for c in columns:
        exprs += [F.max(c).alias(f"{c}_max"), F.min(c).alias(f"{c}_min"), F.avg(c).alias(f"{c}_mean")]
    return df.agg(*exprs)


def first_value(df: DataFrame, col: str, order: str = "row_id", name: str | None = None) -> DataFrame:
    """A-FIRST: value of ``col`` on the first row in row order (one row)."""
    return df.agg(F.min_by(F.col(col), F.col(order)).alias(name or f"first_{col}"))


def shape(df: DataFrame, by: str | None = None) -> DataFrame:
    """A-SHAPE: rows (per split) and column count."""
    ncols = len(df.columns)
    g = df.groupBy(by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(ncols).alias("n_cols"))
