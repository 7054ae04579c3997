"""Null and type policies, projections and label overwrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge import schema as S

# Reference dtype names -> Spark types.  Unsigned widths are widened (Spark
# has no unsigned types); ``wrap=True`` reproduces numpy's modular cast.
DTYPE_MAP = {
    "uint8": ("int", 8), "uint16": ("int", 16), "uint32": ("long", 32),
    "int8": ("int", None), "int16": ("smallint", None), "int32": ("int", None), "int": ("int", None),
    "int64": ("long", None), "long": ("long", None), "bigint": ("long", None),
    "float32": ("float", None), "float": ("float", None),
    "float64": ("double", None), "double": ("double", None),
}


def cast_to(c: Column, dtype: str, wrap: bool = False) -> Column:
    """P-CAST.  Default widens every integer width to long: a count over a
    hot key of a 10^12-row log does not fit 32 bits, and ANSI mode would
    raise where numpy silently wraps.  ``wrap`` reproduces the modular cast
    (``pmod(c, 2^bits)``).  Fractional input is truncated, like ``astype``.
    """
    spark_t, bits = DTYPE_MAP.get(dtype, (dtype, None))
    if wrap and bits:
        return F.pmod(c.cast("long"), F.lit(1 << bits)).cast("long" if bits >= 32 else "int")
    if spark_t in ("int", "smallint", "long"):
        return c.cast("long")
    if spark_t == "float":
        # through double: the optimizer takes long -> float -> double for a mere
        # widening and would leave the rounding to float out
        return c.cast("double").cast("float")
    return c.cast(spark_t)


def fill_zero(c: Column) -> Column:
    """P-FILL0."""
    return F.coalesce(c, F.lit(0))


def impute_matrix(df: DataFrame, columns, fit_on: DataFrame | None = None) -> DataFrame:
    """P-IMPALL: mean-impute several columns; statistics from ``fit_on``
    (the slice passed in), one pass computing every mean at once."""
    src = fit_on if fit_on is not None else df
    # one struct in one column, so its plan runs once for all columns
    means = src.select(F.struct(*[F.avg(F.col(c)).alias(c) for c in columns]).alias("m")).scalar()
    out = df.withColumn("__means", means)
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col("__means").getField(c)) for c in columns}).drop("__means")


def hard_label(p: Column, threshold: float = S.HARD_LABEL_THRESHOLD) -> Column:
    """P-THRESH: probability -> 0/1."""
    return (p > F.lit(threshold)).cast("int")


def overwrite_unlabelled(label: Column, is_unlabelled: Column, value: Column) -> Column:
    """P-OVER: replace the label on unlabelled rows only."""
    return F.when(is_unlabelled, value).otherwise(label)


def with_constant(df: DataFrame, name: str, value, dtype: str) -> DataFrame:
    """P-CONST."""
    return df.withColumn(name, F.lit(value).cast(dtype))


def categorical_index(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """P-CAT: frequency-ordered index of a categorical column (most frequent
    value = 0, ties by value), same order as ``StringIndexer``'s default.

    The per-value counts are indexed by a range sort (``assign_row_id``), so no
    task holds them all, and broadcast only when they are counted to be few; AQE
    splits the shuffle join of a column with more.
    """
    from clickforge.sources.clicks import assign_row_id
    name = name or f"{column}_idx"
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("__cnt"))
    index = assign_row_id(counts, [F.desc("__cnt"), F.col(column)], name).select(column, name)
    small = index.count() <= S.MAX_BROADCAST_ROWS
    return df.join(F.broadcast(index) if small else index, column, "left")
