"""Categorical predictors for tree training (P-CAT, M-ASM): ids become codes of
a nominal attribute with at most ``max_bins`` values.

The commonest ids keep a code of their own; the others share codes by the order
of their target rate, which is the order in which a tree would split them.  The
last code is for missing and unseen ids.  Counting is one aggregation per
column; nothing runs in one task, and no table larger than its proven bound is
broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge import schema as S
from clickforge.session import shared_path


@dataclass(frozen=True)
class CategoryCodes:
    """Codes of one column: ``common`` (value, code) has fewer rows than bins,
    ``rare`` (value, code) the other known values or None."""

    column: str
    common: DataFrame
    rare: DataFrame | None
    n_rare: int
    n_codes: int

    @property
    def other(self) -> int:
        """Code of missing and unseen values."""
        return self.n_codes - 1


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_codes(df: DataFrame, column: str, label: str, max_bins: int = 32, rare_codes: int = 8) -> CategoryCodes:
    """Codes learnt from ``df``.  With fewer than ``max_bins`` distinct values all
    have their own code, in the order of values."""
    if not 0 < rare_codes < max_bins - 1:
        raise ValueError("rare_codes must leave room for common values and the code of unseen ones")
    stats = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("rate"))
    stats = _written(stats, "category-counts")
    known = stats.count()
    spark = df.sparkSession
    if known < max_bins:
        # fewer than max_bins values
        values = [r["value"] for r in stats.select("value").orderBy("value").collect()]
        rare, n_rare = None, 0
    else:
        # max_bins values at most
        values = [r["value"] for r in stats.orderBy(F.desc("n"), "value").limit(max_bins - 1 - rare_codes).collect()]
    kind = stats.schema["value"].dataType
    common = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"value {kind.simpleString()}, code int")
    if known >= max_bins:
        others = stats.join(F.broadcast(common), "value", "left_anti")
        # unlabelled values rank lowest
        rate = F.coalesce("rate", F.lit(-1.0))
        cuts = others.select(F.percentile_approx(rate, [i / rare_codes for i in range(1, rare_codes)], 10_000)).first()[0] or []
        code = F.lit(len(values))
        for c in cuts:
            code = code + F.when(rate > c, 1).otherwise(0)
        rare = _written(others.select("value", code.cast("int").alias("code")), "category-codes")
        n_rare = known - len(values)
    return CategoryCodes(column, common, rare, n_rare, len(values) + (rare_codes if rare is not None else 0) + 1)


def with_codes(df: DataFrame, codes: list[CategoryCodes]) -> DataFrame:
    """``df`` with every coded column replaced by its codes, marked as nominal,
    so the assembled vector tells the trees."""
    columns = df.columns
    for c in codes:
        value, mine = F.col(c.column), f"__code_{c.column}"
        named = lambda t, name: t.select(F.col("value").alias(c.column), F.col("code").alias(name))
        df = df.join(F.broadcast(named(c.common, mine)), c.column, "left")
        if c.rare is not None:
            rare = named(c.rare, mine + "_rare")
            if c.n_rare <= S.MAX_BROADCAST_ROWS:
                df = df.join(F.broadcast(rare), c.column, "left")
            else:
                # common values are found already; a salt keeps their rows, and those without a value, apart
                salt = F.when(F.col(mine).isNull() & value.isNotNull(), F.lit(0)).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)) + 1)
                df = df.withColumn("__salt", salt.cast("long")).join(rare.withColumn("__salt", F.lit(0).cast("long")), [c.column, "__salt"], "left").drop("__salt")
            code: Column = F.coalesce(F.col(mine), F.col(mine + "_rare"), F.lit(c.other))
        else:
            code = F.coalesce(F.col(mine), F.lit(c.other))
        meta = {"ml_attr": {"type": "nominal", "name": c.column, "num_vals": c.n_codes}}
        df = df.withColumn(c.column, code.cast("double")).drop(mine, mine + "_rare")
        df = df.select(*[F.col(x).alias(x, metadata=meta) if x == c.column else F.col(x) for x in columns])
    return df
