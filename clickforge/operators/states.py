"""Group statistics as mergeable states, one set per range of rows (S-FCACHE
by range): a new day adds the states of its own rows, and nothing older is
aggregated again.

A state of a range has one row per key: row count and, per column, the count,
mean, second and third central moments, least and largest of its values.  Sets
of distinct values are tables of (keys, value).  Merging shifts the moments to
the common mean, so it does not lose precision as sums of powers do.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PARTS = ("n", "mean", "m2", "m3", "low", "high")


def moment_columns(specs) -> list[str]:
    return sorted({s.column for s in specs if s.op in ("countnn", "mean", "var", "skew")})


def distinct_columns(specs) -> list[str]:
    return sorted({s.column for s in specs if s.op == "nunique"})


def _keyed(df: DataFrame, keys) -> DataFrame:
    return df.dropna(subset=list(keys))


def moments(df: DataFrame, keys, columns: list[str]) -> DataFrame:
    """The state of the rows of ``df``: keys, __rows and, per column c, __n_c, __mean_c, ..."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for c in columns:
        v = F.col(c).cast("double")
        n, m2 = F.count(v), F.var_pop(v) * F.count(v)
        m3 = F.coalesce(F.try_divide(F.skewness(v) * F.pow(m2, F.lit(1.5)), F.sqrt(n.cast("double"))), F.lit(0.0))
        for part, e in zip(_PARTS, (n, F.avg(v), m2, F.when(F.isnan(m3), 0.0).otherwise(m3), F.min(v), F.max(v))):
            aggs.append(e.alias(f"__{part}_{c}"))
    return _keyed(df, keys).groupBy(*keys).agg(*aggs)


def distinct_values(df: DataFrame, keys, column: str) -> DataFrame:
    """The distinct (keys, value) of ``df``."""
    return _keyed(df, keys).select(*keys, F.col(column).alias("__value")).dropna(subset=["__value"]).distinct()


def merged_moments(states: list[DataFrame], keys, columns: list[str]) -> DataFrame:
    """One state of several ranges' states.  A key has one row per range here,
    so its window holds as many rows as there are ranges."""
    u = functools.reduce(DataFrame.unionByName, states)
    w = Window.partitionBy(*keys)
    shift = {}
    for c in columns:
        n, mean = F.col(f"__n_{c}"), F.col(f"__mean_{c}")
        shift[f"__common_{c}"] = F.try_divide(F.sum(n * mean).over(w), F.sum(n).over(w).cast("double"))
    u = u.withColumns(shift) if shift else u
    aggs: list[Column] = [F.sum("__rows").alias("__rows")]
    for c in columns:
        n, m2, m3 = (F.col(f"__{p}_{c}") for p in ("n", "m2", "m3"))
        d = F.col(f"__mean_{c}") - F.col(f"__common_{c}")
        aggs += [F.sum(n).alias(f"__n_{c}"), F.max(f"__common_{c}").alias(f"__mean_{c}"), F.sum(m2 + n * d * d).alias(f"__m2_{c}"),
                 F.sum(m3 + 3 * d * m2 + n * d * d * d).alias(f"__m3_{c}"), F.min(f"__low_{c}").alias(f"__low_{c}"),
                 F.max(f"__high_{c}").alias(f"__high_{c}")]
    return u.groupBy(*keys).agg(*aggs)


def _value(s) -> Column:
    """A feature of a merged state, as the one-pass aggregate has it."""
    if s.op == "count":
        return F.col("__rows")
    n, mean, m2, m3, low, high = (F.col(f"__{p}_{s.column}") for p in _PARTS)
    if s.op == "countnn":
        return n
    if s.op == "mean":
        return mean
    constant, d = low == high, n.cast("double")
    if s.op == "var":
        return F.when(n >= 2, F.when(constant, 0.0).otherwise(m2 / F.greatest(d - 1, F.lit(1.0))))
    g1 = F.try_divide(F.sqrt(d) * m3, F.pow(m2, F.lit(1.5)))
    return F.when(n >= 3, F.when(constant, 0.0).otherwise(g1 * F.sqrt(d * (d - 1)) / F.greatest(d - 2, F.lit(1.0))))


def group_table(states: list[DataFrame], values: dict[str, list[DataFrame]], keys, specs, count_name: str = "__n") -> DataFrame:
    """The group table (keys, ``count_name``, features) of ranges' states;
    ``values``: the distinct values of each range, by column."""
    keys = list(keys)
    merged = merged_moments(states, keys, moment_columns(specs))
    plain = [s for s in specs if s.op != "nunique"]
    out = merged.select(*keys, F.col("__rows").alias(count_name), *[_value(s).alias(s.name) for s in plain])
    for c in distinct_columns(specs):
        same = functools.reduce(DataFrame.unionByName, values[c]).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("__distinct"))
        out = out.join(same, keys, "left")
        out = out.select(*[x for x in out.columns if x != "__distinct"],
                         *[F.coalesce("__distinct", F.lit(0)).alias(s.name) for s in specs if s.op == "nunique" and s.column == c])
    return out
