"""Compile a list of FeatureSpecs into one DataFrame plan.

Specs computing the same thing are computed once and aliased (``dedup``);
specs sharing a key set form a *family*.  There is one plan, whatever the
input's size:

* families sharing a key column share one hash repartition of the rows by it,
  and every feature is a window expression over that partitioning;
* a value of the column with more than ``hot_rows`` rows (a *hot* value) would
  put them all into one task.  Hot values are looked for before each
  repartition (at most n / hot_rows of them exist, so the table of them has a
  proven bound); their rows are dealt by row range in the main path, and get
  their features from side tables: families with more keys are windows over
  the next key column, in which most hot rows are cold; only keys that are hot
  as a whole go through chunks (``operators.ordered.key_family``).  An input
  of at most ``hot_rows`` rows has no hot value, so nothing is looked for;
* every repartition of rows has a partition for each TASK_ROWS rows, so that what
  a task sorts does not grow with the log;
* aggregate families whose group table is provably small are hash-aggregated
  and broadcast instead.

Null policies run last; the imputation mean of a group feature is taken
row-weighted from the group table (sum of n * value / sum of n) in one
scalar subquery, so the feature plan is not re-run for it.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge import schema as S
from clickforge.functions.policy import cast_to
from clickforge.functions.scalar import epoch_seconds
from clickforge.operators.aggregate import agg_expr, hot_group_stats
from clickforge.operators.ordered import DEFAULT_CHUNK_ROWS, _attach_stats, _feature_value, key_family, no_group_value
from clickforge.plans.specs import AGG_OPS, ORDERED_OPS, FeatureSpec, dedup, families


def build_features(df: DataFrame, specs: list[FeatureSpec], **kwargs) -> DataFrame:
    """Same rows in and out, one new column per spec name (see ``_build``)."""
    try:
        return _build(df, specs, **kwargs)
    finally:
        _STATE.cache = None


def _build(df: DataFrame, specs: list[FeatureSpec], *, chunk_rows: int = DEFAULT_CHUNK_ROWS,
           hot_rows: int | None = None, wrap: bool = False, order: str = "row_id", epoch: str = "epoch",
           fit_on: DataFrame | None = None, keep_columns: bool = True,
           n_rows: int | None = None, max_broadcast_rows: int = S.MAX_BROADCAST_ROWS,
           cache_root: str | None = None, input_tag: str | None = None,
           cache_parts: list[DataFrame] | None = None) -> DataFrame:
    """Same rows in and out, one new column per spec name.

    ``fit_on``: rows the group statistics are computed from (default: all
    rows, train and test together, as the reference does).  Ordered features
    always run over ``df``.
    ``n_rows``: row count of ``df``; counted (one metadata-cheap action) when
    not given.
    ``hot_rows``: rows that one task may take for one key; default
    ``max(chunk_rows, n / MAX_HOT_KEYS)``, so that at most MAX_HOT_KEYS keys
    are hot.  ``chunk_rows``: row ids of a chunk of a hot key.
    ``max_broadcast_rows``: a group table is broadcast only if its proven
    bound (``group_bound``) is at most this; 0 broadcasts none.
    ``cache_root``: folder of the group-table cache (S-FCACHE).  Each
    aggregate family's group table is read from ``cache_root`` when a table
    for the same keys, aggregates, ``input_tag`` (required), input files and
    plan over them (``fit_on``'s, if given) was written before, and computed
    and written once otherwise.  ``cache_parts``: the ranges that make up the
    input (a file set per day, say).  What is written is then one mergeable
    state per range (``operators.states``), so a new range adds only its rows.
    """
    if cache_root and not input_tag:
        raise ValueError("cache_root needs an input_tag that names the input")
    uniq, aliases = dedup(specs)
    if any(s.op in ("next", "prev") for s in uniq) and epoch not in df.columns:
        df = df.withColumn(epoch, epoch_seconds("click_time", df.schema["click_time"].dataType))
    src = fit_on if fit_on is not None else df
    if n_rows is None:
        n_rows = df.count()
    if hot_rows is None:
        hot_rows = max(chunk_rows, -(-n_rows // S.MAX_HOT_KEYS))
    if cache_root:
        parts = [(p, [input_tag, *_source_id(p)]) for p in cache_parts] if cache_parts else None
        _STATE.cache = (cache_root, None if parts else [input_tag, *_source_id(src)], parts)
    else:
        _STATE.cache = None
    n_parts = _small_partitions(df) if n_rows <= chunk_rows else None
    n_tasks = _task_partitions(df, n_rows)
    # at most n / hot_rows keys are hot; more than that are only broadcast if
    # Spark finds their table small
    bring = F.broadcast if n_rows // hot_rows <= S.MAX_HOT_KEYS else lambda t: t

    # families that are attached from a group table: small ones by broadcast, those
    # of a cache or of other rows by the hot / cold split join
    fams = families(uniq)
    tables, small, by_row = {}, [], []
    for keys, fam in list(fams.items()):
        aggs = [s for s in fam if s.op in AGG_OPS]
        # the bound of a group table is that of the rows it is built from
        bounded = group_bound(keys, n_rows if fit_on is None else None) <= max_broadcast_rows
        if not aggs or not (bounded or fit_on is not None or cache_root):
            continue
        tables[keys] = (_group_table(src, keys, aggs, n_parts=n_parts), "__n")
        if bounded:
            small.append(keys)
        else:
            by_row.append(_attach_stats(df, keys, tables[keys][0], [s.name for s in aggs], "__n", hot_rows, order))
        fams[keys] = [s for s in fam if s.op in ORDERED_OPS]

    out, hot_flag, pieces = df, {}, []
    for i, (col, members) in enumerate(_prefix_groups({k: v for k, v in fams.items() if v})):
        hot, any_hot = _hot_values(df, [col], hot_rows) if n_rows > hot_rows else (None, False)
        salt = None
        if any_hot:
            salt, flag = f"__salt{i}", f"__hot{i}"
            marks = hot if hot is not None else df.select(col).limit(0)
            out = out.join(bring(marks.withColumn(flag, F.lit(True))), [col], "left")
            # hot rows, and those without a key, are dealt by row range; cold keys stay whole
            dealt = F.col(col).isNull() | F.col(flag).isNotNull()
            out = out.withColumn(salt, F.when(dealt, F.expr(f"`{order}` div {int(chunk_rows)}") + 1).otherwise(F.lit(0).cast("long")))
            out = out.repartition(n_tasks, col, salt)
            hot_flag |= {s.name: flag for _, fam in members for s in fam}
        else:
            out = out.repartition(n_tasks, col)
        if hot is not None:
            rows = _narrow(df, members, order, epoch).join(bring(hot), [col], "left_semi")
            pieces += _hot_pieces(rows, members, [col], chunk_rows=chunk_rows, hot_rows=hot_rows, order=order, epoch=epoch, n_tasks=n_tasks, bring=bring)
        out = _with_windows(out, members, order, epoch, salt)
        if salt:
            out = out.drop(salt)
    # Broadcast joins are map-side: placed after the windows so the window
    # sorts do not carry these columns.
    for keys in small:
        out = out.join(F.broadcast(tables[keys][0].drop("__n")), list(keys), "left")
    out = _assemble(out, by_row, order)
    hot_names = []
    if pieces:
        # a row's features come from pieces of their own: one row per hot row
        side = pieces[0]
        for p in pieces[1:]:
            side = side.unionByName(p, allowMissingColumns=True)
        hot_names = [c for c in side.columns if c != order]
        side = side.groupBy(order).agg(*[F.max(c).alias(SIDE + c) for c in hot_names])
        out = out.join(side, order, "left")

    means = _imputation_means(src, [s for s in uniq if s.null_policy == "mean"], order, epoch, tables)
    if means is not None:
        out = out.withColumn("__means", means)
    finals = []
    for s in uniq:
        c = F.col(s.name)
        if s.name in hot_flag:
            # without a side table only keyless rows were dealt
            c = F.when(F.col(hot_flag[s.name]).isNull(), c)
            if s.name in hot_names:
                c = F.coalesce(c, F.col(SIDE + s.name))
        if s.op in ORDERED_OPS:
            fill = no_group_value(s.op, dict(s.options), epoch)
            if fill is not None:
                c = F.coalesce(c, fill)
        if s.null_policy == "zero":
            c = F.coalesce(c, F.lit(0))
        elif s.null_policy == "mean":
            c = F.coalesce(c.cast("double"), F.col("__means").getField(s.name))
        finals.append(cast_to(c, s.out_dtype, wrap=wrap).alias(s.name))
    names = {s.name for s in uniq} | set(aliases)
    base_cols = [c for c in df.columns if c not in names] if keep_columns else [order]
    first = out.select(*base_cols, *finals)
    return first.select(*base_cols, *[s.name for s in uniq], *[F.col(k).alias(d) for d, k in aliases.items()])


SIDE = "__side_"


def _narrow(df: DataFrame, members, order: str, epoch: str) -> DataFrame:
    """The columns that the families read, so side tables never carry the log's others."""
    need = {order}
    for keys, fam in members:
        need |= {*keys, *(s.column for s in fam if s.column)}
        need |= {epoch for s in fam if s.op in ("next", "prev")}
    return df.select(*[c for c in df.columns if c in need])


def _hot_values(rows: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame | None, bool]:
    """(table of the key values with more than ``hot_rows`` rows, None without
    any; whether there are any, a missing value included).

    The table has at most n / hot_rows rows, and is written, so it is counted
    once and no later plan repeats the count.  Partial sums are taken before
    the rows' keys move."""
    from clickforge.session import shared_path
    spark = rows.sparkSession
    hot = rows.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)
    path = shared_path(spark, "hot-keys")
    hot.coalesce(1).write.parquet(path)
    hot = spark.read.schema(hot.schema).parquet(path)
    present = hot.dropna(subset=keys)
    return (None if present.isEmpty() else present), not hot.isEmpty()


def _hot_pieces(rows: DataFrame, members, prefix: list[str], *, chunk_rows: int, hot_rows: int, order: str,
                epoch: str, n_tasks: int, bring) -> list[DataFrame]:
    """Tables (order, features) of rows whose ``prefix`` values are hot, for
    families whose keys contain the prefix.  Every feature of a row is in one
    table.

    A family of exactly these keys is hot as a whole and goes through chunks.
    The others share a partitioning by the prefix and one more key column, in
    which what is cold takes plain windows, and what is still hot comes here
    again: each level moves only the rows hot in the one before."""
    pieces = []
    longer = {}
    for keys, fam in members:
        if set(keys) != set(prefix):
            longer[tuple(k for k in keys if k not in prefix)] = (keys, fam)
            continue
        aggs = [s for s in fam if s.op in AGG_OPS]
        ords = [(s.name, s.op, s.column, dict(s.options)) for s in fam if s.op in ORDERED_OPS]
        # one row per hot key
        stats = hot_group_stats(rows, list(keys), [(s.name, s.op, s.column) for s in aggs]) if aggs else None
        names = [s.name for s in aggs]
        if ords:
            pieces.append(key_family(rows, keys, names, ords, chunk_rows=chunk_rows, epoch=epoch, order=order, stats=stats, n_parts=n_tasks))
        else:
            pieces.append(rows.join(bring(stats), list(keys)).select(order, *names))
    for col, sub in _prefix_groups(longer):
        keys, inner = [*prefix, col], [m for _, m in sub]
        present = rows.filter(F.col(col).isNotNull())
        hot, _ = _hot_values(present, keys, hot_rows)
        cold = present if hot is None else present.join(bring(hot), keys, "left_anti")
        names = [s.name for _, fam in inner for s in fam]
        pieces.append(_with_windows(cold.repartition(n_tasks, *keys), inner, order, epoch).select(order, *names))
        if hot is not None:
            pieces += _hot_pieces(present.join(bring(hot), keys, "left_semi"), inner, keys, chunk_rows=chunk_rows,
                                  hot_rows=hot_rows, order=order, epoch=epoch, n_tasks=n_tasks, bring=bring)
    return pieces


def _prefix_groups(fams: dict) -> list[tuple[str | None, list]]:
    """Greedy grouping of families by a shared key column: the column that
    occurs in most remaining families becomes one hash partitioning, which
    satisfies every window partitioned by a superset of it."""
    left = dict(fams)
    groups = []
    while left:
        counts: dict[str, int] = {}
        for keys in left:
            for k in keys:
                counts[k] = counts.get(k, 0) + 1
        col = max(sorted(counts), key=lambda k: counts[k])
        members = [(k, v) for k, v in left.items() if col in k]
        for k, _ in members:
            del left[k]
        groups.append((col, members))
    return groups


_WINDOWS: dict = {}
FIRST = "__first_"


def _windows(keys, order, salt=None):
    """Window specs of one key set (built once: each costs JVM round trips).
    Aggregates use the whole frame of the *same* ordered spec, so all
    features of a key set share one sort and one Window operator."""
    key = (tuple(keys), order, salt)
    if key not in _WINDOWS:
        wo = Window.partitionBy(*keys, *([salt] if salt else [])).orderBy(order)
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        _WINDOWS[key] = (wo, wo.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing),
                         wo.rowsBetween(Window.unboundedPreceding, -1),
                         wo.rowsBetween(Window.unboundedPreceding, 0), present)
    return _WINDOWS[key]


def _with_windows(rows: DataFrame, members, order: str, epoch: str, salt: str | None = None) -> DataFrame:
    """``rows``, partitioned by columns that all families contain (and the
    salt), with every feature of the families as a window over their keys."""
    extra = [salt] if salt else []
    # a value's first row in its group, for distinct counts; same partitioning
    firsts = [F.when((F.row_number().over(Window.partitionBy(*s.keys, *extra, s.column).orderBy(order)) == 1)
                     & F.col(s.column).isNotNull(), 1).alias(FIRST + s.name)
              for _, fam in members for s in fam if s.op == "nunique"]
    if firsts:
        rows = rows.select("*", *firsts)
    rows = rows.select("*", *[_window_value(s, order, epoch, salt).alias(s.name) for _, fam in members for s in fam])
    return rows.drop(*[FIRST + s.name for _, fam in members for s in fam if s.op == "nunique"])


def _window_value(s: FeatureSpec, order: str, epoch: str, salt: str | None = None) -> Column:
    wo, w, before, upto, present = _windows(list(s.keys), order, salt)
    if s.op in AGG_OPS:
        c = F.col(s.column) if s.column else None
        if s.op == "count":
            v = F.count(F.lit(1)).over(w)
        elif s.op == "countnn":
            v = F.count(c).over(w)
        elif s.op == "nunique":
            v = F.count(FIRST + s.name).over(w)
        elif s.op == "mean":
            v = F.avg(c).over(w)
        elif s.op == "var":
            v = F.var_samp(c).over(w)
        else:
            n = F.count(c).over(w).cast("double")
            v = (F.when(n < 3, F.lit(None).cast("double")).when(F.var_pop(c).over(w) == 0, F.lit(0.0))
                  .otherwise(F.skewness(c).over(w) * F.sqrt(n * (n - 1)) / (n - 2)))
        return F.when(present, v)
    opts = dict(s.options)
    col = s.column
    v = _feature_value(
        s.name, s.op, col, opts, epoch,
        nxt=F.lead(epoch).over(wo) if s.op == "next" else None,
        prv=F.lag(epoch).over(wo) if s.op == "prev" else None,
        cnt_before=F.row_number().over(wo) - 1 if s.op == "cumcount" else None,
        sum_upto=F.when(F.col(col).isNotNull(), F.sum(col).over(upto)) if s.op == "cumsum" else None,
        sum_before=F.sum(col).over(before) if s.op == "expmean" else None,
        n_before=F.count(col).over(before) if s.op == "expmean" else None)
    return F.when(present, v)


# (root, input tag and identity) while a cached build runs, per thread so concurrent
# builds never see each other's cache.
_STATE = threading.local()


def _group_table(df: DataFrame, keys, fam, count_name: str = "__n", n_parts: int | None = None) -> DataFrame:
    """Group table of a family: one row per non-null key, with the row
    count (used by the row-weighted imputation mean) and every aggregate.
    Built once and shared by the join and the imputation fit, so Spark
    reuses its shuffle.  Under a cache root it is a written table.

    ``n_parts`` (small inputs only): shuffle the rows by the keys into that
    many partitions first, so the aggregate (distinct counts included) runs
    in one exchange of a size fitted to the input instead of the session's
    default partition count; large inputs keep partial aggregation."""
    keyed = df.filter(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    if n_parts:
        keyed = keyed.repartition(n_parts, *keys)
    table = lambda: keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name),
                                             *[agg_expr(s.op, s.column).alias(s.name) for s in fam])
    cache = getattr(_STATE, "cache", None)
    if cache is None:
        return table()
    from clickforge.operators import states
    root, source, parts = cache
    what = [list(keys), count_name, [(s.name, s.op, s.column) for s in fam]]
    if parts is None:
        return _kept(root, "groups", [what, source], table)
    moments = [_kept(root, "moments", [list(keys), states.moment_columns(fam), ident],
                     lambda p=p: states.moments(p, keys, states.moment_columns(fam))) for p, ident in parts]
    values = {c: [_kept(root, "values", [list(keys), c, ident], lambda p=p, c=c: states.distinct_values(p, keys, c)) for p, ident in parts]
              for c in states.distinct_columns(fam)}
    return states.group_table(moments, values, keys, fam, count_name)


def _kept(root: str, kind: str, what: list, make) -> DataFrame:
    """The table that stands for ``what`` under ``root``, made and written if it is not there."""
    import hashlib
    import json
    from clickforge.sources.store import _exists
    path = f"{root.rstrip('/')}/{kind}-{hashlib.sha1(json.dumps(what).encode()).hexdigest()[:16]}"
    made = make()
    if not _exists(made.sparkSession, path):
        # what is there without a success mark is the rest of a failed write
        made.write.mode("overwrite").parquet(path)
    return made.sparkSession.read.schema(made.schema).parquet(path)


def _source_id(src: DataFrame) -> list:
    """What group tables are computed from: the files with their lengths and
    times (a file rewritten in place is another input), the columns' types and
    the normalised plan over them (filters and projections)."""
    from clickforge.sources.store import file_stamps
    plan = src._jdf.queryExecution().optimizedPlan().canonicalized().toString()
    return [file_stamps(src.sparkSession, sorted(src.inputFiles())), src.schema.simpleString(), plan]


def group_bound(keys, n_rows: int | None) -> int:
    """Proven upper bound of a group table's rows: the key columns' domain
    product, and never more than the input's row count."""
    dom = S.domain_rows(keys)
    bounds = [b for b in (dom, n_rows) if b is not None]
    return min(bounds) if bounds else 1 << 62


def _small_partitions(df: DataFrame) -> int:
    """Partition count for the window plan's shuffles.  Explicit, because
    window stages are CPU-bound (sorts) and AQE would coalesce a small
    shuffle into a few tasks, while the session default (200 unless the
    cluster says otherwise) is far too many for at most chunk_rows rows: two
    tasks per core, never more than the configured shuffle partitions."""
    spark = df.sparkSession
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                      2 * spark.sparkContext.defaultParallelism))


#: Rows that a task of the window plan takes on average.  A row is in up to some
#: twenty sorts, each of a few hundred bytes a row and a page of 64 MB at least.
TASK_ROWS = 1 << 17


def _task_partitions(df: DataFrame, n_rows: int) -> int:
    """Partition count of a shuffle whose rows are then sorted by many windows.
    AQE would size it by the shuffled bytes, a small part of what the sorts hold."""
    return max(_small_partitions(df), -(-n_rows // TASK_ROWS))


def _imputation_means(df: DataFrame, mean_specs, order: str, epoch: str,
                      stats_by_keys: dict | None = None) -> Column | None:
    """Row-weighted mean of every mean-imputed feature, as one struct.

    For a group feature the mean over rows is sum(n * value) / sum(n) over
    the groups with a value, so it is read off the group tables (one hash
    aggregate per key set, one summary row each), never off the feature
    plan.  The summary rows are merged into one row and returned as a
    single scalar subquery: the caller places it in one column, so Spark
    evaluates it once, alongside the feature stages."""
    if not mean_specs:
        return None
    rows = []
    for keys, fam in families(mean_specs).items():
        if not all(s.op in AGG_OPS for s in fam):
            raise ValueError("mean imputation is defined for group aggregates only")
        st, gn = (stats_by_keys or {}).get(keys, (None, None))
        if st is None:
            st, gn = _group_table(df, keys, fam), "__n"
        rows.append(st.agg(*[(F.sum(F.col(s.name).cast("double") * F.col(gn)) /
                              F.sum(F.when(F.col(s.name).isNotNull(), F.col(gn)))).alias(s.name)
                             for s in fam]))
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r, allowMissingColumns=True)
    names = [s.name for s in mean_specs]
    return u.agg(F.struct(*[F.max(n).alias(n) for n in names]).alias("m")).scalar()


def _assemble(out: DataFrame, tables: list[DataFrame], order: str) -> DataFrame:
    """Join every table of ``(row_id, features)`` to the rows.

    All joins are on the unique row id, so each table and the log move once,
    to the same hash partitioning, and no key is hot.  Every feature keeps its
    own type (counts and sums stay longs, exact beyond 2^53)."""
    for t in tables:
        out = out.join(t, order, "left")
    return out


def feature_schema(df: DataFrame, specs: list[FeatureSpec]) -> DataFrame:
    """An empty frame with the output schema of ``build_features`` (for
    manifests); runs nothing."""
    return build_features(df.limit(0), specs, n_rows=0)
