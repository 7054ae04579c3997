"""Ordered (per-key, row-ordered) features of hot keys, and the joins that
bring group tables back to rows.

A plain ``Window.partitionBy(keys).orderBy(row_id)`` puts every row of a key
into one task.  Click logs have keys (gateway ips, popular devices) that can
hold a third of all rows, so hot keys go another way:

1. rows are cut into *chunks* of ``chunk_rows`` consecutive row ids and
   hash-partitioned by ``(keys, chunk)``: no group is larger than
   ``chunk_rows`` rows, whatever the key skew;
2. inside a chunk, plain windows give the local running count, next and
   previous row, running sums;
3. a *chunk table* (one row per key and chunk, read from the same shuffle)
   carries per-chunk counts, first / last epoch and sums; a window over the
   chunk table per key turns them into offsets, the next chunk's first epoch
   and the previous chunk's last epoch.  A key holding a third of n rows has
   n / (3 * chunk_rows) chunk rows, so this window stays small;
4. group aggregates are joined to the chunk table on the key, then the chunk
   table is joined to the rows on ``(keys, chunk)``, which reuses the rows'
   partitioning and is free of key skew.

The result is ``row_id`` plus the family's feature columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge import schema as S

#: A key's rows that one task may sort, and row ids of a chunk.
DEFAULT_CHUNK_ROWS = 1 << 17
CHUNK = "__chunk"


def _nsum(a: Column, b: Column) -> Column:
    """a + b where a null side counts as 0, but null if both are null."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def _all_keys_present(keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def key_family(rows: DataFrame, keys, aggregates, ordered, chunk_rows: int = DEFAULT_CHUNK_ROWS,
               epoch: str = "epoch", order: str = "row_id", stats: DataFrame | None = None,
               n_parts: int | None = None) -> DataFrame:
    """Ordered features of one key family through chunks.

    ``ordered``:    list of (name, op, column, options-dict) with op in
                    cumcount | next | prev | cumsum | expmean.
    ``aggregates``: names of the columns of ``stats``, a table of one row per
                    key, that go along.
    ``n_parts``:    partitions of the chunks (default: left to the session).
    Returns ``order`` + every feature name, one row per row with all keys
    present (rows with a null key form no group and are left out).
    """
    keys = list(keys)
    need_epoch = any(op in ("next", "prev") for _, op, _, _ in ordered)
    sum_cols = sorted({c for _, op, c, _ in ordered if op in ("cumsum", "expmean")})
    cols = [order, *keys] + ([epoch] if need_epoch else []) + [c for c in sum_cols if c not in keys]
    cols = list(dict.fromkeys(cols))

    # Rows with a null key form no group (as in a pandas group-by); they are
    # left out here and get the no-group value when joined back on row_id.
    # The explicit not-null filters keep the branches below identical, so
    # the (keys, chunk) shuffle is computed once and reused.
    parts = (rows.select(*cols)
             .filter(_all_keys_present(keys + [order]))
             .withColumn(CHUNK, F.expr(f"`{order}` div {int(chunk_rows)}"))
             .filter(F.col(CHUNK).isNotNull())   # stated, so the join cannot add it to one branch only
             .repartition(*([n_parts] if n_parts else []), *keys, CHUNK))

    # -- 2. local windows inside (keys, chunk), chunk stats alongside --------
    wl = Window.partitionBy(*keys, CHUNK).orderBy(order)
    whole = wl.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = wl.rowsBetween(Window.unboundedPreceding, -1)
    upto = wl.rowsBetween(Window.unboundedPreceding, 0)
    local_cols = [F.col(order), *[F.col(k) for k in keys], F.col(CHUNK),
                  F.row_number().over(wl).alias("__rn"), F.count(F.lit(1)).over(whole).alias("__n")]
    if need_epoch:
        local_cols += [F.col(epoch), F.lead(epoch).over(wl).alias("__lead"), F.lag(epoch).over(wl).alias("__lag"),
                       F.first(epoch).over(whole).alias("__first"), F.last(epoch).over(whole).alias("__last")]
    for c in sum_cols:
        local_cols += [F.col(c).alias(f"__v_{c}"), F.sum(c).over(upto).alias(f"__lsum_{c}"),
                       F.sum(c).over(before).alias(f"__lsumb_{c}"),
                       F.count(c).over(before).alias(f"__lcntb_{c}"),
                       F.sum(c).over(whole).alias(f"__csum_{c}"),
                       F.count(c).over(whole).alias(f"__ccnt_{c}")]
    local = parts.select(*local_cols)

    # -- 3. chunk table: one row per (keys, chunk), windows over the key -----
    chunks = local.filter(F.col("__rn") == 1)
    wk = Window.partitionBy(*keys).orderBy(CHUNK)
    prior = wk.rowsBetween(Window.unboundedPreceding, -1)
    ct_cols = [*[F.col(k) for k in keys], F.col(CHUNK), F.sum("__n").over(prior).alias("__off_n")]
    if need_epoch:
        ct_cols += [F.lead("__first").over(wk).alias("__next_first"),
                    F.lag("__last").over(wk).alias("__prev_last")]
    for c in sum_cols:
        ct_cols += [F.sum(f"__csum_{c}").over(prior).alias(f"__off_sum_{c}"),
                    F.sum(f"__ccnt_{c}").over(prior).alias(f"__off_cnt_{c}")]
    ct = chunks.select(*ct_cols)

    # -- 4. group aggregates joined to the chunk table on the key ------------
    if aggregates:
        ct = ct.join(stats.select(*keys, *aggregates), keys, "left")

    # Chunk table back to rows on (keys, chunk): no key skew on this join.
    joined = local.join(ct, keys + [CHUNK], "inner")

    out = [F.col(order)]
    for name, op, col, opts in ordered:
        v = _feature_value(
            name, op, col, opts, epoch,
            nxt=F.coalesce(F.col("__lead"), F.col("__next_first")) if op == "next" else None,
            prv=F.coalesce(F.col("__lag"), F.col("__prev_last")) if op == "prev" else None,
            cnt_before=F.coalesce(F.col("__off_n"), F.lit(0)) + F.col("__rn") - 1 if op == "cumcount" else None,
            # like pandas: null where the value itself is null
            sum_upto=F.when(F.col(f"__v_{col}").isNotNull(), _nsum(F.col(f"__off_sum_{col}"), F.col(f"__lsum_{col}")))
            if op == "cumsum" else None,
            sum_before=_nsum(F.col(f"__off_sum_{col}"), F.col(f"__lsumb_{col}")) if op == "expmean" else None,
            n_before=F.coalesce(F.col(f"__off_cnt_{col}"), F.lit(0)) + F.col(f"__lcntb_{col}") if op == "expmean" else None)
        out.append(v.alias(name))
    return joined.select(*out, *aggregates)


def _feature_value(name, op, col, opts, epoch, nxt, prv, cnt_before, sum_upto, sum_before, n_before):
    """Final value of an ordered feature from its parts (shared by both plans)."""
    if op == "cumcount":
        return cnt_before
    if op == "next":
        fill = opts.get("fill", "sentinel")
        return (F.coalesce(nxt, F.lit(S.FILL_NEXT)) if fill == "sentinel" else nxt) - F.col(epoch)
    if op == "prev":
        first = opts.get("first", "null")
        if first == "zero":
            prv = F.coalesce(prv, F.lit(0))
        elif first == "sentinel":
            prv = F.coalesce(prv, F.lit(S.FILL_NEXT))
        return F.col(epoch) - prv
    if op == "cumsum":
        return sum_upto
    if op == "expmean":
        return F.try_divide(sum_before.cast("double"), n_before.cast("double"))
    raise ValueError(op)


def _attach_stats(rows: DataFrame, keys, stats: DataFrame, names, group_count: str | None,
                  hot_rows: int, order: str) -> DataFrame:
    """Group table back to rows, with hot keys split off.

    A key with more than ``hot_rows`` rows is *hot*.  There are at most
    n / hot_rows <= MAX_HOT_KEYS hot keys (a proven bound that does not grow
    with the log), so their group rows are broadcast and joined map-side;
    only cold rows, whose groups are all at most ``hot_rows`` rows, go
    through the shuffle join on the key.
    Without a group count (caller-supplied stats) the plain shuffle join is
    used and AQE's skew-join splitting covers hot keys.
    """
    keys = list(keys)
    narrow = rows.select(order, *keys).filter(_all_keys_present(keys + [order]))
    feats = stats.select(*keys, *names)
    if group_count is None:
        return narrow.join(feats, keys, "inner").select(order, *names)
    hot = stats.filter(F.col(group_count) > F.lit(hot_rows)).select(
        *keys, *names, F.lit(True).alias("__hot"))
    tagged = narrow.join(F.broadcast(hot), keys, "left")
    hot_part = tagged.filter(F.col("__hot").isNotNull()).select(order, *names)
    cold_keys = tagged.filter(F.col("__hot").isNull()).select(order, *keys)
    cold = stats.filter(F.col(group_count) <= F.lit(hot_rows)).select(*keys, *names)
    cold_part = cold_keys.join(cold, keys, "inner").select(order, *names)
    return hot_part.unionByName(cold_part)


def no_group_value(op: str, opts: dict, epoch: str = "epoch") -> Column | None:
    """Value of an ordered feature on a row whose key is null (no group)."""
    if op == "next" and opts.get("fill", "sentinel") == "sentinel":
        return F.lit(S.FILL_NEXT) - F.col(epoch)
    if op == "prev" and opts.get("first", "null") == "zero":
        return F.col(epoch)
    if op == "prev" and opts.get("first") == "sentinel":
        return F.col(epoch) - F.lit(S.FILL_NEXT)
    return None


def global_lag(df: DataFrame, column: str, name: str | None = None, order: str | list = "row_id") -> DataFrame:
    """W-GLAG: the previous row's value over the whole table, in any order
    (``order``: a column, or a list of columns and expressions).

    The rows are range-partitioned and sorted once and kept as a reliable
    checkpoint, so the input runs once and both uses see the same partitions.
    Inside a partition the column is shifted batch by batch; a partition's first
    row takes the last value of the one before (one row per partition).
    """
    from clickforge.session import cut_lineage
    name = name or f"{column}_shift"
    by = [order] if isinstance(order, str) else list(order)
    rows = cut_lineage(df.repartitionByRange(*by).sortWithinPartitions(*by))
    place = rows.withColumn("__pid", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    last = place.groupBy("__pid").agg(F.max_by(F.struct(F.col(column).alias("v")), "__at").alias("last"))
    carried = last.select("__pid", F.lag("last").over(Window.orderBy("__pid")).alias("__carried"))
    kind = rows.schema[column].dataType
    at = place.columns.index(column)

    def shift(batches):
        import pyarrow as pa
        tail = None
        for b in batches:
            if b.num_rows:
                v = b.column(at)
                tail = pa.nulls(1, v.type) if tail is None else tail
                before = pa.concat_arrays([tail, v.slice(0, len(v) - 1)])
                tail = v.slice(len(v) - 1)
                yield pa.RecordBatch.from_arrays([*b.columns, before], [*b.schema.names, "__before"])

    out = place.mapInArrow(shift, T.StructType([*place.schema.fields, T.StructField("__before", kind)]))
    first = F.col("__at") == F.shiftleft(F.col("__pid").cast("long"), 33)
    out = out.join(F.broadcast(carried), "__pid", "left")
    return out.select(*df.columns, F.when(first, F.col("__carried.v")).otherwise(F.col("__before")).alias(name))
