"""Plain-SQL statement of a FeatureSpec list, used as the DuckDB oracle.

Each spec becomes one window expression over the whole click view (the
textbook definition, no chunking, no fusion), so comparing it with
``build_features`` checks the Spark plan against an independent statement
of the same semantics.
"""

from __future__ import annotations

from clickforge import schema as S
from clickforge.plans.specs import FeatureSpec, dedup

FLOAT_TYPES = {"float", "float32"}
DOUBLE_TYPES = {"double", "float64"}


def _over(keys, ordered=False) -> str:
    part = ", ".join(keys)
    return f"OVER (PARTITION BY {part} ORDER BY row_id)" if ordered else f"OVER (PARTITION BY {part})"


def raw_expr(s: FeatureSpec) -> str:
    k = s.keys
    if s.op == "count":
        return f"count(*) {_over(k)}"
    if s.op == "countnn":
        return f"count({s.column}) {_over(k)}"
    if s.op == "nunique":
        return f"count(DISTINCT {s.column}) {_over(k)}"
    if s.op == "mean":
        return f"avg({s.column}) {_over(k)}"
    if s.op == "var":
        return f"var_samp({s.column}) {_over(k)}"
    if s.op == "skew":
        w = _over(k)
        return (f"CASE WHEN count({s.column}) {w} < 3 THEN NULL WHEN var_pop({s.column}) {w} = 0 THEN 0 "
                f"ELSE skewness({s.column}) {w} END")
    if s.op == "cumcount":
        return f"row_number() {_over(k, True)} - 1"
    if s.op == "next":
        nxt = f"lead(epoch) {_over(k, True)}"
        if s.option("fill", "sentinel") == "sentinel":
            nxt = f"coalesce({nxt}, {S.FILL_NEXT})"
        return f"{nxt} - epoch"
    if s.op == "prev":
        prv = f"lag(epoch) {_over(k, True)}"
        first = s.option("first", "null")
        if first == "zero":
            prv = f"coalesce({prv}, 0)"
        elif first == "sentinel":
            prv = f"coalesce({prv}, {S.FILL_NEXT})"
        return f"epoch - {prv}"
    if s.op == "cumsum":
        return (f"CASE WHEN {s.column} IS NULL THEN NULL ELSE sum({s.column}) OVER (PARTITION BY {', '.join(k)} "
                f"ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END")
    if s.op == "expmean":
        return (f"avg({s.column}) OVER (PARTITION BY {', '.join(k)} ORDER BY row_id "
                f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    raise ValueError(s.op)


def final_expr(s: FeatureSpec, wrap: bool = False) -> str:
    """Null policy + output type, rounded doubles for hashing."""
    c = s.name
    if s.null_policy == "zero":
        c = f"coalesce({c}, 0)"
    elif s.null_policy == "mean":
        c = f"coalesce(CAST({c} AS DOUBLE), avg(CAST({c} AS DOUBLE)) OVER ())"
    t = s.out_dtype
    if t in FLOAT_TYPES:
        return f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6)"
    if t in DOUBLE_TYPES:
        return f"round(CAST({c} AS DOUBLE), 6)"
    bits = {"uint8": 8, "uint16": 16, "uint32": 32}.get(t)
    if wrap and bits:
        return f"CAST(CAST({c} AS BIGINT) % {1 << bits} AS BIGINT)"
    return f"CAST(trunc({c}) AS BIGINT)" if s.op in ("mean", "var", "skew", "expmean") else f"CAST({c} AS BIGINT)"


def features_sql(specs: list[FeatureSpec], source: str = "clicks", wrap: bool = False) -> str:
    uniq, aliases = dedup(specs)
    inner = ",\n       ".join(f"{raw_expr(s)} AS {s.name}" for s in uniq)
    outer = [f"{final_expr(s, wrap)} AS {s.name}" for s in uniq]
    outer += [f"{final_expr(next(u for u in uniq if u.name == k), wrap)} AS {d}" for d, k in aliases.items()]
    return (f"SELECT row_id,\n       " + ",\n       ".join(outer) +
            f"\nFROM (SELECT row_id, epoch,\n       {inner}\nFROM {source})")
