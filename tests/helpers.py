"""pandas oracle for the feature ops (row order = row_id), used on small
hand-made frames."""

import numpy as np
import pandas as pd

FILL = 3_000_000_000


def pandas_feature(pdf: pd.DataFrame, op: str, keys, col=None, **opts) -> pd.Series:
    pdf = pdf.sort_values("row_id").reset_index(drop=True)
    g = pdf.groupby(list(keys), dropna=True, sort=False)
    if op == "count":
        v = g["row_id"].transform("size")
    elif op == "nunique":
        v = g[col].transform("nunique")
    elif op == "mean":
        v = g[col].transform("mean")
    elif op == "var":
        v = g[col].transform("var")
    elif op == "skew":
        v = g[col].transform("skew")
    elif op == "cumcount":
        v = g.cumcount()
    elif op == "next":
        v = g["epoch"].shift(-1)
        if opts.get("fill", "sentinel") == "sentinel":
            v = v.fillna(FILL)
        v = v - pdf["epoch"]
    elif op == "prev":
        p = g["epoch"].shift(1)
        first = opts.get("first", "null")
        if first == "zero":
            p = p.fillna(0)
        elif first == "sentinel":
            p = p.fillna(FILL)
        v = pdf["epoch"] - p
    elif op == "cumsum":
        v = g[col].cumsum()
    elif op == "expmean":
        # mean of the key's earlier non-null values (the reference's
        # (cumsum - y) / cumcount when no value is null)
        val = pdf[col].astype("float64")
        filled = val.fillna(0.0)
        present = val.notna().astype("float64")
        s = filled.groupby([pdf[k] for k in keys], dropna=True).cumsum() - filled
        n = present.groupby([pdf[k] for k in keys], dropna=True).cumsum() - present
        v = s / n.replace(0, np.nan)
    else:
        raise ValueError(op)
    v = pd.Series(np.asarray(v, dtype="float64"), index=pdf.index)
    # rows with a null key: no group
    has_null = pdf[list(keys)].isna().any(axis=1)
    if op == "next" and opts.get("fill", "sentinel") == "sentinel":
        v[has_null] = FILL - pdf.loc[has_null, "epoch"]
    elif op == "prev" and opts.get("first") == "zero":
        v[has_null] = pdf.loc[has_null, "epoch"]
    elif op == "prev" and opts.get("first") == "sentinel":
        v[has_null] = pdf.loc[has_null, "epoch"] - FILL
    else:
        v[has_null] = np.nan
    return pd.Series(v.values, index=pdf["row_id"].values)


def as_float_dict(pdf, col):
    return {int(r): (None if pd.isna(x) else float(x)) for r, x in zip(pdf["row_id"], pdf[col])}


def close(a, b, tol=1e-6):
    if a is None or (isinstance(a, float) and np.isnan(a)):
        return b is None or (isinstance(b, float) and np.isnan(b))
    if b is None:
        return False
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
