"""Features as data.

A ``FeatureSpec`` says *what* to compute for every row: an operation, the
key columns that form the group, the counted / averaged column, the output
name, the output type and the null policy.  ``plans.features`` compiles a
list of specs into one DataFrame plan, fusing specs that share keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Group aggregates attached back to every row of the group.
AGG_OPS = ("count", "countnn", "nunique", "mean", "var", "skew")
# Ordered features over the rows of a key in row order.
ORDERED_OPS = ("cumcount", "next", "prev", "cumsum", "expmean")
OPS = AGG_OPS + ORDERED_OPS

# Default output types per op (the reference's helper defaults).
DEFAULT_DTYPE = {
    "count": "int", "countnn": "int", "nunique": "int", "cumcount": "int",
    "mean": "float", "var": "float", "skew": "float",
    "next": "float", "prev": "float", "cumsum": "double", "expmean": "double",
}
# Default null policy per op: counts are never null after a left join of a
# non-null key, mean / variance are mean-imputed, gaps keep their filler.
DEFAULT_NULLS = {
    "count": "zero", "countnn": "zero", "nunique": "zero", "cumcount": "zero",
    "mean": "mean", "var": "mean", "skew": "keep",
    "next": "keep", "prev": "keep", "cumsum": "keep", "expmean": "zero",
}


@dataclass(frozen=True)
class FeatureSpec:
    op: str
    keys: tuple[str, ...]
    column: str | None = None
    name: str | None = None
    dtype: str | None = None          # spark SQL type name, or "uint8"/"uint16" (wrap)
    nulls: str | None = None          # keep | zero | mean
    options: tuple = field(default_factory=tuple)   # (("first", "zero"),) etc.

    def __post_init__(self):
        if self.op not in OPS:
            raise ValueError(f"unknown op {self.op!r}")
        object.__setattr__(self, "keys", tuple(self.keys))
        if self.name is None:
            col = f"_{self.column}" if self.column else ""
            object.__setattr__(self, "name", "_".join(self.keys) + f"_{self.op}{col}")

    @property
    def out_dtype(self) -> str:
        return self.dtype or DEFAULT_DTYPE[self.op]

    @property
    def null_policy(self) -> str:
        return self.nulls or DEFAULT_NULLS[self.op]

    def option(self, key, default=None):
        return dict(self.options).get(key, default)

    @property
    def signature(self):
        """What is computed, ignoring the output name (for dedup)."""
        col = None if self.op in ("count", "cumcount", "next", "prev") else self.column
        return (self.op, self.keys, col, self.out_dtype, self.null_policy, self.options)


def dedup(specs: list[FeatureSpec]) -> tuple[list[FeatureSpec], dict[str, str]]:
    """Drop specs that compute the same thing under another name.

    Returns the unique specs and an alias map ``{duplicate_name: kept_name}``.
    A later spec reusing an earlier *name* replaces it (the reference
    overwrites the column).
    """
    by_name: dict[str, FeatureSpec] = {}
    for s in specs:
        by_name[s.name] = s
    kept: dict[tuple, FeatureSpec] = {}
    aliases: dict[str, str] = {}
    for s in by_name.values():
        sig = s.signature
        if sig in kept:
            aliases[s.name] = kept[sig].name
        else:
            kept[sig] = s
    return list(kept.values()), aliases


def families(specs: list[FeatureSpec]) -> dict[tuple[str, ...], list[FeatureSpec]]:
    """Group specs by key set (order-insensitive) so each key set costs one
    group-by / one chunked window pass."""
    out: dict[tuple[str, ...], list[FeatureSpec]] = {}
    for s in specs:
        out.setdefault(tuple(sorted(s.keys)), []).append(s)
    return out


def _s(op, keys, column=None, name=None, dtype=None, nulls=None, **opts):
    return FeatureSpec(op, tuple(keys), column, name, dtype, nulls, tuple(sorted(opts.items())))


# ---------------------------------------------------------------------------
# Catalogues: the feature sets of the main script versions.
# ---------------------------------------------------------------------------
def catalogue_v27() -> list[FeatureSpec]:
    """The 29 engineered features of the best script (plus app, device, os,
    channel, hour as raw predictors)."""
    return [
        _s("nunique", ["ip"], "channel", "X0", "uint8"),
        _s("cumcount", ["ip", "device", "os"], "app", "X1"),
        _s("nunique", ["ip", "day"], "hour", "X2", "uint8"),
        _s("nunique", ["ip"], "app", "X3", "uint8"),
        _s("nunique", ["ip", "app"], "os", "X4", "uint8"),
        _s("nunique", ["ip"], "device", "X5", "uint16"),
        _s("nunique", ["app"], "channel", "X6"),
        _s("cumcount", ["ip"], "os", "X7"),
        _s("nunique", ["ip", "device", "os"], "app", "X8"),
        _s("count", ["ip", "day", "hour"], None, "ip_tcount"),
        _s("count", ["ip", "app"], None, "ip_app_count"),
        _s("mean", ["ip", "channel"], "hour", "ip_channel_mean_hour"),
        _s("mean", ["ip", "app", "os"], "hour", "ip_app_os_mean_hour"),
        _s("mean", ["ip", "app"], "hour", "ip_app_mean_hour"),
        _s("mean", ["ip", "device"], "hour", "ip_device_mean_hour"),
        _s("var", ["channel", "day"], "hour", "channel_day_hour_var"),
        _s("var", ["device", "day"], "hour", "device_day_hour_var"),
        _s("var", ["ip", "app", "channel"], "hour", "ip_app_channel_var_hour"),
        _s("var", ["ip", "app"], "hour", "ip_app_var_hour"),
        _s("var", ["ip", "device"], "hour", "ip_device_var_hour"),
        _s("nunique", ["ip"], "device", "ip_device_countuniq", "uint32"),
        _s("next", ["ip", "app", "device", "os"], None, "next_click_0", "int"),
        _s("next", ["ip", "device"], None, "next_click_1", "int"),
        _s("next", ["ip", "device", "channel"], None, "next_click_2", "int"),
        _s("next", ["app", "device", "channel"], None, "next_click_3", "int"),
        _s("next", ["ip", "app", "channel", "os"], None, "next_click_4", "int"),
        _s("next", ["ip", "app", "device", "os", "channel"], None, "next_click_5", "int"),
        _s("next", ["ip", "os", "device"], None, "next_click_6", "int"),
        _s("next", ["ip", "channel"], None, "next_click_7", "int"),
    ]


def catalogue_v26() -> list[FeatureSpec]:
    base = [s for s in catalogue_v27()[:11]]
    return base + [
        _s("mean", ["ip", "app", "channel"], "hour", "ip_app_channel_mean_hour"),
        _s("mean", ["ip", "app", "channel", "device", "os"], "hour", "ip_app_channel_device_os_mean_hour"),
        _s("mean", ["ip", "app", "os"], "hour", "ip_app_os_mean_hour"),
        _s("mean", ["ip", "app"], "hour", "ip_app_mean_hour"),
        _s("nunique", ["device", "day"], "hour", "device_day_hour_countuniq", "uint32"),
        _s("nunique", ["channel", "day"], "hour", "channel_day_hour_countuniq", "uint32"),
        _s("nunique", ["ip", "channel"], "app", "ip_channel_app_countuniq", "uint32"),
        _s("var", ["channel", "day"], "hour", "channel_day_hour_var"),
        _s("var", ["device", "day"], "hour", "device_day_hour_var"),
        _s("var", ["ip", "app", "channel"], "hour", "ip_app_channel_var_hour"),
        _s("nunique", ["ip"], "device", "ip_device_countuniq", "uint32"),
        _s("next", ["ip", "app", "device", "os"], None, "next_click_0", "int"),
        _s("next", ["ip", "device"], None, "next_click_1", "int"),
        _s("next", ["ip", "device", "channel"], None, "next_click_2", "int"),
        _s("next", ["app", "device", "channel"], None, "next_click_3", "int"),
        _s("next", ["ip", "app", "channel", "os"], None, "next_click_4", "int"),
        _s("next", ["ip", "app", "device", "os", "channel"], None, "next_click_5", "int"),
        _s("next", ["ip", "os", "device"], None, "next_click_6", "int"),
    ]


def catalogue_v18() -> list[FeatureSpec]:
    """Version 18: the unique-count, running-count and group features of the
    later versions with variances by device and channel, and gaps on devices."""
    later = {s.name: s for s in catalogue_v27()}
    return [later[f"X{i}"] for i in range(9)] + [
        _s("count", ["ip", "day", "hour"], None, "ip_tcount"),
        _s("count", ["ip", "app"], None, "ip_app_count"),
        _s("count", ["ip", "app", "os"], None, "ip_app_os_count", "uint16"),
        _s("var", ["ip", "day", "channel"], "hour", "ip_tchan_count"),
        _s("var", ["ip", "app", "os"], "hour", "ip_app_os_var"),
        _s("var", ["ip", "app", "channel"], "day", "ip_app_channel_var_day"),
        _s("mean", ["ip", "app", "channel"], "hour", "ip_app_channel_mean_hour"),
        _s("var", ["ip", "app", "channel"], "hour", "ip_app_channel_var_hour"),
        _s("nunique", ["device"], "day", "device_day_countuniq", "uint32"),
        _s("var", ["device"], "day", "device_day_var"),
        _s("nunique", ["device", "day"], "hour", "device_day_hour_countuniq", "uint32"),
        _s("var", ["device", "day"], "hour", "device_day_hour_var"),
        _s("nunique", ["channel", "day"], "hour", "channel_day_hour_countuniq", "uint32"),
        _s("var", ["channel", "day"], "hour", "channel_day_hour_var"),
        _s("nunique", ["ip", "channel"], "app", "ip_channel_app_countuniq", "uint32"),
        _s("nunique", ["ip"], "device", "ip_device_countuniq", "uint32"),
        _s("next", ["ip", "app", "device", "os"], None, "next_click_0", "float"),
        _s("next", ["device"], None, "next_click_1", "float"),
        _s("next", ["device", "channel"], None, "next_click_2", "float"),
        _s("next", ["app", "device", "channel"], None, "next_click_3", "float"),
        _s("next", ["device", "hour"], None, "next_click_4", "float"),
    ]


def catalogue_v21() -> list[FeatureSpec]:
    """Gap features on low-cardinality keys: few keys, each huge.  This is
    the skew stress case of the chunked window."""
    gaps = [
        ("next_click_0", ["ip", "app", "device", "os"]), ("next_click_1", ["device"]),
        ("next_click_2", ["device", "channel"]), ("next_click_3", ["app", "device", "channel"]),
        ("next_click_4", ["device", "hour"]), ("next_click_5", ["app", "device", "hour"]),
        ("next_click_6", ["channel", "hour"]), ("next_click_7", ["app", "channel", "hour"]),
        ("next_click_8", ["device", "channel", "hour"]), ("next_click_9", ["app", "device", "channel", "hour"]),
        ("next_click_10", ["device"]), ("next_click_11", ["device", "hour"]),
        ("next_click_12", ["device", "channel"]), ("next_click_13", ["app", "device", "channel"]),
        ("next_click_14", ["device", "channel"]),
    ]
    return catalogue_v27()[:11] + [_s("next", k, None, n, "float") for n, k in gaps]


# ---------------------------------------------------------------------------
# Op codes of the table-driven feature form (a row is the
# selected columns -- keys then the counted column -- and a code).
# ---------------------------------------------------------------------------
OP_CODES = {0: "countnn", 1: "mean", 2: "var", 3: "skew", 4: "nunique", 5: "cumcount"}


def from_table(rows, prefix: str = "X") -> list[FeatureSpec]:
    """Specs from ``(selected columns, op code)`` rows: the last selected
    column is the counted one, the others are the keys; row i is named
    ``{prefix}{i}``."""
    out = []
    for i, (cols, code) in enumerate(rows):
        out.append(_s(OP_CODES[code], list(cols[:-1]), cols[-1], f"{prefix}{i}"))
    return out


# The nine table rows of the table-driven script version.
NB977_TABLE = [
    (("ip", "channel"), 4), (("ip", "device", "os", "app"), 5), (("ip", "day", "hour"), 4),
    (("ip", "app"), 4), (("ip", "app", "os"), 4), (("ip", "device"), 4), (("app", "channel"), 4),
    (("ip", "os"), 5), (("ip", "device", "os", "app"), 4),
]


def catalogue_nb977() -> list[FeatureSpec]:
    """Table-driven set (``NB977_TABLE``) plus the gap and group features
    written inline after it."""
    return from_table(NB977_TABLE) + [
        _s("next", ["ip", "app", "device", "os"], None, "nextClick", "long"),
        _s("countnn", ["ip", "day", "hour"], "channel", "ip_tcount"),
        _s("countnn", ["ip", "app"], "channel", "ip_app_count"),
        _s("countnn", ["ip", "app", "os"], "channel", "ip_app_os_count"),
        _s("var", ["ip", "day", "channel"], "hour", "ip_tchan_count", nulls="keep"),
        _s("var", ["ip", "app", "os"], "hour", "ip_app_os_var", nulls="keep"),
        _s("var", ["ip", "app", "channel"], "day", "ip_app_channel_var_day", nulls="keep"),
        _s("mean", ["ip", "app", "channel"], "hour", "ip_app_channel_mean_hour", nulls="keep"),
    ]


def catalogue_all() -> list[FeatureSpec]:
    """Every distinct active feature call across the script versions (58),
    each under a unique name ``fNN_<name>`` because several versions reuse a
    name for a different definition (e.g. ``ip_tcount``, ``X2``)."""
    rows = [
        ("count", ["ip", "app"], None, "ip_app_count", "uint32"),
        ("count", ["ip", "app", "os"], None, "ip_app_os_count", "uint16"),
        ("count", ["ip", "day", "hour"], None, "ip_tcount", "uint32"),
        ("count", ["ip", "hour"], None, "ip_tcount", "uint32"),
        ("nunique", ["app"], "channel", "X6", "uint32"),
        ("nunique", ["channel", "day"], "hour", "channel_day_hour_countuniq", "uint32"),
        ("nunique", ["device"], "day", "device_day_countuniq", "uint32"),
        ("nunique", ["device", "day"], "hour", "device_day_hour_countuniq", "uint32"),
        ("nunique", ["ip"], "app", "X3", "uint8"),
        ("nunique", ["ip"], "channel", "X0", "uint8"),
        ("nunique", ["ip"], "device", "X5", "uint16"),
        ("nunique", ["ip"], "device", "ip_device_countuniq", "uint32"),
        ("nunique", ["ip"], "hour", "X2", "uint8"),
        ("nunique", ["ip", "app"], "os", "X4", "uint8"),
        ("nunique", ["ip", "channel"], "app", "ip_channel_app_countuniq", "uint32"),
        ("nunique", ["ip", "day"], "hour", "X2", "uint8"),
        ("nunique", ["ip", "device", "os"], "app", "X8", "uint32"),
        ("cumcount", ["ip"], "os", "X7", "uint32"),
        ("cumcount", ["ip", "device", "os"], "app", "X1", "uint32"),
        ("mean", ["app", "channel"], "hour", "app_channel_mean_hour", "float"),
        ("mean", ["ip", "app"], "hour", "ip_app_mean_hour", "float"),
        ("mean", ["ip", "app", "channel"], "hour", "ip_app_channel_mean_hour", "float"),
        ("mean", ["ip", "app", "channel", "device", "os"], "hour", "ip_app_channel_device_os_mean_hour", "float"),
        ("mean", ["ip", "app", "os"], "hour", "ip_app_os_mean_hour", "float"),
        ("mean", ["ip", "channel"], "hour", "ip_channel_mean_hour", "float"),
        ("mean", ["ip", "device"], "hour", "ip_device_mean_hour", "float"),
        ("next", ["app", "channel", "hour"], None, "next_click_7", "float"),
        ("next", ["app", "device", "channel"], None, "next_click_13", "float"),
        ("next", ["app", "device", "channel"], None, "next_click_3", "int"),
        ("next", ["app", "device", "channel", "hour"], None, "next_click_9", "float"),
        ("next", ["app", "device", "hour"], None, "next_click_5", "float"),
        ("next", ["channel", "hour"], None, "next_click_6", "float"),
        ("next", ["device"], None, "next_click_1", "int"),
        ("next", ["device"], None, "next_click_10", "float"),
        ("next", ["device", "channel"], None, "next_click_12", "float"),
        ("next", ["device", "channel"], None, "next_click_14", "float"),
        ("next", ["device", "channel"], None, "next_click_2", "int"),
        ("next", ["device", "channel", "hour"], None, "next_click_8", "float"),
        ("next", ["device", "hour"], None, "next_click_11", "float"),
        ("next", ["device", "hour"], None, "next_click_4", "int"),
        ("next", ["ip", "app", "channel", "os"], None, "next_click_4", "int"),
        ("next", ["ip", "app", "device", "os"], None, "next_click_0", "int"),
        ("next", ["ip", "app", "device", "os", "channel"], None, "next_click_5", "int"),
        ("next", ["ip", "channel"], None, "next_click_7", "int"),
        ("next", ["ip", "device"], None, "next_click_1", "int"),
        ("next", ["ip", "device", "channel"], None, "next_click_2", "int"),
        ("next", ["ip", "os", "device"], None, "next_click_6", "int"),
        ("var", ["app", "channel"], "hour", "app_channel_var_hour", "float"),
        ("var", ["channel", "day"], "hour", "channel_day_hour_var", "float"),
        ("var", ["device"], "day", "device_day_var", "float"),
        ("var", ["device", "day"], "hour", "device_day_hour_var", "float"),
        ("var", ["ip", "app"], "hour", "ip_app_var_hour", "float"),
        ("var", ["ip", "app", "channel"], "day", "ip_app_channel_var_day", "float"),
        ("var", ["ip", "app", "channel"], "hour", "ip_app_channel_var_hour", "float"),
        ("var", ["ip", "app", "os"], "hour", "ip_app_os_var", "float"),
        ("var", ["ip", "channel"], "hour", "ip_tchan_count", "float"),
        ("var", ["ip", "day", "channel"], "hour", "ip_tchan_count", "float"),
        ("var", ["ip", "device"], "hour", "ip_device_var_hour", "float"),
    ]
    return [_s(op, keys, col, f"f{i:02d}_{name}", dtype) for i, (op, keys, col, name, dtype) in enumerate(rows, 1)]


CATALOGUES = {
    "all": catalogue_all,
    "v18": catalogue_v18, "v21": catalogue_v21, "v26": catalogue_v26, "v27": catalogue_v27, "nb977": catalogue_nb977,
}
