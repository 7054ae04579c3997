"""Hard-negative mining by slot-decomposed selection.

Every anchor has a few positives, and each positive allows negatives with scores
in a window below its own score.  The windows overlap.  Their upper limits, in
descending order, cut the scores into disjoint slots: slot i holds what lies at
or under limit i and above limit i + 1.  A combiner keeps the best k of a slot;
the best k at or under limit i are then those of slot i followed by those at or
under limit i + 1, so one pass over an anchor's slots from the lowest limit up
answers all windows, and the lower limit cuts off the end of an answer.

Anchors meet all rows in blocks: rows and anchors are dealt by hash into cells
of bounded size, and every (row cell, anchor cell) is one group with an exact
matrix product.  A cell's size doesn't depend on labels, so a label with a third
of all rows is spread like others.

Defined results: a null vec_id takes no part; of rows with the same vec_id the
one with the least (label, vector) stands for all; a shorter vector continues in
zeros; scores beyond a long are held at its ends; an empty table, anchors
without positives and windows without rows give no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_written, ship

#: Rows and anchors of a cell, on average.
ROW_CELL = 32_768
ANCHOR_CELL = 4_096
#: Cells of a product that are held at once.
PRODUCT = 2_000_000
_LONG = 2**63 - 1


def usable(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vector) of the rows that take part, one per id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return one.select("id", F.col("row.label").cast("long").alias("label"), F.col("row.vector").cast("array<double>").alias("vector"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Floors of 256 times the components, a row per vector, ends filled with zeros."""
    vectors = column.combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks)
    off = vectors.offsets.to_numpy()
    flat = np.floor(vectors.values.to_numpy(zero_copy_only=False) * 256.0)
    width = np.diff(off)
    d = int(width.max(initial=0))
    if len(width) and (width == d).all():
        return flat[off[0]:off[-1]].reshape(len(width), d)
    out = np.zeros((len(width), d))
    for i, w in enumerate(width):
        out[i, :w] = flat[off[i]:off[i] + w]
    return out


def _products(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the first anchor, exact scores) of slices of anchors.  Products
    that doubles can't hold exactly are made of whole numbers."""
    d = max(anchors.shape[1], rows.shape[1], 1)
    anchors = np.pad(anchors, ((0, 0), (0, d - anchors.shape[1])))
    rows = np.pad(rows, ((0, 0), (0, d - rows.shape[1])))
    exact = math.sqrt(2.0**53 / d)
    large_rows = np.flatnonzero(np.abs(rows).max(axis=1, initial=0) > exact)
    # a row with large components is left out of the product of doubles
    tame = rows.copy() if len(large_rows) else rows
    tame[large_rows] = 0
    step = max(1, PRODUCT // max(1, len(rows)))
    whole = lambda m: np.array([[int(x) for x in v] for v in m], dtype=object).reshape(m.shape)
    for i in range(0, len(anchors), step):
        some = anchors[i:i + step]
        large = np.flatnonzero(np.abs(some).max(axis=1, initial=0) > exact)
        plain = some.copy() if len(large) else some
        plain[large] = 0
        scores = (plain @ tame.T).astype(np.int64)
        if len(large):
            scores[large] = _held(whole(some[large]) @ whole(rows).T)
        if len(large_rows):
            scores[:, large_rows] = _held(whole(some) @ whole(rows[large_rows]).T)
        yield i, scores


def _held(scores: np.ndarray) -> np.ndarray:
    return np.array([[min(max(x, -_LONG), _LONG) for x in row] for row in scores], np.int64).reshape(scores.shape)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, best first, ties by index."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        keep = np.concatenate((above, np.flatnonzero(scores == least)[:k - len(above)]))
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((keep, -scores[keep]))][:k]


def _by_id(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, [("id", "ascending")]))


_FOUND = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _found(out: list[tuple]) -> pa.Table:
    if not out:
        return _FOUND.empty_table()
    anchor, slot, score, ids = zip(*out)
    return pa.table([pa.array(np.concatenate(x), t.type) for x, t in zip((anchor, slot, score, ids), _FOUND)], schema=_FOUND)


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = _by_id(rows)
        ids, labels, anchor_ids, anchor_labels = (t.column(c).to_numpy() for t in (rows, anchors) for c in ("id", "label"))
        r, a = _matrix(rows.column("vector")), _matrix(anchors.column("vector"))
        out = []
        for label in np.unique(anchor_labels):
            mine, same = np.flatnonzero(anchor_labels == label), np.flatnonzero(labels == label)
            if len(same) == 0:
                continue
            for i, scores in _products(a[mine], r[same]):
                for me, s in zip(anchor_ids[mine[i:i + len(scores)]], scores):
                    # one more, as the anchor itself may be among them
                    top = _best(s, k + 1)
                    top = top[ids[same[top]] != me][:k]
                    out.append((np.full(len(top), me), np.zeros(len(top), np.int32), s[top], ids[same[top]]))
        return _found(out)

    return run


def _slots(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = _by_id(rows)
        ids, labels, anchor_ids, anchor_labels = (t.column(c).to_numpy() for t in (rows, anchors) for c in ("id", "label"))
        limits, floors = anchors.column("limits").to_pylist(), anchors.column("floor").to_numpy()
        out = []
        for i, scores in _products(_matrix(anchors.column("vector")), _matrix(rows.column("vector"))):
            for j, s in enumerate(scores, i):
                fit = np.flatnonzero((s >= floors[j]) & (s <= limits[j][0]) & (labels != anchor_labels[j]))
                # limits descend: a score's slot is the last limit that is not below it
                slot = len(limits[j]) - 1 - np.searchsorted(np.array(limits[j][::-1]), s[fit], "left")
                for x in np.unique(slot):
                    mine = fit[slot == x]
                    top = mine[_best(s[mine], k)]
                    out.append((np.full(len(top), anchor_ids[j]), np.full(len(top), x, np.int32), s[top], ids[top]))
        return _found(out)

    return run


def _windows(k: int, low: int, high: int):
    """Answers the windows of each anchor from its slots, lowest limit first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, positives, limits, found in zip(*(c.to_pylist() for c in batch.columns)):
                slots: list[list] = [[] for _ in limits]
                for x in found or ():
                    slots[x["slot"]].append((-x["score"], x["id"]))
                answers: list[list] = [[] for _ in limits]
                below: list = []
                for i in reversed(range(len(limits))):
                    # a slot's rows lie above all rows of the slots below it
                    below = answers[i] = (sorted(slots[i]) + below)[:k]
                at = {limit: i for i, limit in enumerate(limits)}
                for p in positives:
                    best = answers[at[p["score"] * high // 100]] if p["score"] * high // 100 in at else []
                    fit = [x for x in best if low * p["score"] <= -100 * x[0]]
                    out += [(anchor, p["id"], rank, x[1], p["score"], -x[0]) for rank, x in enumerate(fit, 1)]
            if out:
                cols = zip(*out)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def _dealt(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Both sides grouped by (row cell, anchor cell): each side is copied to the
    other's cells and meets it once."""
    across, down = max(1, -(-n_rows // ROW_CELL)), max(1, -(-n_anchors // ANCHOR_CELL))
    cell = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("across", cell(across)).withColumn("down", every(down))
    # columns of its own, as both sides come from one table
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns]).withColumn("down", cell(down)).withColumn("across", every(across))
    return left.groupBy("across", "down").cogroup(right.groupBy("across", "down"))


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The best k of every anchor and slot over all cells."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(df: DataFrame, *, anchor: Column, relabel: Column | None = None, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """For each anchor (``anchor``: a condition on id) and each of its best
    ``positives`` rows of the same label, the best ``negatives`` rows of another
    label whose score lies between ``low`` and ``high`` hundredths of the
    positive's: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.  ``relabel``: label in place of the row's, an expression of
    id and label."""
    rows = usable(df, id_col=id_col, vector_col=vector_col, label_col=label_col)
    rows = keep_written(rows.withColumn("label", relabel.cast("long")) if relabel is not None else rows, "vectors")
    anchors = rows.where(anchor)
    n_rows, n_anchors = rows.count(), anchors.count()
    found = "anchor_id long, slot int, score long, id long"

    near = _dealt(ship(rows), anchors, n_rows, n_anchors).applyInArrow(_positives(positives), found)
    score = F.col("score")
    # the windows of one anchor: positives best first, distinct upper limits descending
    limit = F.floor(score.cast("decimal(20,0)") * high / 100).cast("long")
    open_ = F.collect_set(F.when(score >= 0, limit))
    near = _best_of(near, positives).groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("positives"),
        F.sort_array(open_, asc=False).alias("limits"), F.min(F.when(score >= 0, score)).alias("lowest"))
    # the lowest score that any window takes
    near = near.where("lowest is not null").withColumn("floor", F.ceil(F.col("lowest").cast("decimal(20,0)") * low / 100).cast("long"))
    near = keep_written(near, "positives")

    asked = anchors.join(near.select(F.col("anchor_id").alias("id"), "limits", "floor"), "id")
    slots = _dealt(rows, asked, n_rows, n_anchors).applyInArrow(_slots(negatives), found)
    slots = _best_of(slots, negatives).groupBy("anchor_id").agg(F.collect_list(F.struct("slot", "score", "id")).alias("found"))
    both = near.select("anchor_id", "positives", "limits").join(slots, "anchor_id")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return both.mapInArrow(_windows(negatives, low, high), out)
