"""Best-fit packing into sequences of several permitted lengths.

Pieces of documents are dealt by hash into shards of bounded size, and every
shard is packed on its own, longest piece first.  The permitted lengths are
optimised jointly: the longest piece left opens a bin, which is filled in thought
at every permitted length, always with the longest piece still to come that fits;
the length with the least cost per token held is opened with that filling.  Each
shard is also packed by best fit from the side of the pieces, at every opening size:
a piece goes into the open bin with the least room for it.  The cheapest outcome
counts after every bin has been downsized to the smallest permitted length that
holds its contents.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_written, ship
from .token_counts import token_lengths

CAPACITIES = (2048, 4096, 8192, 16384)
#: Cost of a sequence of c tokens: c * (1 + c / ATTENTION) + OVERHEAD.
ATTENTION = 65_536
OVERHEAD = 16
#: Pieces a shard is planned for; bounds one task's group.
SHARD = 4096


def cost(capacity: int) -> float:
    """Cost of one sequence: its tokens, their share of attention, a constant."""
    return capacity * (1 + capacity / ATTENTION) + OVERHEAD


def _filling(n: int, coming: list[int], capacity: int) -> tuple[int, list[int]]:
    """(tokens held, places in ``coming``) of a bin with a piece of ``n``, filled by
    always taking the longest piece that still fits; ``coming`` holds the negated
    lengths in ascending order."""
    room, at, taken = capacity - n, 0, []
    while (at := bisect_left(coming, -room, at)) < len(coming):
        room += coming[at]
        taken.append(at)
        at += 1
    return capacity - room, taken


def _pack_planned(lengths: list[int], order: list[int], caps: tuple[int, ...]):
    """(bin of each piece, contents of each bin): the longest piece left opens a
    bin, filled in thought at every permitted size; the filling with the least cost
    per token held, at the size it can be downsized to, is kept."""
    of, fill = [0] * len(lengths), []
    left, coming = list(order), [-lengths[i] for i in order]
    while left:
        first, n = left.pop(0), -coming.pop(0)
        plans = [_filling(n, coming, c) for c in caps if c >= n]
        held, taken = min(plans, key=lambda p: (cost(_downsized(p[0], caps)) / max(1, p[0]), p[0]))
        of[first] = len(fill)
        for at in reversed(taken):
            of[left.pop(at)] = len(fill)
            del coming[at]
        fill.append(held)
    return of, fill


def _pack_fixed(lengths: list[int], order: list[int], caps: tuple[int, ...], opened: int):
    """(bin of each piece, contents of each bin): a piece goes into the open bin with
    the least room for it, else a bin of size ``opened``, or the next size that holds
    it, is opened."""
    rooms: list[tuple[int, int]] = []  # (free, bin), sorted
    of, fill = [0] * len(lengths), []
    for i in order:
        n = lengths[i]
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            free, b = rooms.pop(at)
        else:
            free, b = max(opened, _downsized(n, caps)), len(fill)
            fill.append(0)
        of[i] = b
        fill[b] += n
        insort(rooms, (free - n, b))
    return of, fill


def _downsized(held: int, caps: tuple[int, ...]) -> int:
    """The smallest permitted length that holds ``held`` tokens."""
    return caps[bisect_left(caps, held)]


def pack(lengths: list[int], caps: tuple[int, ...] = CAPACITIES, rules: tuple[int | None, ...] | None = None):
    """(bin of each piece, capacity of each bin, contents of each bin) of the
    cheapest packing tried: by ``rules``, by default the planned one (None) and best
    fit at each opening size.  Pieces must not exceed the largest capacity."""
    caps = tuple(sorted(set(caps)))
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    best = None
    for opened in (None, *caps) if rules is None else rules:
        of, fill = _pack_planned(lengths, order, caps) if opened is None else _pack_fixed(lengths, order, caps, opened)
        sized = [_downsized(f, caps) for f in fill]
        total = sum(map(cost, sized))
        if best is None or total < best[0]:
            best = (total, of, sized, fill)
    return best[1:]


def best_fit_packing(docs: DataFrame, length: Column, capacities: tuple[int, ...] = CAPACITIES,
                     id_col: str = "doc_id", shard: int = SHARD) -> DataFrame:
    """One row per piece of a document: the sequence it is in (bin_id, capacity,
    bin_fill), its place there (position among the pieces, token offset), and the
    tokens it holds (doc_id, piece, start, length).  ``length`` is read twice, so
    what is dear to compute should come from a written table.

    A document longer than the largest capacity becomes consecutive pieces of
    that capacity and a rest; nothing is cut off.  A null or zero length gives
    one piece of length 0.  Repeated rows and ids are packed as rows of their
    own; a null id stays null.  An empty table gives an empty result.  Other
    columns of the input are not read.
    """
    largest = max(capacities)
    n = F.coalesce(length.cast("long"), F.lit(0))
    # an array of the starts, so very long texts need no row per token
    pieces = (ship(docs).select(F.col(id_col).cast("long").alias("doc_id"), n.alias("n"))
              .select("doc_id", "n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(largest).cast("long"))).alias("piece", "start"))
              .select("doc_id", "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(largest)).alias("length")))
    total = pieces.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    shards = max(1, math.ceil(total / shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", F.monotonically_increasing_id()), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True]).reset_index(drop=True)
        of, sized, fill = pack(pdf["length"].tolist(), capacities)
        b = np.asarray(of)
        out = pd.DataFrame({
            "bin_id": int(pdf["shard"].iloc[0]) * (1 << 32) + b, "capacity": np.asarray(sized)[b], "bin_fill": np.asarray(fill)[b],
            "position": 0, "offset": 0, "doc_id": pdf["doc_id"], "piece": pdf["piece"], "start": pdf["start"], "length": pdf["length"]})
        together = out.groupby("bin_id")
        out["position"] = together.cumcount()
        out["offset"] = together["length"].cumsum() - out["length"]
        return out

    schema = "bin_id long, capacity long, bin_fill long, position int, offset long, doc_id long, piece int, start long, length long"
    return dealt.groupBy("shard").applyInPandas(run, schema)


def pack_tokens(docs: DataFrame, path: str, capacities: tuple[int, ...] = CAPACITIES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``best_fit_packing`` of whole texts, counted in tokens of the vocabulary file
    ``path``; the counts are written once.  A null text counts as empty."""
    lengths = keep_written(token_lengths(docs, path, id_col, text_col), "packing-lengths")
    return best_fit_packing(lengths, F.col("n_tokens"), capacities)
