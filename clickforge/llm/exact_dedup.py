"""Exact dedup with counting quotient filters.

Every partition builds counting quotient filters over the 64-bit
fingerprints of its normalised texts, one per block of high bits.  Filters of all
partitions meet block by block and merge losslessly by their sorted
remainders, counts adding up.  Fingerprints counted once are done; rows whose
fingerprint is counted more than once go on to byte verification, where each
normalised text is compared with its group's representative text.

A group holding any share of the rows is safe: partitions send one (remainder,
count) however many copies they hold, groups are found by aggregation with
map-side combine, and their rows are compared in salts of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_written, ship, text_chunks

#: Rows a merged filter block is planned for.
ROWS_PER_BLOCK = 200_000
#: A task cuts its filters into at most 2**LEVEL_BITS blocks at once.
LEVEL_BITS = 10
#: Share of a filter's slots in use, at most.
LOAD = 0.75
#: Rows of one group of copies that are compared in one task's key.
ROWS_PER_SALT = 512
SPACE = b" \t\n\x0b\x0c\r"  # deleted before texts are compared

DIGEST = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()),
    T.StructField("text_sha256", T.StringType()), T.StructField("n_points", T.LongType())])


def _digests(with_text: bool):
    def scan(batches):
        # slices of bounded bytes: the running sum below takes eight bytes per byte of text
        for b, data, off in text_chunks(batches):
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off]
            raw = data.tobytes()
            norm = [raw[i:j].translate(None, SPACE) for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            sha = [hashlib.sha256(x).digest() for x in norm]
            cols = [b.column(0).cast(pa.int64()), pa.array([int.from_bytes(x[:8], "big", signed=True) for x in sha], pa.int64()),
                    pa.array([x.hex() for x in sha], pa.string()), pa.array(np.diff(points), pa.int64())]
            names = ["doc_id", "fp", "text_sha256", "n_points"]
            if with_text:
                cols.append(pa.array(norm, pa.binary()))
                names.append("norm")
            yield pa.RecordBatch.from_arrays(cols, names)
    return scan


class QuotientFilter(NamedTuple):
    """A counting quotient filter of distinct values of ``width`` bits.

    A value's high bits (quotient) name the slot it belongs to, its low bits
    (remainder) are stored.  Remainders of one quotient form a sorted run that
    starts at that slot or, where earlier runs reach it, right behind them.  One
    bit per quotient says whether it has a run, one bit per slot whether a run
    ends there, and one byte per slot counts; counts from 255 on are listed in slot
    order.
    """

    width: int
    quotient_bits: int
    occupied: bytes
    run_ends: bytes
    remainders: bytes
    counters: bytes
    large_counts: bytes

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray, width: int) -> QuotientFilter:
        """From sorted distinct values and their counts."""
        n = len(values)
        q = min(width - 1, max(1, math.ceil(math.log2(max(1, n) / LOAD))))
        r = width - q
        quotient = (values >> np.uint64(r)).astype(np.int64)
        at = np.arange(n)
        slot = at + np.maximum.accumulate(quotient - at) if n else at
        slots = max(1 << q, int(slot[-1]) + 1 if n else 0)
        occupied, ends = np.zeros(1 << q, np.uint8), np.zeros(slots, np.uint8)
        occupied[quotient] = 1
        ends[slot[np.flatnonzero(np.diff(quotient, append=-1))]] = 1
        rest = np.zeros((slots, 8), np.uint8)
        rest[slot] = (values & np.uint64((1 << r) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)
        counters = np.zeros(slots, np.uint8)
        counters[slot] = np.minimum(counts, 255)
        return cls(width, q, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), rest[:, :(r + 7) // 8].tobytes(),
                   counters.tobytes(), counts[counts >= 255].astype("<i8").tobytes())

    def values(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted values and their counts."""
        r = self.width - self.quotient_bits
        counters = np.frombuffer(self.counters, np.uint8)
        quotient = np.flatnonzero(np.unpackbits(np.frombuffer(self.occupied, np.uint8)))
        end = np.flatnonzero(np.unpackbits(np.frombuffer(self.run_ends, np.uint8)))
        start = np.maximum(quotient, np.concatenate(([0], end[:-1] + 1))[:len(quotient)])
        length = end - start + 1
        slot = np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)
        rest = np.zeros((len(slot), 8), np.uint8)
        size = (r + 7) // 8
        rest[:, :size] = np.frombuffer(self.remainders, np.uint8).reshape(-1, size)[slot]
        counts = counters[slot].astype(np.int64)
        counts[counts == 255] = np.frombuffer(self.large_counts, "<i8")
        return (np.repeat(quotient, length).astype(np.uint64) << np.uint64(r)) | rest.view("<u8").ravel(), counts


FILTER = "block long, lane long, width int, quotient_bits int, occupied binary, run_ends binary, remainders binary, counters binary, large_counts binary"
NAMES = [c.split()[0] for c in FILTER.split(", ")]


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values with the sums of their counts."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[first], (np.add.reduceat(counts, first) if len(first) else counts)


def merge_filters(filters: list[QuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """Lossless merge: the sorted values of all filters, equal ones adding counts."""
    parts = [f.values() for f in filters]
    return summed(np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts]))


def filters_by_block(values: np.ndarray, counts: np.ndarray, width: int, bits: int) -> list[tuple[int, QuotientFilter]]:
    """(high ``bits`` bits, filter of the rest) of sorted distinct values; only for
    blocks that hold a value."""
    block = (values >> np.uint64(width - bits)).astype(np.int64)
    rest = values & np.uint64((1 << (width - bits)) - 1)
    edge = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)] if len(block) else [0]
    return [(int(block[i]), QuotientFilter.build(rest[i:j], counts[i:j], width - bits)) for i, j in zip(edge[:-1], edge[1:], strict=True)]


def block_levels(n_rows: int, rows_per_block: int) -> list[int]:
    """Bits by which each dealing round cuts the blocks, at most LEVEL_BITS."""
    bits = min(40, max(5, math.ceil(math.log2(max(1, n_rows / rows_per_block)))))
    rounds = math.ceil(bits / LEVEL_BITS)
    return [bits * (k + 1) // rounds - bits * k // rounds for k in range(rounds)]


def repeated_fingerprints(digests: DataFrame, n_rows: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(fp, copies) of the fingerprints counted more than once.

    Blocks are cut in rounds: a task sends at most 2**LEVEL_BITS filters however
    large the corpus.  In each round but the last, the filters of one block are
    dealt to lanes, each of about one block's rows, merged there and cut further.
    """
    levels = block_levels(n_rows, rows_per_block)
    total = sum(levels)

    def lanes(done: int) -> int:
        return 1 << (total - done)

    def rows(found: list[tuple[int, int, QuotientFilter]]) -> list[tuple]:
        return [(block, lane, *f) for block, lane, f in found]

    def build(batches):
        lane = TaskContext.get().partitionId() % lanes(levels[0])
        pending, size = [], 0
        for b in itertools.chain(batches, [None]):
            if b is not None:
                pending.append(b.column(0).to_numpy(zero_copy_only=False))
                size += len(pending[-1])
            if size and (b is None or size >= 10 * ROWS_PER_BLOCK):
                values, counts = np.unique(np.concatenate(pending).astype(np.int64).view(np.uint64), return_counts=True)
                out = rows([(block, lane, f) for block, f in filters_by_block(values, counts.astype(np.int64), 64, levels[0])])
                yield pa.RecordBatch.from_pydict(dict(zip(NAMES, zip(*out, strict=True), strict=True)), pa.schema(
                    [(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in FILTER.split(", ")]))
                pending, size = [], 0

    def merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return merge_filters([QuotientFilter(*r) for r in pdf[NAMES[2:]].itertuples(index=False)])

    def cut(bits: int, n_lanes: int):
        def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
            values, counts = merged(pdf)
            found = filters_by_block(values, counts, int(pdf["width"].iloc[0]), bits)
            return pd.DataFrame(rows([((int(key[0]) << bits) | block, int(key[1]) % n_lanes, f) for block, f in found]), columns=NAMES)
        return run

    def repeated(key, pdf: pd.DataFrame) -> pd.DataFrame:
        values, counts = merged(pdf)
        again = counts > 1
        return pd.DataFrame({"fp": (values[again] | np.uint64(int(key[0]) << (64 - total))).view(np.int64), "copies": counts[again]})

    filters, done = digests.select("fp").mapInArrow(build, FILTER), levels[0]
    for bits in levels[1:]:
        done += bits
        filters = filters.groupBy("block", "lane").applyInPandas(cut(bits, lanes(done)), FILTER)
    return filters.groupBy("block", "lane").applyInPandas(repeated, "fp long, copies long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after deleting blanks, tabs, line
    feeds, vertical tabs, form feeds and returns; a null text counts as empty,
    so null, empty and all-blank texts are one group.  The row with the most
    code points in its original text stays, then the smallest doc_id (a null
    doc_id comes last).  Of rows repeated with the same doc_id, exactly one
    stays.  Other columns of the input are not read; an empty table gives an
    empty result.
    """
    src = ship(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    digests = keep_written(src.mapInArrow(_digests(False), DIGEST), "dedup-digests")
    again = keep_written(repeated_fingerprints(digests, digests.count()), "dedup-repeated")

    with_text = src.mapInArrow(_digests(True), T.StructType([*DIGEST.fields, T.StructField("norm", T.BinaryType())]))
    # a group's rows are dealt to salts of bounded size; each salt gets the representative
    salts = F.ceil(F.col("copies") / ROWS_PER_SALT)
    members = with_text.join(again, "fp").withColumn("row", F.monotonically_increasing_id()).withColumn("salts", salts).drop("copies")
    members = keep_written(members, "dedup-members").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")))
    every_salt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    first = members.groupBy("fp", "text_sha256").agg(F.first("norm").alias("rep"), F.first("salts").alias("salts"))
    checked = members.join(first.select("fp", "text_sha256", "rep", every_salt), ["fp", "text_sha256", "salt"]).select(
        "doc_id", "fp", "text_sha256", "n_points", "row", "salt", "salts",
        # a text that differs from the representative in spite of equal digests is grouped by its own bytes
        F.when(F.col("norm") == F.col("rep"), F.lit(None)).otherwise(F.col("norm")).cast("binary").alias("other"))
    checked = keep_written(checked, "dedup-checked")

    best = checked.groupBy("fp", "text_sha256", "other").agg(
        F.min(F.struct((-F.col("n_points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row").alias("row"))).alias("m"),
        F.count(F.lit(1)).alias("group_size"), F.first("salts").alias("salts"))
    best = best.select("fp", "text_sha256", "other", "m", "group_size", every_salt)
    c, b = checked.alias("c"), best.alias("b")
    same = [F.col(f"c.{k}") == F.col(f"b.{k}") for k in ("fp", "text_sha256", "salt")]
    grouped = c.join(b, functools.reduce(Column.__and__, same) & F.col("c.other").eqNullSafe(F.col("b.other"))).select(
        F.col("c.doc_id").alias("doc_id"), F.col("b.m.c").alias("keep_id"), "group_size",
        (F.col("c.row") == F.col("b.m.row")).alias("kept"), F.col("c.text_sha256").alias("text_sha256"))
    single = digests.join(again.select("fp"), "fp", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return single.unionByName(grouped)
