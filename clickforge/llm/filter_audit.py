"""Filter interaction audit with wide packed counters.

Five filters fail a document or don't: a mask of five bits.  For a mask, the
outcome of every step of all 120 filter orders is fixed, so each mask (with the
two label flags) stands for one big integer of 600 * 6 fields of 64 bits that
hold 0 or 1: kept, removed, redundant, unique fails, good lost, toxic lost.  The
integers are added up per part, first inside each task, then by salted part,
then by part; a field counts rows, so 64 bits never overflow into the next one.
The sum's bytes are the table of counts.

Whether a text repeats one of a smaller doc_id is found without moving texts or
a group's rows: rows are counted by (digest, part, mask, flags, doc_id), then the
counts of each digest are merged with their smallest doc_id, both with partial
sums, so a text with a third of all rows is a few rows when it moves.

Defined results: a null text is empty and its words none; a null part is the
empty string; a null doc_id has no smaller and is no one's smaller id, and no
label; of several labels of a document any 1 counts; repeated rows count each,
and none of them is smaller than the other; an empty table gives no rows; texts
of any length are whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
FIELD_BYTES = 8
#: Packed sums a task holds at once; more parts are sent on in between.
MAX_PARTS = 256
SALTS = 64

_SPACE = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> list[Column]:
    """Failure conditions of the filters A to D on a text without nulls."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n = F.size(words).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return [n < 200, F.size(F.array_distinct(words)).cast("long") * 100 < n * 50,
            capitals * 100 > F.length(text).cast("long") * 3, text.rlike(r"[#$%&*|]")]


def packed_outcomes(mask: int, good: bool, toxic: bool) -> int:
    """The big integer of a mask (bit i: fails filter i) with its label flags."""
    table = np.zeros((len(STEPS), len(COUNTS)), np.uint64)
    for row, (order, step) in zip(table, STEPS):
        bits = [1 << FILTERS.index(f) for f in order[:step]]
        alive, fails = not any(mask & b for b in bits[:-1]), bool(mask & bits[-1])
        removed = alive and fails
        row[:] = [alive and not fails, removed, fails and not alive, mask == bits[-1], removed and good, removed and toxic]
    return int.from_bytes(table.tobytes(), "little")


def unpack(total: int) -> np.ndarray:
    """The counts of a packed sum: a row per step of STEPS, a column per COUNTS."""
    size = len(STEPS) * len(COUNTS) * FIELD_BYTES
    return np.frombuffer(total.to_bytes(size, "little"), np.uint64).reshape(len(STEPS), len(COUNTS)).astype(np.int64)


def audit_masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> DataFrame:
    """Rows counted by part, mask and label flags, a row or two per distinct text:
    (part, mask, good, toxic, n)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("text")))), F.lit(0))
    rows = rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("sha"))
    rows = rows.groupBy("sha", "part", "mask", "id").agg(F.count(F.lit(1)).alias("n"))

    flag = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    # rows without an id match nothing; a salt spreads them
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("sha")).otherwise(F.lit(0)))
    rows = rows.join(known.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left").fillna(False, ["good", "toxic"])

    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    group = rows.groupBy("sha", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), first.alias("first"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    group = group.withColumn("least", F.min("first.id").over(Window.partitionBy("sha")))
    passing = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask").alias("mask"), passing.alias("n")),
                    F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - passing).alias("n")))
    return group.select("part", "good", "toxic", F.inline(split)).where("n > 0").select("part", "mask", "good", "toxic", "n")


def _sum_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wide: dict[tuple, int] = {}
    sums: dict[str, int] = {}

    def send() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([_bytes(v) for v in sums.values()], pa.binary())], ["part", "total"])
        sums.clear()
        return out

    for batch in batches:
        counts: Counter = Counter()
        for part, mask, good, toxic, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[part, mask, good, toxic] += n
        for (part, *outcome), n in counts.items():
            key = tuple(outcome)
            if key not in wide:
                wide[key] = packed_outcomes(*key)
            if part not in sums and len(sums) >= MAX_PARTS:
                yield send()
            sums[part] = sums.get(part, 0) + n * wide[key]
    if sums:
        yield send()


def _bytes(total: int) -> bytes:
    return total.to_bytes((total.bit_length() + 7) // 8, "little")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    """(part, sum) of totals sorted by part, holding one sum."""
    at, total = None, 0
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            if part != at:
                if at is not None:
                    yield at, total
                at, total = part, 0
            total += int.from_bytes(packed.as_py(), "little")
    if at is not None:
        yield at, total


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, total in _runs(batches):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.string()), pa.array([_bytes(total)], pa.binary())], ["part", "total"])


def _unpack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders, steps = zip(*STEPS)
    letter = np.array([FILTERS.index(o[s - 1]) for o, s in STEPS])
    for part, total in _runs(batches):
        table = unpack(total)
        shapley = np.zeros(len(FILTERS), np.int64)
        np.add.at(shapley, letter, table[:, COUNTS.index("removed")])
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(STEPS), pa.string()), pa.array(orders, pa.string()), pa.array(steps, pa.int32()),
             *(pa.array(table[:, i]) for i in range(len(COUNTS))), pa.array(shapley[letter])],
            ["part", "filter_order", "step", *COUNTS, "shapley"])


def filter_audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """A row per part, filter order (all 120 permutations of ABCDE) and step,
    zeros included: what the step's filter keeps, removes, would have removed
    (redundant), fails alone (unique_fails), which good and toxic rows it costs,
    and its removed rows summed over all orders (shapley)."""
    rows = ship(audit_masks(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col))
    packed = "part string, total binary"
    sums = rows.mapInArrow(_sum_masks, packed)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.spark_partition_id(), F.lit(max(1, min(SALTS, math.isqrt(parts)))))
    salted = sums.withColumn("salt", salt).repartition("part", "salt").sortWithinPartitions("part").select("part", "total")
    merged = salted.mapInArrow(_merge, packed).repartition("part").sortWithinPartitions("part")
    fields = ", ".join(f"{c} long" for c in [*COUNTS, "shapley"])
    return merged.mapInArrow(_unpack_rows, f"part string, filter_order string, step int, {fields}")
