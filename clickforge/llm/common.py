"""Helpers shared by the training-data operators: table access, written
intermediate tables, and the vectorised text kernels (word and shingle
hashing over Arrow string buffers) that run inside Spark tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from clickforge.session import shared_path

#: Text processed at once inside a task; bounds the kernels' scratch arrays.
CHUNK_BYTES = 2_000_000


_SHIPPED: set[str] = set()


def ship(frame: DataFrame) -> DataFrame:
    """Send this package to the executors' Python workers, once per
    application, as any Spark job does with its own modules."""
    sc = frame.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="package-"), "clickforge_package.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(package):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back:
    a reliable cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def string_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, offsets starting at 0.
    Nulls read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, b"" if binary else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    o = np.frombuffer(off, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1]
    o = o.astype(np.int64)
    if data is None or len(o) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` text bytes (a single longer
    text makes its own slice), with the text's bytes and offsets."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, off = string_parts(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
            j = min(max(j, i + 1), n)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


# ---- hashing ---------------------------------------------------------------

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash like a-z: the text is lower-cased in ASCII
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_ORDER = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_CASED = _BYTE.copy()
_CASED[65:91] = _rng.integers(1, 2**63, 26, dtype=np.uint64) | np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply rounds)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def words(data: np.ndarray, off: np.ndarray, word_byte: np.ndarray = _WORD_BYTE):
    """Word spans of concatenated texts: (start, end, first), ``first[d]`` being
    the index of text d's first word (length texts + 1).  Words never cross
    texts."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = word_byte[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = off[(off > 0) & (off < len(data))]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each span of the bytes, ASCII-lower-cased if ``fold``, by
    differences of a running polynomial sum (all arithmetic modulo 2**64)."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((_BYTE if fold else _CASED)[data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _ORDER[63])


def shingles(h: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text in order, and the bounds of
    each text's shingles.  A text of 1 to k-1 words has one shingle, its whole
    sequence; one without words has none."""
    n = len(first) - 1
    per = first[1:] - first[:-1]
    count = np.where(per >= k, per - k + 1, np.minimum(per, 1))
    bounds = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(int(bounds[-1]), np.uint64)
    if len(h) >= k:
        s = h[:len(h) - k + 1] * _ORDER[0]
        for j in range(1, k):
            s = s + h[j:len(h) - k + 1 + j] * _ORDER[j]
        s = mix(s + np.uint64(k))
        full = np.flatnonzero(per >= k)
        if len(full):
            c = count[full]
            shift = np.repeat(first[full] - (np.cumsum(c) - c), c)
            src = np.arange(int(c.sum())) + shift
            dst = np.repeat(bounds[full] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
            out[dst] = s[src]
    for d in np.flatnonzero((per > 0) & (per < k)):
        part = h[first[d]:first[d + 1]]
        out[bounds[d]] = mix((part * _ORDER[:len(part)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(part)))[0]
    return out, bounds


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each text."""
    start, end, first = words(data, off)
    s, bounds = shingles(word_hashes(data, start, end), first, k)
    return [np.unique(s[bounds[d]:bounds[d + 1]]) for d in range(len(off) - 1)]
