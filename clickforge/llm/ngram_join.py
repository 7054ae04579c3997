"""Exact Jaccard join of documents on word shingles.

A document's set is its distinct 5-word shingles.  Texts with equal sets are
one class and are compared once.  Two classes link when
100 * |x & y| >= 75 * |x | y|.  No link is lost: every filter below is an exact
bound.

1. *Document frequencies.*  Tasks deal the shingles of their classes out by
   hash range, packed per (task, range); a shingle that many classes of one task
   hold goes as one mark instead.  Each range counts in how many classes its
   shingles occur and returns only those of two or more.  Ranges are dealt in
   rounds of at most FAN, so what a task sends does not grow with their number.
2. *Reduced sets.*  Shingles of one class only cannot be shared.  A class keeps
   its other shingles; if they are fewer than 75 in 100 of its set it has no
   partner.  Two sets meet exactly in what their reduced sets have in common.
3. *Size-banded tiles.*  Shingles are ordered by frequency, rarest first.  Of a
   linked pair, both hold a common shingle among their first
   (kept - ceil(0.75 n) + 1), and their sizes are in the same or adjacent bands
   of ratio 4/3.  So all linked pairs meet in a tile (shingle, band).
4. *Stars.*  Members of a tile are first compared with one pivot of the tile,
   the same for all tiles as far as possible.  What these links connect needs no
   further comparison, so a group of copies costs a star, not all its pairs.
   This repeats with other pivots as long as it settles a good part of what is
   open; then the pairs of a tile that are still in different components are
   compared, in large tiles block by block on their bitmaps.
5. *Comparison.*  Hashed bitmaps of both sets bound the overlap from above by
   bit counts; pairs that pass are decided by exact intersection of sorted
   arrays.
6. *Link counts.*  All links of a class are inside its component, also those the
   stars had no need for.  Components are compared whole, by bitmaps and exact
   intersection, block against block of bounded size, the blocks of a large one
   cut by size band and hash; blocks return sums per class and never pairs.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_written, mix, ship, shingle_sets, text_chunks
from .components import connected_components

SHINGLE = 5
#: Shingles of the sets that one range is planned for.
RANGE_TOKENS = 1_200_000
#: Ranges that one dealing round tells apart.
FAN = 512
#: Classes of one task from which on a shingle is sent as a mark.
LOCAL_HEAVY = 64
#: Shingles held by a task before it sends them on.
FLUSH_TOKENS = 1_200_000
HEAVY = 255
#: Another turn of stars is worth it if the last left at most this share of the open pairs.
STILL_OPEN = 0.8
#: Open pairs from which on a tile is compared on its bitmaps, and members of a block.
LARGE_TILE = 64
BLOCK = 1024
#: Copies of the block counts of a large component, so its members meet them in many tasks.
COUNT_SALTS = 64


def class_of(s: np.ndarray) -> int:
    """64-bit fingerprint of a set: the class of texts with equal sets."""
    return int(mix(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0].view(np.int64))


def _six(ids: np.ndarray) -> bytes:
    """48-bit ids, six bytes each."""
    return np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _range_of(h: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Which of n equal ranges of a bits-wide hash, from its top 24 bits."""
    return (((h >> np.uint64(bits - 24)) * np.uint64(n)) >> np.uint64(24)).astype(np.int64)


def document_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, cls) per row; cls is null for an empty set."""
    def scan(batches):
        for b, data, off in text_chunks(batches):
            sets = shingle_sets(data, off, SHINGLE)
            n = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())],
                                             ["doc_id", "n_shingles", "cls"])

    return docs.mapInArrow(scan, "doc_id long, n_shingles long, cls long")


# rows of the first exchange: postings and marks of a shingle range, and facts of classes on their way to their bucket
_NAMES = ["part", "lane", "kind", "cls", "counts", "ids", "freq"]
_ROWS = "part long, lane long, kind int, cls binary, counts binary, ids binary, freq binary"


def dealing(ranges: int) -> tuple[int, int]:
    """(fan, rounds) with fan ** rounds ranges, at least as many as asked for."""
    rounds = 1
    while FAN ** rounds < ranges:
        rounds += 1
    fan = 1
    while fan ** rounds < ranges:
        fan += 1
    return fan, rounds


def _cuts(part: np.ndarray):
    """(part, order) of the members of each part that has any."""
    order = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.diff(part[order])) + 1
    return [(int(part[o[0]]), o) for o in np.split(order, edge) if len(o)]


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def _redealt(fan: int, rounds: int, level: int, by_class: bool):
    """Reducer between two rounds: the rows of one part and lane, cut into the
    parts of the next level, by shingle or by class.  Class facts wait in the rounds
    by shingle, where their parts come after all others."""
    before, after = fan ** (level + 1), fan ** (level + 2)
    lanes = fan ** rounds // after

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if not by_class and int(key[0]) >= before:
            return pdf.assign(part=pdf["part"] - before + after)
        rows, lane = [], int(key[1]) % lanes
        for kind, g in pdf.groupby("kind"):
            ids = np.concatenate([_from_six(x) for x in g["ids"]])
            if kind == 1:
                rows += [(p, lane, 1, b"", b"", _six(np.unique(ids[o])), b"") for p, o in _cuts(_range_of(ids, after, 48))]
                continue
            cls = np.concatenate([np.frombuffer(x, np.int64) for x in g["cls"]])
            facts = np.concatenate([np.frombuffer(x, np.uint32) for x in g["counts"]]).reshape(len(cls), -1)
            owner = np.repeat(np.arange(len(cls)), facts[:, -1])
            bucket = _range_of(mix(cls.view(np.uint64)), after, 64)
            if kind == 2:
                bounds = np.concatenate(([0], np.cumsum(facts[:, -1], dtype=np.int64)))
                for p, o in _cuts(bucket):
                    mine = np.concatenate([ids[bounds[i]:bounds[i + 1]] for i in o.tolist()])
                    rows.append((p, lane, 2, cls[o].tobytes(), facts[o].tobytes(), _six(mine), b""))
                continue
            freq = np.concatenate([np.frombuffer(x, np.uint8) for x in g["freq"]])
            for p, o in _cuts(bucket[owner] if by_class else _range_of(ids, after, 48)):
                first = _runs(owner[o])
                rows.append((p, lane, 0, cls[owner[o][first]].tobytes(), np.diff(np.append(first, len(o))).astype(np.uint32).tobytes(),
                             _six(ids[o]), freq[o].tobytes() if len(freq) else b""))
        return pd.DataFrame(rows, columns=_NAMES)

    return run


def _dealt(ranges: int, lanes: int):
    """Mapper: texts -> packed postings by shingle range, marks, class facts, at the
    first level of ``ranges`` parts of each."""
    def flush(held: dict[int, np.ndarray], sizes: dict[int, int]):
        cls = np.array(list(held), np.int64)
        sets = list(held.values())
        count = np.array([len(s) for s in sets], np.int64)
        ids = np.concatenate(sets) >> np.uint64(16)
        owner = np.repeat(np.arange(len(cls)), count)
        order = np.argsort(ids, kind="stable")
        run = _runs(ids[order])
        length = np.diff(np.append(run, len(ids)))
        heavy_run = length >= LOCAL_HEAVY
        heavy = np.zeros(len(ids), bool)
        heavy[order[np.repeat(heavy_run, length)]] = True
        rows, lane = [], TaskContext.get().partitionId() % lanes

        def pack(sel: np.ndarray) -> tuple[bytes, bytes, bytes]:
            o = owner[sel]
            first = _runs(o)
            return cls[o[first]].tobytes(), np.diff(np.append(first, len(o))).astype(np.uint32).tobytes(), _six(ids[sel])

        light = np.flatnonzero(~heavy)
        rows += [(p, lane, 0, *pack(light[o]), b"") for p, o in _cuts(_range_of(ids[light], ranges, 48))]
        marks = ids[order[run[heavy_run]]]
        rows += [(p, lane, 1, b"", b"", _six(marks[o]), b"") for p, o in _cuts(_range_of(marks, ranges, 48))]
        # class facts: size, and the shingles sent as marks
        bucket = _range_of(mix(cls.view(np.uint64)), ranges, 64)
        mine = np.flatnonzero(heavy)
        marked = [ids[mine[i:j]] for i, j in zip(*(lambda e: (e[:-1], e[1:]))(np.searchsorted(owner[mine], np.arange(len(cls) + 1)).tolist()), strict=True)]
        for q, which in _cuts(bucket):
            facts = np.array([[sizes[int(cls[i])], len(marked[i])] for i in which], np.uint32)
            rows.append((ranges + q, lane, 2, cls[which].tobytes(), facts.tobytes(), _six(np.concatenate([marked[i] for i in which])), b""))
        for i in range(0, len(rows), 64):
            cols = list(zip(*rows[i:i + 64], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[3:]]], _NAMES)

    def scan(batches):
        held, sizes, tokens = {}, {}, 0
        for _, data, off in text_chunks(batches):
            for s in shingle_sets(data, off, SHINGLE):
                if len(s) and (c := class_of(s)) not in held:
                    held[c], sizes[c] = s, len(s)
                    tokens += len(s)
            if tokens >= FLUSH_TOKENS:
                yield from flush(held, sizes)
                held, sizes, tokens = {}, {}, 0
        if held:
            yield from flush(held, sizes)

    return scan


def _frequencies(ranges: int, buckets: int, lanes: int):
    """Reducer of one shingle range: shingles of two or more classes, with their
    frequency class, packed by bucket of classes.  Class facts pass through."""
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        if int(pdf["part"].iloc[0]) >= ranges:
            return pdf.assign(part=pdf["part"] - ranges)
        post = pdf[pdf["kind"] == 0]
        ids = np.concatenate([_from_six(x) for x in post["ids"]] or [np.zeros(0, np.uint64)])
        cls = np.concatenate([np.repeat(np.frombuffer(c, np.int64), np.frombuffer(k, np.uint32)) for c, k in zip(post["cls"], post["counts"], strict=True)]
                             or [np.zeros(0, np.int64)])
        marks = np.unique(np.concatenate([_from_six(x) for x in pdf["ids"][pdf["kind"] == 1]] or [np.zeros(0, np.uint64)]))
        del post
        order = np.argsort(ids, kind="stable")
        ids, cls = ids[order], cls[order]
        new = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
        length = np.diff(np.append(np.flatnonzero(new), len(ids)))
        keep = np.repeat(length > 1, length)
        if len(marks):
            at = np.minimum(np.searchsorted(marks, ids), len(marks) - 1)
            keep |= marks[at] == ids
        ids, cls = ids[keep], cls[keep]
        # copies of a class in several tasks count once
        order = np.lexsort((cls, ids))
        ids, cls = ids[order], cls[order]
        once = np.concatenate(([True], (ids[1:] != ids[:-1]) | (cls[1:] != cls[:-1]))) if len(ids) else np.zeros(0, bool)
        ids, cls = ids[once], cls[once]
        run = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
        length = np.diff(np.append(run, len(ids)))
        freq = np.minimum(HEAVY - 1, np.ceil(8 * np.log2(np.maximum(length, 1)))).astype(np.uint8)
        freq, df = np.repeat(freq, length), np.repeat(length, length)
        if len(marks) and len(ids):
            marked = marks[np.minimum(np.searchsorted(marks, ids), len(marks) - 1)] == ids
            freq[marked] = HEAVY
            df = np.where(marked, 2, df)
        keep = df > 1
        ids, cls, freq = ids[keep], cls[keep], freq[keep]
        bucket = _range_of(mix(cls.view(np.uint64)), buckets, 64)
        order = np.lexsort((cls, bucket))
        ids, cls, freq, bucket = ids[order], cls[order], freq[order], bucket[order]
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for q in np.unique(bucket).tolist():
            i, j = edge[q], edge[q + 1]
            first = np.flatnonzero(np.concatenate(([True], cls[i + 1:j] != cls[i:j - 1])))
            rows.append((q, int(pdf["part"].iloc[0]) % lanes, 0, cls[i:j][first].tobytes(), np.diff(np.append(first, j - i)).astype(np.uint32).tobytes(), _six(ids[i:j]), freq[i:j].tobytes()))
        return pd.DataFrame(rows, columns=_NAMES)

    return reduce


def _need(n):
    """Least overlap with which a set of n can reach 75 in 100: ceil(0.75 n)."""
    return (3 * n + 3) // 4


def _reduced(pdf: pd.DataFrame) -> pd.DataFrame:
    """Reducer of one bucket of classes: the reduced sets of the classes that
    can have a partner, sorted, and their prefix of rarest shingles."""
    size: dict[int, int] = {}
    ids, cls, freq = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    for kind, c, k, i, f in zip(pdf["kind"], pdf["cls"], pdf["counts"], pdf["ids"], pdf["freq"], strict=True):
        c = np.frombuffer(c, np.int64)
        i = _from_six(i)
        if kind == 2:
            facts = np.frombuffer(k, np.uint32).reshape(-1, 2)
            size.update(zip(c.tolist(), facts[:, 0].tolist(), strict=True))
            counts, f = facts[:, 1], np.full(len(i), HEAVY, np.uint8)
        else:
            counts, f = np.frombuffer(k, np.uint32), np.frombuffer(f, np.uint8)
        ids.append(i)
        cls.append(np.repeat(c, counts))
        freq.append(f)
    ids, cls, freq = np.concatenate(ids), np.concatenate(cls), np.concatenate(freq)
    if len(ids) == 0:
        return pd.DataFrame({"cls": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "ids": [], "prefix": []})
    order = np.lexsort((ids, cls))
    ids, cls, freq = ids[order], cls[order], freq[order]
    once = np.concatenate(([True], (ids[1:] != ids[:-1]) | (cls[1:] != cls[:-1])))
    ids, cls, freq = ids[once], cls[once], freq[once]
    run = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1])))
    rows = []
    for i, j in zip(run.tolist(), np.append(run[1:], len(ids)).tolist(), strict=True):
        n = size[int(cls[i])]
        k = (j - i) - _need(n) + 1
        if k > 0:
            # shingles of equal frequency class in hash order, the same for all sets
            rare = np.lexsort((ids[i:j], freq[i:j]))[:k]
            rows.append((int(cls[i]), n, _six(ids[i:j]), _six(ids[i:j][rare])))
    return pd.DataFrame(rows, columns=["cls", "n", "ids", "prefix"])


def band(n: np.ndarray) -> np.ndarray:
    """Size band: sets of linked pairs are in the same or adjacent bands."""
    return np.floor(np.log(n) / math.log(4 / 3) + 1e-9).astype(np.int64)


def _tiles(batches):
    """Rows (tile, cls, n, home): a class is at home in its own band's tiles and
    visits those of the next."""
    for b in batches:
        cls, n = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        prefix = [_from_six(x) for x in b.column(2).to_pylist()]
        k = np.array([len(x) for x in prefix], np.int64)
        ids = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
        own = np.repeat(band(n), k)
        for step in (0, 1):
            tile = mix(ids * np.uint64(0x9E3779B97F4A7C15) + (own + step).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(np.repeat(cls, k)), pa.array(np.repeat(n, k)), pa.array(np.full(len(ids), step == 0))],
                                             ["tile", "cls", "n", "home"])


def signature_bits(n: int) -> int:
    """Width of a set's bitmap: two to four bits per member, a power of two."""
    return 1 << min(14, max(8, math.ceil(math.log2(max(n, 1))) + 1))


def signature(ids: np.ndarray, n: int) -> bytes:
    bits = np.zeros(signature_bits(n), bool)
    bits[(mix(ids) % np.uint64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(a: np.ndarray, words: int) -> np.ndarray:
    """Bitmap folded to fewer words: bits are taken modulo the width."""
    return np.bitwise_or.reduce(a.reshape(-1, words), axis=0) if len(a) > words else a


def overlap_bound(a: bytes, b: bytes, na: int, nb: int) -> int:
    """Upper bound of the overlap of two sets of na and nb members: members that
    only one holds leave at least the differing bits."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    w = min(len(x), len(y))
    return (na + nb - int(np.bitwise_count(_fold(x, w) ^ _fold(y, w)).sum())) // 2


def linked(common: int, na: int, nb: int) -> bool:
    return 100 * common >= 75 * (na + nb - common)


def _bounded(batches):
    """Pairs whose bitmaps allow a link.  ka, kb: members of the reduced sets."""
    for b in batches:
        c = {f: b.column(f).to_pylist() for f in b.schema.names}
        ok = [linked(min(overlap_bound(sa, sb, ka, kb), ka, kb), na, nb)
              for sa, sb, ka, kb, na, nb in zip(c["sa"], c["sb"], c["ka"], c["kb"], c["na"], c["nb"], strict=True)]
        i = np.flatnonzero(ok)
        yield pa.RecordBatch.from_arrays([pa.array([c["a"][k] for k in i], pa.int64()), pa.array([c["b"][k] for k in i], pa.int64())], ["a", "b"])


def _tile_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one tile, or of two blocks of it, that are in different
    components and whose bitmaps allow a link.  A pair is given by the first of
    the tiles that both are in, and by that alone."""
    pdf = pdf.sort_values("cls").reset_index(drop=True)
    n, k, cls, label, home, mine = (pdf[c].to_numpy() for c in ("n", "k", "cls", "label", "home", "mine"))
    sig = [np.frombuffer(x, np.uint64) for x in pdf["sig"]]
    width = min(map(len, sig))
    sig = np.stack([_fold(x, width) for x in sig])
    across = pdf["low"].iloc[0] != pdf["high"].iloc[0]
    here, rows = int(pdf["tile"].iloc[0]), []
    at_home = [frozenset(x) for x in pdf["home_tiles"]]
    visits = [frozenset(x) for x in pdf["visit_tiles"]]
    for i in range(len(cls) - 1):
        j = slice(i + 1, None)
        common = np.minimum((k[i] + k[j] - np.bitwise_count(sig[i] ^ sig[j]).sum(1, dtype=np.int64)) // 2, np.minimum(k[i], k[j]))
        ok = (100 * common >= 75 * (n[i] + n[j] - common)) & (label[i] != label[j]) & (home[i] | home[j])
        if across:
            ok &= mine[i] != mine[j]
        for m in (np.flatnonzero(ok) + i + 1).tolist():
            if here == min((at_home[i] & at_home[m]) | (at_home[i] & visits[m]) | (visits[i] & at_home[m])):
                rows.append((cls[i], cls[m]))
    return pd.DataFrame(rows, columns=["a", "b"]).astype("int64")


def _verified(batches):
    """Pairs that link, by exact intersection of their sorted reduced sets."""
    for b in batches:
        c = {f: b.column(f).to_pylist() for f in b.schema.names}
        ok = [linked(len(np.intersect1d(_from_six(ia), _from_six(ib), assume_unique=True)), na, nb)
              for ia, ib, na, nb in zip(c["ia"], c["ib"], c["na"], c["nb"], strict=True)]
        i = np.flatnonzero(ok)
        yield pa.RecordBatch.from_arrays([pa.array([c["a"][k] for k in i], pa.int64()), pa.array([c["b"][k] for k in i], pa.int64())], ["a", "b"])


def _links(pairs: DataFrame, sets: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, written once."""
    s = lambda x: signatures.select(F.col("cls").alias(x), F.col("sig").alias(f"s{x}"), F.col("k").alias(f"k{x}"), F.col("n").alias(f"n{x}"))
    i = lambda x: sets.select(F.col("cls").alias(x), F.col("ids").alias(f"i{x}"), F.col("n").alias(f"n{x}"))
    allowed = keep_written(pairs.join(s("a"), "a").join(s("b"), "b").mapInArrow(_bounded, "a long, b long"), "join-allowed")
    return keep_written(allowed.join(i("a"), "a").join(i("b"), "b").mapInArrow(_verified, "a long, b long"), "join-links")


def class_links(docs: DataFrame, n_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between classes of (doc_id, text) rows that connect every
    pair of linked classes, and the reduced sets (cls, n, ids) of all classes that
    can have a partner; n_bytes of text in all."""
    ship(docs)
    # about one shingle per six bytes
    ranges = max(16, math.ceil(n_bytes / 6 / RANGE_TOKENS))
    fan, rounds = dealing(ranges)
    ranges, lanes = fan ** rounds, fan ** (rounds - 1)

    def cut(rows: DataFrame, by_class: bool) -> DataFrame:
        for level in range(rounds - 1):
            rows = rows.groupBy("part", "lane").applyInPandas(_redealt(fan, rounds, level, by_class), _ROWS)
        return rows.groupBy("part", "lane")

    dealt = docs.select("doc_id", "text").mapInArrow(_dealt(fan, lanes), _ROWS)
    shared = cut(dealt, False).applyInPandas(_frequencies(ranges, fan, lanes), _ROWS)
    sets = keep_written(cut(shared, True).applyInPandas(_reduced, "cls long, n long, ids binary, prefix binary"), "join-sets")

    def sign(batches):
        for b in batches:
            ids = [_from_six(x) for x in b.column(2).to_pylist()]
            n = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) for x in ids], pa.int64()),
                                              pa.array([signature(x, k) for x, k in zip(ids, n, strict=True)], pa.binary())], ["cls", "n", "k", "sig"])

    signatures = keep_written(sets.select("cls", "n", "ids").mapInArrow(sign, "cls long, n long, k long, sig binary"), "join-signatures")
    members = sets.select("cls", "n", "prefix").mapInArrow(_tiles, "tile long, cls long, n long, home boolean")
    crowded = members.groupBy("tile").agg(F.count(F.lit(1)).alias("c"), F.max("home").alias("any_home")).where("c > 1 and any_home").select("tile")
    members = keep_written(members.join(crowded, "tile", "left_semi"), "join-members")

    near = lambda x, y: (F.col(x) * 3 <= F.col(y) * 4) & (F.col(y) * 3 <= F.col(x) * 4)
    links = labels = done = still = None
    for turn in itertools.count():
        named = members.withColumn("label", F.col("cls")) if labels is None else (
            members.join(labels, F.col("cls") == F.col("node"), "left").select("tile", "cls", "n", "home", F.coalesce("label", "cls").alias("label")))
        # of a tile's largest component, the member that a hash of this turn ranks first
        per = named.groupBy("tile", "label").agg(F.count(F.lit(1)).alias("c"), F.max(F.struct(F.xxhash64("cls", F.lit(turn)).alias("rank"), "cls", "n", "home")).alias("p"))
        tops = per.groupBy("tile").agg(F.max(F.struct("c", "p.rank", "label", "p")).alias("top"), F.count(F.lit(1)).alias("components"), F.sum("c").alias("size"),
                                       ((F.pow(F.sum("c"), F.lit(2)) - F.sum(F.pow("c", F.lit(2)))) / 2).alias("open"))
        tops = keep_written(tops.where("components > 1").select("tile", F.col("top.label").alias("pl"), F.col("top.p.cls").alias("p"), F.col("top.p.n").alias("pn"),
                                                                F.col("top.p.home").alias("ph"), "open", "size"), "join-pivots")
        still, before = tops.agg(F.sum("open")).first()[0] or 0.0, still
        if before is not None and (still == 0 or still > STILL_OPEN * before):
            break
        star = (named.join(tops, "tile").where((F.col("label") != F.col("pl")) & near("n", "pn") & (F.col("home") | F.col("ph")))
                .select(F.least("cls", "p").alias("a"), F.greatest("cls", "p").alias("b")).distinct())
        star = keep_written(star if done is None else star.join(done, ["a", "b"], "left_anti"), "join-stars")
        new = _links(star, sets, signatures)
        done, links = (star, new) if done is None else (done.union(star), links.union(new))
        labels = connected_components(links)

    # what the stars left in different components is compared pair by pair
    left = keep_written(named.join(tops.select("tile", "open", "size"), "tile"), "join-open")
    small = left.where(F.col("open") <= LARGE_TILE)
    x, y = small.alias("x"), small.alias("y")
    pairs = (x.join(y, (F.col("x.tile") == F.col("y.tile")) & (F.col("x.cls") < F.col("y.cls")) & (F.col("x.label") != F.col("y.label"))
                    & (F.col("x.home") | F.col("y.home")) & near("x.n", "y.n"))
             .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")))
    large = left.where(F.col("open") > LARGE_TILE)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = large.withColumn("mine", F.pmod(F.xxhash64("cls"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    # a class is in no more tiles than it has prefix shingles, twice
    tiles_of = left.where(F.col("open") > LARGE_TILE).groupBy("cls").agg(
        F.collect_list(F.when(F.col("home"), F.col("tile"))).alias("home_tiles"), F.collect_list(F.when(~F.col("home"), F.col("tile"))).alias("visit_tiles"))
    facts = signatures.select("cls", "k", "sig").join(tiles_of, "cls")
    large = large.join(facts, "cls").select("tile", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine",
                                            "cls", "label", "n", "k", "home", "sig", "home_tiles", "visit_tiles")
    pairs = pairs.union(large.groupBy("tile", "low", "high").applyInPandas(_tile_pairs, "a long, b long")).distinct()
    return links.union(_links(pairs.join(done, ["a", "b"], "left_anti"), sets, signatures)), sets.select("cls", "n", "ids")


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Linked documents of each class within the pairs of blocks of one task."""
    out = []
    for (_, low_band, low, high_band, high), g in pdf.groupby(["label", "low_band", "low", "high_band", "high"], sort=False):
        n, docs = g["n"].to_numpy(), g["docs"].to_numpy()
        sets = [_from_six(x) for x in g["ids"]]
        k = np.array([len(x) for x in sets], np.int64)
        sig = [np.frombuffer(signature(x, c), np.uint64) for x, c in zip(sets, n.tolist(), strict=True)]
        width = min(map(len, sig))
        sig = np.stack([_fold(x, width) for x in sig])
        _, place = np.unique(np.concatenate(sets), return_inverse=True)
        place = np.split(place, np.cumsum(k)[:-1])
        across = (low_band, low) != (high_band, high)
        side = ((g["band"] == low_band) & (g["mine"] == low)).to_numpy()
        held = np.zeros(int(max(x.max() for x in place)) + 1, np.uint8)
        links = np.zeros(len(g), np.int64)
        for i in range(len(g) - 1):
            j = slice(i + 1, None)
            bound = np.minimum((k[i] + k[j] - np.bitwise_count(sig[i] ^ sig[j]).sum(1, dtype=np.int64)) // 2, np.minimum(k[i], k[j]))
            ok = linked(bound, n[i], n[j])
            if across:
                ok &= side[j] != side[i]
            m = np.flatnonzero(ok) + i + 1
            if len(m) == 0:
                continue
            held[place[i]] = 1
            edge = np.concatenate(([0], np.cumsum(k[m])[:-1]))
            common = np.add.reduceat(held[np.concatenate([place[x] for x in m])], edge, dtype=np.int64)
            held[place[i]] = 0
            m = m[linked(common, n[i], n[m])]
            links[i] += docs[m].sum()
            links[m] += docs[i]
        out.append(pd.DataFrame({"cls": g["cls"].to_numpy(), "links": links}))
    return pd.concat(out) if out else pd.DataFrame({"cls": [], "links": []}).astype("int64")


def link_counts(sets: DataFrame, labels: DataFrame, copies: DataFrame) -> DataFrame:
    """(cls, links): documents of other classes that link with those of a class.

    sets: reduced sets (cls, n, ids); labels: (node, label) of the linked classes;
    copies: (cls, docs), documents of each class.
    """
    band_of = F.floor(F.log(F.col("n")) / F.lit(math.log(4 / 3)) + 1e-9).cast("int")
    member = keep_written(labels.join(sets.select("cls", "n"), F.col("node") == F.col("cls")).join(copies, "cls")
                          .select("cls", "label", "n", "docs", band_of.alias("band")), "join-linked")
    per = member.groupBy("label", "band").agg(F.count(F.lit(1)).alias("c"))
    blocks = F.struct("band", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))  # one entry per size band
    per = per.groupBy("label").agg(F.sum("c").alias("c"), F.map_from_entries(F.collect_list(blocks)).alias("blocks")).where(F.col("c") > BLOCK)
    per = per.select("label", "blocks", F.explode(F.sequence(F.lit(0), F.lit(COUNT_SALTS - 1))).alias("salt"))
    cut = member.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(COUNT_SALTS)).cast("int")).join(per, ["label", "salt"], "left")
    within = lambda step: F.coalesce(F.try_element_at("blocks", F.col("band") + step), F.lit(0))
    cut = cut.withColumn("mine", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("cls", F.lit(1)), F.greatest(within(0), F.lit(1)))).cast("int"))

    def against(step: int):
        """Pairs of the member's block with those of its band or the next."""
        pair = lambda a, x, b, y: F.struct(a.alias("low_band"), x.alias("low"), b.alias("high_band"), y.alias("high"))
        band, mine = F.col("band"), F.col("mine")
        each = (lambda t: pair(band, F.least(mine, t), band, F.greatest(mine, t)), lambda t: pair(band, mine, band + 1, t),
                lambda t: pair(band - 1, t, band, mine))[step]
        return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(within(step), F.lit(1)) - 1), F.lit(1), within(step)), each)

    # step -1 is the band below
    whole = F.array(F.struct(F.lit(0).alias("low_band"), F.lit(0).alias("low"), F.lit(0).alias("high_band"), F.lit(0).alias("high")))
    work = F.when(F.col("blocks").isNull(), whole).otherwise(F.concat(against(0), against(1), against(-1)))
    tasks = max(1, math.ceil(member.count() / (2 * BLOCK)))
    cut = cut.withColumn("single", F.col("blocks").isNull()).select("cls", "label", "n", "docs", "band", "mine", "single", F.explode(work).alias("w"))
    cut = cut.select("cls", "label", "n", "docs", "band", "mine", "w.*", F.when(F.col("single"), F.pmod(F.xxhash64("label"), F.lit(tasks)))
                     .otherwise(F.xxhash64("label", "w.low_band", "w.low", "w.high_band", "w.high")).alias("task"))
    found = cut.join(sets.select("cls", "ids"), "cls").groupBy("task").applyInPandas(_block_links, "cls long, links long")
    return found.groupBy("cls").agg(F.sum("links").alias("links"))


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest
    doc_id that its links reach, itself included), cls and, with ``count_links``,
    n_links: how many other rows it links with, those with an equal set included.

    Words are runs of bytes other than blank, tab, line feed, vertical tab,
    form feed and return, with A-Z lower-cased; a text of fewer than five words
    is one shingle.  A null, empty or blank text has no shingles and links with
    nothing, so its component is its own id and its n_links 0.  Rows with equal
    sets are linked; repeated rows repeat; null ids never name a component unless
    it has no other id.  Other columns are not read; an empty table gives an empty
    result.
    """
    ship(docs)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    classes = keep_written(document_classes(src), "join-docs")
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    none = [F.lit(0).cast("long").alias("n_links")] if count_links else []
    if total == 0:
        return classes.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "cls", *none)
    links, sets = class_links(src, 6 * total)
    labels = connected_components(links)
    named = classes.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("docs"))
    copies = keep_written(named, "join-classes")
    named = copies.join(labels, F.col("cls") == F.col("node"), "left").select("cls", "low", "docs", F.coalesce("label", "cls").alias("label"))
    lowest = named.groupBy("label").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "label").select("cls", "docs", "component_id")
    if count_links:
        named = named.join(link_counts(sets, labels, copies.select("cls", "docs")), "cls", "left").withColumn(
            "n_links", F.coalesce("links", F.lit(0)) + F.col("docs") - 1)
        none = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    named = keep_written(named.withColumnRenamed("cls", "c").drop("docs", "links"), "join-components")
    return classes.join(named, F.col("cls") == F.col("c"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "cls", *none)
