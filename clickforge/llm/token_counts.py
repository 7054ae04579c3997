"""Exact byte-pair token counts at every prefix of a text.

Dynamic programming over prefixes: the encoding of a prefix of a pre-token
ends in the one token that is a suffix of the prefix and *compatible* with the
last token of what precedes it (encoding both together gives exactly the
two).  So last token and count of prefix i follow from shorter prefixes, one
pass gives the count of every prefix, and truncation or budget questions need
no second encoding.  Pre-tokens follow the byte-level split pattern; counts of
whole texts are running sums over pre-tokens, kept per distinct pre-token in a
cache of bounded size.
"""

from __future__ import annotations

import json
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_chunks, word_hashes

# The byte-level split pattern of the tokenizer's pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _latin_split() -> re.Pattern:
    """The same split for texts of characters below 256 only, with its classes
    listed by the rule above: the standard matcher then takes under half the time."""
    members = lambda p: "".join(re.escape(chr(i)) for i in range(256) if regex.fullmatch(p, chr(i)))
    letter, number, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


#: Distinct pre-tokens kept per worker before the cache starts anew.
CACHE_ENTRIES = 700_000


def _byte_letters() -> dict[str, int]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= 2 * CACHE_ENTRIES:
            self.clear()
        self[key] = value = self.make(key)
        return value


class PrefixCounter:
    """Prefix token counts under a byte-level BPE vocabulary file (.json)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = _byte_letters()
        to_bytes = lambda s: bytes(letter[c] for c in s)
        special = [a["content"] for a in spec.get("added_tokens", [])]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        made = {a + b for a, b in self.rank} | {bytes([i]) for i in range(256)}
        # only tokens that their own bytes encode to can occur
        self.vocab = {t for t in made if len(t) == 1 or self.encode(t) == [t]}
        self.endings = {t[i:] for t in self.vocab for i in range(len(t))}
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.split = regex.compile(SPLIT)
        self.latin = _latin_split()
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.total = _Cache(lambda w: self.bytes_counts(w.encode())[-1])
        self.recent = (b"", [0], [b""])

    def encode(self, w: bytes) -> list[bytes]:
        """Plain merge loop; used for tokens and pairs of tokens only."""
        parts = [w[i:i + 1] for i in range(len(w))]
        rank = self.rank
        while len(parts) > 1:
            best, at = min(((rank.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1)))
            if best == 1 << 60:
                break
            pair = (parts[at], parts[at + 1])
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def compatible(self, a: bytes, b: bytes) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            known = self.pairs[a, b] = self.encode(a + b) == [a, b]
        return known

    def bytes_counts(self, w: bytes) -> list[int]:
        """counts[i]: tokens of the first i bytes of one pre-token.  What the
        preceding call shares as a prefix is taken from it, so sorted
        pre-tokens cost little more than their distinct endings."""
        old, counts, last = self.recent
        k, m = 0, min(len(old), len(w))
        while k < m and old[k] == w[k]:
            k += 1
        del counts[k + 1:], last[k + 1:]
        vocab, endings, pairs = self.vocab, self.endings, self.pairs
        for i in range(k + 1, len(w) + 1):
            fits, j = [], i - 1
            while j >= 0 and (t := w[j:i]) in endings:
                if t in vocab:
                    fits.append((j, t))
                j -= 1
            for j, t in reversed(fits):
                if j == 0:
                    counts.append(1)
                    last.append(t)
                    break
                known = pairs.get((last[j], t))
                if known is None:
                    known = self.compatible(last[j], t)
                if known:
                    counts.append(counts[j] + 1)
                    last.append(t)
                    break
        self.recent = (w, counts, last)
        return counts

    def learn(self, pieces: set[str]) -> None:
        """Put the counts of all pieces into the cache, in sorted order."""
        missing = sorted(w.encode() for w in pieces if w not in self.total)
        if len(self.total) + len(missing) > CACHE_ENTRIES:
            self.total.clear()
            missing = sorted(w.encode() for w in pieces)
        put = super(_Cache, self.total).__setitem__
        for w in missing:
            put(w.decode(), self.bytes_counts(w)[-1])

    def segments(self, text: str):
        """(is_special, part) in order."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield False, text[at:m.start()]
            yield True, m.group()
            at = m.end()
        if at < len(text):
            yield False, text[at:]

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split.findall(text)
        return self.latin.findall(text)

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        total = 0
        for special, part in self.segments(text):
            total += 1 if special else sum(map(self.total.__getitem__, self.pieces(part)))
        return total

    def char_counts(self, w: str) -> list[int]:
        """Counts after each character of one pre-token."""
        c = self.bytes_counts(w.encode())
        return c[1:] if len(c) == len(w) + 1 else [c[i] for i in accumulate(len(x.encode()) for x in w)]

    def prefix_counts(self, text: str, budget: int | None = None) -> np.ndarray:
        """counts[i]: tokens that encoding text[:i] alone would give, i from 0 to
        the length.  With a budget, only as far as later prefixes can still be
        within it."""
        out, base = [0], 0
        for special, part in self.segments(text):
            if special:
                # a cut inside the special string leaves ordinary characters after the segment before
                before = text[:len(out) - 1]
                out += [self.count(before + part[:i]) for i in range(1, len(part))]
                base += 1
                out.append(base)
                continue
            for m in self.split.finditer(part):
                w = m.group()
                if w.isspace() and m.end() < len(part):
                    # a prefix that ends after the next white-space character takes the run whole
                    run = w + part[m.end()] if part[m.end()].isspace() else w
                else:
                    run = w
                counts = self.char_counts(run)[:len(w)]
                if w in ("'re", "'ve", "'ll"):  # 're, 've, 'll cut after two letters are not contractions
                    counts = [counts[0], self.total["'"] + self.total[w[1]], counts[2]]
                if out and len(w) > 1 and w[0] == " " and len(out) > 1 and text[len(out) - 2].isspace():
                    # the blank that leads this word still belonged to the white space before it
                    k = len(out) - 1
                    while k and text[k - 1].isspace():
                        k -= 1
                    counts[0] = self.total[text[k:len(out)]] - self.total[text[k:len(out) - 1]]
                elif w.isspace() and len(out) > 1 and text[len(out) - 2].isspace() and not special:
                    k = len(out) - 1
                    while k and text[k - 1].isspace():
                        k -= 1
                    lead = self.total[text[k:len(out) - 1]]
                    counts = [c - lead for c in self.char_counts(text[k:len(out) - 1] + w)[len(out) - 1 - k:]]
                out += [base + c for c in counts]
                base += self.total[w]
                if budget is not None and base > budget:
                    return np.asarray(out, np.int32)
        return np.asarray(out, np.int32)

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix that encodes to at most ``budget`` tokens."""
        if self.special and self.special.search(text):
            return int(np.flatnonzero(self.prefix_counts(text, budget) <= budget)[-1])
        pieces = self.pieces(text)
        return self.fit_pieces(text, pieces, list(map(self.total.__getitem__, pieces)), budget)

    def fit_pieces(self, text: str, pieces: list[str], counts: list[int], budget: int) -> int:
        """The same from the pre-tokens and their counts: only the stretch that crosses the budget
        is looked at character by character, from a pre-token on that no white
        space before it can change."""
        k, base = len(pieces), 0
        for i, total in enumerate(accumulate(counts)):
            if total > budget:
                k = i
                break
            base = total
        if k == len(pieces):
            return len(text)
        while k and not (pieces[k][0] == " " and not pieces[k].isspace() and not pieces[k - 1].isspace()):
            k -= 1
            base -= counts[k]
        at = sum(map(len, pieces[:k]))
        ahead = self.prefix_counts(text[at:], budget - base)
        return at + int(np.flatnonzero(ahead <= budget - base)[-1])


LETTER, NUMBER, SPACE, OTHER = range(4)


def _kinds() -> np.ndarray:
    """Class of every code point under the split pattern."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, p in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(p, points):
            out[ord(points[m.start()]):ord(points[m.end() - 1]) + 1] = kind
    return out


class TotalCounter:
    """Token counts of whole texts without their prefixes: the pre-tokens of all
    texts of a chunk are cut and looked up at once.  A table of fixed size holds
    counts by the pre-token's 64-bit hash; a place taken by another one is
    overwritten, so its memory is bounded and what is missing is counted again."""

    SLOTS = 1 << 20

    def __init__(self, prefixes: PrefixCounter):
        self.prefixes = prefixes
        self.kinds = _kinds()
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.held = np.zeros(self.SLOTS, np.int64)  # 0: empty, as every pre-token has a token

    def starts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte of each pre-token of concatenated texts, and each text's
        first pre-token."""
        if data.max() < 128:
            points, text = data, off
        else:
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            points, text = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4"), np.searchsorted(lead, off)
        kind, n = self.kinds[points], len(points)
        new = np.zeros(n + 1, bool)
        new[text] = True
        start = new[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # of white space before something else the last character is apart; a blank leads what follows
        after = np.flatnonzero(start[1:] & ~new[1:n] & (kind[:-1] == SPACE)) + 1
        start[after - 1] = True
        start[after[points[after - 1] == ord(" ")]] = False
        # contractions: an apostrophe that begins a pre-token, and one or two letters
        at = np.flatnonzero(start[:-1] & (points[:-1] == ord("'")))
        at = at[(kind[at + 1] == LETTER) & ~new[at + 1]]
        a, b = points[at + 1], np.where(new[at + 2], 0, points[np.minimum(at + 2, n - 1)])
        is_two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        size = np.where(np.isin(a, [ord(c) for c in "stmd"]), 2, np.where(is_two, 3, 0))
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        rest = (at + size)[~new[at + size]]
        start[rest[kind[rest] == LETTER]] = True
        found = np.flatnonzero(start)
        first = np.searchsorted(found, text)
        return (found if points is data else lead[found]), first

    def counts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Tokens of each of the concatenated texts."""
        if len(data) == 0:
            return np.zeros(len(off) - 1, np.int64)
        start, first = self.starts(data, off)
        end = np.append(start[1:], len(data))
        h = word_hashes(data, start, end, fold=False)
        slot = (h & np.uint64(self.SLOTS - 1)).astype(np.int64)
        n = np.where(self.keys[slot] == h, self.held[slot], 0)
        raw, missing = data.tobytes(), np.flatnonzero(n == 0)
        if len(missing):
            _, at, of = np.unique(h[missing], return_index=True, return_inverse=True)
            at = missing[at]
            pieces = [raw[i:j] for i, j in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            count = np.zeros(len(at), np.int64)
            for k in sorted(range(len(at)), key=pieces.__getitem__):  # neighbours share prefixes
                count[k] = self.prefixes.bytes_counts(pieces[k])[-1]
            n[missing] = count[of]
            self.keys[slot[at]], self.held[slot[at]] = h[at], count
        total = np.concatenate(([0], np.cumsum(n)))
        out = total[first[1:]] - total[first[:-1]]
        special = self.prefixes.special
        if special and special.search(raw.decode()):
            for d, (i, j) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                if special.search(text := raw[i:j].decode()):
                    out[d] = self.prefixes.count(text)
        return out


_COUNTERS: dict[str, PrefixCounter] = {}
_TOTALS: dict[str, TotalCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def total_counter(path: str) -> TotalCounter:
    """Likewise for counts of whole texts."""
    if path not in _TOTALS:
        _TOTALS[path] = TotalCounter(counter(path))
    return _TOTALS[path]


def token_counts(docs: DataFrame, path: str, budget: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars (characters of the
    longest prefix within ``budget`` tokens) for every row.

    A null or empty text has 0 bytes, 0 tokens and fits.  Special strings in
    a text count as one token, as the vocabulary's library takes them by
    default.  Repeated rows and ids give repeated results; an empty table an
    empty one; other columns are not read.  No row moves: there is no shuffle.
    """
    def scan(batches):
        c = counter(path)
        for b, data, off in text_chunks(batches):
            raw = data.tobytes()
            texts = [raw[i:j].decode() for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            pieces = [None if c.special and c.special.search(t) else c.pieces(t) for t in texts]
            c.learn(set().union(*(p for p in pieces if p)))
            n, fit = [], []
            for t, p in zip(texts, pieces, strict=True):
                counts = None if p is None else list(map(c.total.__getitem__, p))
                k = c.count(t) if p is None else sum(counts)
                n.append(k)
                fit.append(len(t) if k <= budget else c.fit(t, budget) if p is None else c.fit_pieces(t, p, counts, budget))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(off), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > budget for k in n], pa.bool_()), pa.array(fit, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    src = ship(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(scan, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def token_lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and n_tokens for every row: ``token_counts`` without the prefixes, for
    operators that need the length only, by ``TotalCounter``.  The same rules hold."""
    def scan(batches):
        c = total_counter(path)
        for b, data, off in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c.counts(data, off), pa.int64())], ["doc_id", "n_tokens"])

    src = ship(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(scan, "doc_id long, n_tokens long")
