"""Masked pseudo-likelihood of documents under a window network.

Every word of the corpus is counted.  The vocabulary grows with the root of the
corpus: its most frequent words have embeddings of their own, all others share
those of shape classes (length, last letter).  A bidirectional network predicts
every token from the words in a window on both of its sides: position-weighted
embeddings, one tanh layer, and a softmax in levels: class, symbol within class,
and, for symbols that are shape classes, the word by its count within the shape,
so that every word has its own probability.  The network is trained with numpy
inside Spark tasks: every task runs stochastic gradient steps over masked
positions of its own documents, parameters are averaged over all tasks in
blocks, each embedding weighted by how often a task saw its word, and the average
starts the next round.  The rounds mask different positions, so each position is
predicted once.  All documents take part in counting, training and scoring; a
document's score is the sum of its tokens' conditional log-probabilities.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_written, mix, ship, text_chunks, word_hashes, words

CLASSES = 32
HEAD = CLASSES * 24            # most frequent words, symbols of the softmax
SYMBOLS = CLASSES * CLASSES    # with the shape classes of the other words
SHAPES = SYMBOLS - HEAD
WORDS_PER_ROOT = 2             # further words of the vocabulary per square root of the corpus' words
DIM = 16
SIDE = 2                       # words seen on each side
ROUNDS = 2                     # each masks its share of all positions
BATCH = 2048
RATE = 0.5
ROWS = 4096                    # parameter rows of DIM numbers in a block


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Shape class of each word: length and kind of its last byte."""
    length = np.minimum(end - start, 31)
    last = data[end - 1]
    kind = np.where(last >= 128, 0, np.where((last >= 48) & (last < 58), 1, np.where(((last | 32) >= 97) & ((last | 32) < 123), 2 + (last | 32) % 5, 7)))
    return ((length * 8 + kind) % SHAPES).astype(np.int32)


@dataclass
class Vocabulary:
    """Tokens 0 to n_words - 1 are words by descending count, the next SHAPES ones
    the shapes of all other words, and one more stands for places outside a text."""

    hashes: np.ndarray  # sorted
    ids: np.ndarray     # token of each hash
    symbol: np.ndarray  # softmax symbol of each token
    within: np.ndarray  # log-probability of a word given that symbol

    @property
    def n_words(self) -> int:
        return len(self.hashes)

    @property
    def pad(self) -> int:
        return self.n_words + SHAPES

    def tokens(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of concatenated texts, and each text's first token."""
        start, end, first = words(data, off)
        h = word_hashes(data, start, end)
        if len(h) == 0:
            return np.zeros(0, np.int32), first
        out = _shapes(data, start, end) + np.int32(self.n_words)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            out[known] = self.ids[at[known]]
        return out, first


def vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts every word of all rows (column text).  The driver gets the
    vocabulary's words only, at most HEAD and WORDS_PER_ROOT times the square root of the corpus' words."""
    def count(batches):
        held, size = [], 0
        for _, data, off in text_chunks(batches):
            start, end, _ = words(data, off)
            h, at, n = np.unique(word_hashes(data, start, end), return_index=True, return_counts=True)
            held.append((h, n, _shapes(data, start[at], end[at])))
            size += len(h)
            if size > 2_000_000:
                yield _counts(held)
                held, size = [], 0
        yield _counts(held)

    counts = docs.select("text").mapInArrow(count, "h long, n long, shape int").groupBy("h").agg(F.sum("n").alias("n"), F.min("shape").alias("shape"))
    counts = keep_written(counts, "lm-counts")
    total, distinct = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).collect():  # at most SHAPES rows
        total[r["shape"]], distinct[r["shape"]] = r["n"], r["d"]
    size = HEAD + WORDS_PER_ROOT * math.ceil(math.sqrt(total.sum()))
    # words of one count are in or out together; there are at most sqrt(2 n) different counts of n words
    levels = counts.groupBy("n").agg(F.count(F.lit(1)).alias("d")).toPandas().sort_values("n", ascending=False)
    levels = levels["n"][levels["d"].cumsum() <= size]
    least = int(levels.iloc[-1]) if len(levels) else 1 << 62
    top = counts.where(F.col("n") >= least).toPandas().sort_values(["n", "h"], ascending=[False, True])
    return listed(top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.float64), top["shape"].to_numpy(np.int64), total, distinct)


def listed(h: np.ndarray, n: np.ndarray, shape: np.ndarray, total: np.ndarray, distinct: np.ndarray) -> Vocabulary:
    """Vocabulary of words by descending count, given all counts and distinct words
    of each shape.  Words outside share what the listed ones leave of their shape."""
    k = len(h)
    tail = np.arange(k) >= HEAD
    rest = total - np.bincount(shape[~tail], n[~tail], SHAPES)        # counted in the shape class
    left = total - np.bincount(shape, n, SHAPES)                      # of words without an embedding
    each = left / np.maximum(distinct - np.bincount(shape, minlength=SHAPES), 1)
    symbol = np.concatenate((np.where(tail, HEAD + shape, np.arange(k)), HEAD + np.arange(SHAPES), [0])).astype(np.int32)
    within = np.zeros(k + SHAPES + 1)
    within[:k][tail] = np.log(n[tail] / rest[shape[tail]])
    # a word never counted, in a text of another corpus, gets less than one occurrence
    within[k:k + SHAPES] = np.log(np.where(each > 0, each, 0.5) / np.maximum(rest, 1))
    order = np.argsort(h)
    return Vocabulary(h[order], np.arange(k, dtype=np.int32)[order], symbol, within)


def _counts(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Sum of several (hashes, counts, shapes)."""
    h = np.concatenate([x[0] for x in held]) if held else np.zeros(0, np.uint64)
    n = np.concatenate([x[1] for x in held]) if held else np.zeros(0, np.int64)
    shape = np.concatenate([x[2] for x in held]) if held else np.zeros(0, np.int32)
    order = np.argsort(h, kind="stable")
    h, n, shape = h[order], n[order], shape[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    n = np.add.reduceat(n, first) if len(first) else n
    return pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(n.astype(np.int64)), pa.array(shape[first], pa.int32())], ["h", "n", "shape"])


class Network:
    """Parameters as rows of DIM float32 numbers: an embedding per token, then
    position weights, layer, class weights, symbol weights of each class."""

    REST = (("pos", (2 * SIDE, DIM)), ("layer", (DIM, DIM)), ("bias", (DIM,)), ("cls", (DIM, CLASSES)), ("cls_b", (CLASSES,)),
            ("word", (CLASSES, DIM, CLASSES)), ("word_b", (CLASSES, CLASSES)))
    REST_ROWS = -(-sum(math.prod(s) for _, s in REST) // DIM)

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n = len(rows) - self.REST_ROWS
        self.emb, flat, at = rows[:n], rows[n:].reshape(-1), 0
        for name, shape in self.REST:
            setattr(self, name, flat[at:at + math.prod(shape)].reshape(shape))
            at += math.prod(shape)

    @classmethod
    def start(cls, vocab: Vocabulary) -> Network:
        net = cls(np.zeros((vocab.pad + 1 + cls.REST_ROWS, DIM), np.float32))
        rng = np.random.default_rng(5)
        # a word outside the softmax starts where its shape does
        net.emb[:] = rng.normal(0, 0.3, (SYMBOLS, DIM)).astype(np.float32)[vocab.symbol]
        net.emb[vocab.pad] = rng.normal(0, 0.3, DIM)
        net.pos[:] = 1.0
        net.layer[:] = rng.normal(0, DIM ** -0.5, net.layer.shape)
        return net

    def logits(self, ctx: np.ndarray, target: np.ndarray):
        """Class logits and, for targets sorted by class, logits within the
        target's class; and what the backward step needs."""
        e = np.take(self.emb, ctx, axis=0)                           # n x 2S x D
        x = np.einsum("nsd,sd->nd", e, self.pos) / (2 * SIDE)
        h = np.tanh(x @ self.layer + self.bias)
        cls, member = target // CLASSES, target % CLASSES
        a = h @ self.cls + self.cls_b
        edges = np.searchsorted(cls, np.arange(CLASSES + 1))
        b = np.empty_like(a)
        for c in range(CLASSES):
            i, j = edges[c], edges[c + 1]
            if j > i:
                b[i:j] = h[i:j] @ self.word[c] + self.word_b[c]
        # exp cannot overflow below this bound on the logits (|h| is at most 1)
        bound = max(np.abs(self.cls).sum(0).max() + np.abs(self.cls_b).max(), np.abs(self.word).sum(1).max() + np.abs(self.word_b).max())
        if bound > 80:
            a -= a.max(1, keepdims=True)
            b -= b.max(1, keepdims=True)
        return a, b, (e, x, h, cls, member, edges)

    def logprob(self, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target (symbols, sorted by class) given its context."""
        a, b, (*_, cls, member, _) = self.logits(ctx, target)
        n, ones = np.arange(len(target)), np.ones(CLASSES, np.float32)
        out = a[n, cls] + b[n, member]
        return out - np.log(np.exp(a, out=a) @ ones) - np.log(np.exp(b, out=b) @ ones)

    def step(self, ctx: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One stochastic gradient step on the masked positions."""
        a, b, (e, x, h, cls, member, edges) = self.logits(ctx, target)
        n, ones = np.arange(len(target)), np.ones(CLASSES, np.float32)
        for p in (a, b):
            np.exp(p, out=p)
            p /= (p @ ones)[:, None]
        r = rate / len(target)
        a[n, cls] -= 1.0
        b[n, member] -= 1.0
        dh = a @ self.cls.T
        for c in range(CLASSES):
            i, j = edges[c], edges[c + 1]
            if j > i:
                dh[i:j] += b[i:j] @ self.word[c].T
                self.word[c] -= r * (h[i:j].T @ b[i:j])
                self.word_b[c] -= r * b[i:j].sum(0)
        self.cls -= r * (h.T @ a)
        self.cls_b -= r * a.sum(0)
        dz = dh * (1.0 - h * h)
        dx = (dz @ self.layer.T) / (2 * SIDE)
        self.layer -= r * (x.T @ dz)
        self.bias -= r * dz.sum(0)
        de = dx[:, None, :] * self.pos
        self.pos -= r * np.einsum("nsd,nd->sd", e, dx)
        order = stable_order(ctx.ravel(), len(self.emb))
        ids = ctx.ravel()[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        self.emb[ids[first]] -= r * np.add.reduceat(de.reshape(-1, DIM)[order], first, axis=0)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(doc_id, tokens): each row's token ids, four bytes each; written once and
    read by every round of training and by scoring."""
    bc = docs.sparkSession.sparkContext.broadcast(vocab)

    def scan(batches):
        for b, data, off in text_chunks(batches):
            tokens, first = bc.value.tokens(data, off)
            raw = tokens.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([raw[4 * i:4 * j] for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())],
                ["doc_id", "tokens"])

    return keep_written(docs.mapInArrow(scan, "doc_id long, tokens binary"), "lm-tokens")


def token_chunks(batches):
    """Chunks of encoded rows with their tokens and each row's first token."""
    for b, data, off in text_chunks(batches, "tokens"):
        yield b, np.frombuffer(data.tobytes(), "<u4").astype(np.int32), off // 4


def spaced(tokens: np.ndarray, first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with SIDE ``pad`` tokens around each, and the place of each token there."""
    place = np.arange(len(tokens)) + np.repeat(SIDE * np.arange(1, len(first)), np.diff(first))
    laid = np.full(len(tokens) + SIDE * len(first), pad, tokens.dtype)
    laid[place] = tokens
    return laid, place


def contexts(laid: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of the SIDE tokens before and after each position of ``spaced`` texts."""
    shift = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])
    return laid[place[at][:, None] + shift]


def stable_order(ids: np.ndarray, bound: int) -> np.ndarray:
    """Stable ascending order of ids below ``bound``, by 16 bits at a time."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    return order[np.argsort((ids >> 16).astype(np.uint16)[order], kind="stable")] if bound > 1 << 16 else order


def train(encoded: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameter rows after ``rounds`` rounds of local steps and averaging over all
    encoded rows.  Each round masks the positions that no other one masks."""
    sc = encoded.sparkSession.sparkContext
    params, pad = Network.start(vocab).rows, vocab.pad
    symbols = sc.broadcast(vocab.symbol)
    for k in range(rounds):
        bc = sc.broadcast(params)

        def local(batches, k=k, bc=bc):
            net, symbol, seen, steps = Network(bc.value.copy()), symbols.value, 0, 0
            weight = np.zeros(len(net.rows))
            for _, tokens, first in token_chunks(batches):
                if len(tokens) < 2:
                    continue
                # which positions are masked depends on the text around them only
                h = mix(tokens.astype(np.uint64) * np.uint64(1000003) + (np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64))
                masked = np.flatnonzero(h % np.uint64(rounds) == k)
                masked = masked[np.argsort(mix(h[masked]), kind="stable")]
                laid, place = spaced(tokens, first, pad)
                for i in range(0, len(masked), BATCH):
                    at = masked[i:i + BATCH]
                    target = symbol[tokens[at]]
                    order = stable_order(target, SYMBOLS)
                    at, target = at[order], target[order]
                    net.step(contexts(laid, place, at), target, RATE / (1 + steps / 300) ** 0.5 / (1 + k))
                    steps += 1
                seen += len(masked)
                weight[:pad] += np.bincount(tokens, minlength=pad)
            weight[pad:] = seen
            for i in range(0, len(net.rows), ROWS):
                w = weight[i:i + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // ROWS], pa.int32()), pa.array([seen % 61], pa.int32()),
                     pa.array([(net.rows[i:i + ROWS] * w[:, None]).astype(np.float32).tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())],
                    ["block", "lane", "params", "weight"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            sums = [np.sum([np.frombuffer(x, t) for x in pdf[c]], axis=0, dtype=np.float64).astype(t).tobytes()
                    for c, t in (("params", np.float32), ("weight", np.float64))]
            return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "lane": [0], "params": sums[:1], "weight": sums[1:]})

        schema = "block int, lane int, params binary, weight binary"
        parts = encoded.select("tokens").mapInArrow(local, schema)
        # two levels, so no task sums the parameters of more than a share of the tasks
        parts = parts.groupBy("block", "lane").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
        params = params.copy()
        for r in parts.toLocalIterator():  # one set of parameters
            i = r["block"] * ROWS
            w = np.frombuffer(bytes(r["weight"]))
            mean = np.frombuffer(bytes(r["params"]), np.float32).reshape(-1, DIM) / np.maximum(w, 1)[:, None]
            params[i:i + ROWS][w > 0] = mean[w > 0]
    return params


def score(encoded: DataFrame, vocab: Vocabulary, params: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, sum_logprob and mean_logprob for every row.

    A null, empty or blank text has 0 tokens, a sum of 0 and a null mean.  The
    whole text is scored, however long; equal texts score equally; there is no
    shuffle; other columns are not read; an empty table gives an empty result.
    """
    bc = encoded.sparkSession.sparkContext.broadcast((params, vocab.symbol, vocab.within, vocab.pad))

    def scan(batches):
        params, symbol, within, pad = bc.value
        net = Network(params)
        for b, tokens, first in token_chunks(batches):
            logp = within[tokens]
            target = symbol[tokens]
            order = stable_order(target, SYMBOLS)
            laid, place = spaced(tokens, first, pad)
            for i in range(0, len(order), BATCH):
                at = order[i:i + BATCH]
                logp[at] += net.logprob(contexts(laid, place, at), target[at])
            total = np.concatenate(([0.0], np.cumsum(logp)))
            n = np.diff(first)
            s = np.where(n > 0, total[first[1:]] - total[first[:-1]], 0.0)
            mean = pa.array(s / np.maximum(n, 1), pa.float64(), mask=n == 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(s, pa.float64()), mean],
                                             ["doc_id", "n_tokens", "sum_logprob", "mean_logprob"])

    return encoded.mapInArrow(scan, "doc_id long, n_tokens long, sum_logprob double, mean_logprob double")


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, trains and scores over all rows; see ``score``.  The scores are
    written once, so later actions do not train again."""
    ship(docs)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vocab = vocabulary(src)
    encoded = encode(src, vocab)
    return keep_written(score(encoded, vocab, train(encoded, vocab)), "lm-scores")
