"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, fitted with follow-the-regularised-leader (proximal,
per-coordinate rates) under an elastic-net penalty, then temperature-scaled.

Features are hashed 1- to 3-grams of the letters of the whole text, in lower
case, every run of other characters counting as one gap.  Inverse document
frequencies are counted over all training rows, in Spark; the regression is
fitted on a bounded hash sample of them (``max_rows``, split evenly over the
languages); a part of that sample is held back for the temperature.
Prediction is one pass without a shuffle: n-gram weights are gathered and
summed per text with numpy.
"""

from __future__ import annotations

import functools
import pickle
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, string_parts, text_chunks

BITS = 16
UNDETERMINED = "und"
#: Bound of the labelled sample that the regression is fitted on.
MAX_ROWS = 3_000
#: Positions whose n-grams are hashed at once; bounds the scratch arrays.
BLOCK = 1 << 17
#: Languages at most; a corpus with more labels than this is refused.
MAX_LANGUAGES = 512


@functools.cache
def _letters() -> np.ndarray:
    """Per code point: its lower-case code point if a letter, else 0."""
    t = np.zeros(0x110000, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            t[i] = ord(low) if len(low) == 1 else i
    return t


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of concatenated UTF-8 texts and each text's bounds in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return points, before[off]


def _collapse(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of concatenated texts in lower case, one 0 for every run of other
    characters and at the end of every text, and each text's bounds in them."""
    points, bounds = code_points(data, off)
    c = _letters()[points]
    # every text ends in a gap, so no n-gram of letters spans two texts
    c = np.insert(c, bounds[1:], 0)
    bounds = bounds + np.arange(len(bounds))
    # one gap stands for a run of other characters
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    keep[bounds[:-1][np.diff(bounds) > 0]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return c[keep], kept[bounds]


def _hashed(c: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams that start at positions lo to hi - 1 of c, and how many
    of them start before each of these positions and hi."""
    scale = np.uint64(0x9E3779B97F4A7C15)
    down = np.uint64(64 - BITS)
    pad = np.zeros(hi - lo + 2, np.uint64)
    pad[:min(len(c), hi + 2) - lo] = c[lo:hi + 2]
    one, two, three = pad[:-2], pad[1:-1], pad[2:]
    base = one * np.uint64(0x2545F4914F6CDD1D)
    pair = (base ^ two) * np.uint64(0xD6E8FEB86659FD93)
    grams = np.stack([(base * scale) >> down, ((pair + np.uint64(1)) * scale) >> down,
                      (((pair ^ three) * np.uint64(0xA0761D6478BD642F) + np.uint64(2)) * scale) >> down], 1)
    # a bigram or trigram that would start in a gap at the end of the text reads the next text: drop those that begin in a gap
    ok = np.stack([one != 0, one != 0, (one != 0) & (two != 0)], 1)
    return grams[ok].astype(np.int32), np.concatenate(([0], np.cumsum(ok.sum(1))))


def ngrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of concatenated texts, text by text, and their bounds."""
    c, bounds = _collapse(data, off)
    grams, per = _hashed(c, 0, len(c))
    return grams, per[bounds]


def gram_blocks(data: np.ndarray, off: np.ndarray, block: int = BLOCK):
    """The same block by block: (index of the block's first text, n-grams, their
    bounds by text).  A text may go on in the next block, so scratch arrays
    stay small however long a text is."""
    c, bounds = _collapse(data, off)
    for lo in range(0, len(c), block):
        hi = min(lo + block, len(c))
        grams, per = _hashed(c, lo, hi)
        first, last = int(np.searchsorted(bounds, lo, "right")) - 1, int(np.searchsorted(bounds, hi, "left"))
        yield first, grams, per[np.clip(bounds[first:last + 1], lo, hi) - lo]


class Model:
    """weights[bucket, class] with the inverse document frequency folded in."""

    def __init__(self, classes: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.classes, self.weights, self.bias, self.temperature = classes, weights, bias, temperature

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class index, calibrated probability and whether the text has a letter."""
        n, logits = np.zeros(len(off) - 1, np.int64), np.zeros((len(off) - 1, len(self.classes)))
        for first, grams, bounds in gram_blocks(data, off):
            k = np.diff(bounds)
            some = np.flatnonzero(k)
            if len(some):
                logits[first + some] += np.add.reduceat(self.weights[grams], bounds[:-1][some], axis=0, dtype=np.float64)
                n[first + some] += k[some]
        logits = logits / np.maximum(n, 1)[:, None] + self.bias
        z = logits / self.temperature
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return best, p[np.arange(len(best)), best], n > 0


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal multinomial regression over sparse rows (index, value);
    returns the weights (2**BITS x classes) and bias."""
    dim = (1 << BITS) + 1
    z, n = np.zeros((dim, n_classes)), np.zeros((dim, n_classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            idx, val = rows[r]
            idx, val = np.append(idx, dim - 1), np.append(val, 1.0)
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            s = val @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[r]] -= 1.0
            g = val[:, None] * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[idx] = zi + g - sigma * w
            n[idx] = ni + g * g
    w = weights(z, n)
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden section."""
    if len(labels) == 0:
        return 1.0

    def loss(log_t):
        s = logits / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(labels)), labels]).mean())

    lo, hi, g = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that hold each hashed n-gram, and texts in all, over every row.
    Each task adds up its own vector; vectors meet in blocks of buckets."""
    block = 1 << (BITS - 5)

    def count(batches):
        df, docs = np.zeros(1 << BITS, np.int64), 0
        for b, data, off in text_chunks(batches):
            docs += b.num_rows
            seen, current = np.zeros(1 << BITS, bool), -1
            for first, grams, bounds in gram_blocks(data, off):
                for t, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    if first + t != current:
                        df += seen
                        seen[:] = False
                        current = first + t
                    seen[grams[i:j]] = True
            df += seen
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(32), pa.int32()), pa.array([df[k * block:(k + 1) * block].tobytes() for k in range(32)], pa.binary()),
             pa.array([docs] * 32, pa.int64())], ["block", "counts", "docs"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, np.int64) for c in pdf["counts"]], axis=0)
        return pd.DataFrame({"block": [int(pdf["block"][0])], "counts": [total.tobytes()], "docs": [int(pdf["docs"].sum())]})

    schema = "block int, counts binary, docs long"
    rows = train.select("text").mapInArrow(count, schema).groupBy("block").applyInPandas(add, schema).collect()
    df = np.zeros(1 << BITS, np.int64)
    for r in rows:
        df[r["block"] * block:(r["block"] + 1) * block] = np.frombuffer(bytes(r["counts"]), np.int64)
    return df, max((r["docs"] for r in rows), default=0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        max_rows: int = MAX_ROWS) -> Model | None:
    """Model learnt from rows with a text and a label.  None without such rows."""
    src = ship(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.col(label_col).cast("string").alias("label")).where("text is not null and label is not null")
    per = {r["label"]: r["count"] for r in src.groupBy("label").count().orderBy("label").limit(MAX_LANGUAGES + 1).collect()}
    if not per:
        return None
    if len(per) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled")
    classes = sorted(per)
    quota = max(1, max_rows // len(classes))
    share = F.lit(0.0)
    for c in classes:
        share = F.when(F.col("label") == c, min(1.0, quota / per[c])).otherwise(share)
    coin = F.pmod(F.xxhash64(F.coalesce("id", F.lit(""))), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = src.where(coin < share)
    df, n_docs = document_frequencies(src)
    idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
    scale = 32.0  # relative frequencies are small; this only sets the unit of the weights

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["label", "id", "text"]).reset_index(drop=True)
        rows = []
        for text in pdf["text"]:
            cnt = np.zeros(1 << BITS, np.int64)
            for _, grams, _ in gram_blocks(*string_parts(pa.array([text], pa.string()))):
                cnt += np.bincount(grams, minlength=1 << BITS)
            idx = np.flatnonzero(cnt)
            rows.append((idx, cnt[idx] / max(1, int(cnt.sum())) * idf[idx] * scale))
        y = np.searchsorted(classes, pdf["label"].to_numpy())
        back = np.arange(len(rows)) % 5 == 4 if len(rows) >= 20 else np.zeros(len(rows), bool)
        w, b = ftrl([rows[i] for i in np.flatnonzero(~back)], y[~back], len(classes))
        logits = np.array([b + v @ w[i] for i, v in (rows[k] for k in np.flatnonzero(back))]).reshape(-1, len(classes))
        t = temperature(logits, y[back])
        model = Model(classes, (w * (idf * scale)[:, None]).astype(np.float32), b, t)
        return pd.DataFrame({"model": [pickle.dumps((model.classes, model.weights, model.bias, model.temperature))]})

    learnt = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "model binary").collect()
    if not learnt:  # the coin left no row of a tiny table: take its first rows
        learnt = src.orderBy("id").limit(quota).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "model binary").collect()
    return Model(*pickle.loads(bytes(learnt[0]["model"])))


_MODELS: dict[int, Model] = {}


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred",
                  score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability.

    Every row is kept with all its columns, nothing is shuffled.  A text that
    is null or has no letter gets ``und`` with score 1; so does every row if
    there was nothing to learn from (score 0 for texts with letters).  Equal
    texts get equal results.  Output columns replace columns of the same name.
    """
    sc = ship(docs).sparkSession.sparkContext
    bc = sc.broadcast(None if model is None else (model.classes, model.weights, model.bias, model.temperature))

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = None if bc.value is None else Model(*bc.value)
        langs, scores = [], []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        for part, data, off in text_chunks(iter([batch])):
            if m is None:
                _, bounds = ngrams(data, off)
                lang, score, letters = np.array([UNDETERMINED] * part.num_rows, object), np.zeros(part.num_rows), np.diff(bounds) > 0
            else:
                best, score, letters = m.predict(data, off)
                lang = np.array(m.classes, object)[best]
            langs += np.where(letters, lang, UNDETERMINED).tolist()
            scores += np.where(letters, score, 1.0).tolist()
        return pd.DataFrame({"lang": langs, "score": scores})

    out = docs.withColumn("__language", predict(F.col(text_col).cast("string")))
    return out.withColumns({lang_out: F.col("__language.lang"), score_out: F.col("__language.score")}).drop("__language")


assert sys.byteorder == "little"
