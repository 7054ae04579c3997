"""Toxicity by fuzzy lexicon matching in context.

The lexicon (words and word stems) is learnt from labelled rows: of the
prefixes that are far more frequent in toxic texts, the closed ones (no longer
prefix has the same support).  A trie of the lexicon is intersected with
Levenshtein automata and determinised into one table, which then runs over
every word of every text at once with numpy, so misspelt terms are found at
the cost of exact ones.  Misspellings that clean rows use as words of their
own are learnt and ignored.  Each match is scored in a window of words: quoted
or reported matches count apart from plain ones and from those that address
somebody.  A logistic model with priors turns the counts into a score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_written, mix, ship, shingles, text_chunks, word_hashes, words
from .language_id import _letters, code_points

#: Bounds of the labelled sample that lexicon and weights are fitted on.
MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
#: Labelled toxic rows that a term must occur in.
MIN_SUPPORT = 6
#: Terms of one automaton; a longer lexicon takes several.
PART_TERMS = 96
MIN_STEM, MAX_STEM = 3, 14
WINDOW = 6
# Cues of quotation or report, and of address, in the window of a match.
QUOTES = "\"“”„«»‘’‹›`"
REPORT = frozenset("said says say wrote writes quote quoted quotes called calling call word words term terms phrase insult insults slur "
                   "slurs reported alleged sagte schrieb zitat wort dit écrit mot citation dijo escribió palabra cita".split())
ADDRESS = frozenset("you your you're youre ya u ur yourself du dich dir euch dein deine tu toi te vous votre tú usted ustedes te tus vos".split())
#: exact plain, exact quoted, exact addressed, fuzzy plain, fuzzy quoted, fuzzy addressed, bias: prior means of the weights
PRIOR = np.array([10.0, 3.0, 11.0, 9.0, 2.0, 10.0, -3.0])


def edits_allowed(term: str, stem: bool) -> int:
    """Edits within which a term is matched: stems need more letters."""
    n = len(term) - 2 * stem
    return 2 if n >= 9 else 1 if n >= 5 else 0


class Automaton:
    """Levenshtein automata of all terms, intersected with their trie and
    determinised.  terms: (text, is_stem); a stem matches any word it begins."""

    DEAD, START = 0, 1

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        nodes: list[dict[str, int]] = [{}]
        ends: dict[int, list[int]] = {}
        reach: dict[int, int] = {0: 0}  # most edits any term below a node allows
        for i, (text, stem) in enumerate(terms):
            at, k = 0, edits_allowed(text, stem)
            reach[0] = max(reach[0], k)
            for c in text:
                if c not in nodes[at]:
                    nodes.append({})
                    nodes[at][c] = len(nodes) - 1
                at = nodes[at][c]
                reach[at] = max(reach.get(at, 0), k)
            ends.setdefault(at, []).append(i)
        self.alphabet = sorted({c for t, _ in terms for c in t})
        symbols = [*self.alphabet, None]  # None: any other character

        def closure(items: dict) -> frozenset:
            """Missing characters cost an edit; ('stem', i) stays matched."""
            stack, best = list(items.items()), dict(items)
            while stack:
                at, e = stack.pop()
                if isinstance(at, tuple):
                    continue
                if e < reach[at]:
                    for child in nodes[at].values():
                        if e + 1 <= reach[child] and best.get(child, 99) > e + 1:
                            best[child] = e + 1
                            stack.append((child, e + 1))
            for at, e in list(best.items()):
                if not isinstance(at, tuple):
                    for i in ends.get(at, ()):
                        if terms[i][1] and e <= edits_allowed(*terms[i]):
                            best["stem", i] = min(best.get(("stem", i), 99), e)
            return frozenset(best.items())

        def step(state: frozenset, c) -> frozenset:
            out: dict = {}
            for at, e in state:
                if isinstance(at, tuple):
                    out[at] = min(out.get(at, 99), e)
                    continue
                for ch, child in nodes[at].items():
                    cost = e + (ch != c)
                    if cost <= reach[child]:
                        out[child] = min(out.get(child, 99), cost)
                if e + 1 <= reach[at]:
                    out[at] = min(out.get(at, 99), e + 1)
            return closure(out)

        start = closure({0: 0})
        number = {frozenset(): 0, start: 1}
        table, queue = [[0] * len(symbols)], [start]
        while queue:
            state = queue.pop(0)
            row = []
            for c in symbols:
                nxt = step(state, c)
                if nxt not in number:
                    number[nxt] = len(number)
                    queue.append(nxt)
                row.append(number[nxt])
            table.append(row)
        self.table = np.asarray(table, np.int32)
        #: per state: (term, edits) accepted when the word ends there, least edits first
        self.accepts: dict[int, tuple[int, int]] = {}
        for state, k in number.items():
            found = [(e, at[1]) for at, e in state if isinstance(at, tuple)]
            found += [(e, i) for at, e in state if not isinstance(at, tuple) for i in ends.get(at, ()) if e <= edits_allowed(*terms[i])]
            if found:
                e, i = min(found)
                self.accepts[k] = (i, e)
        self.accepting = np.zeros(len(table), bool)
        self.accepting[list(self.accepts)] = True

    def symbols(self) -> np.ndarray:
        """Code point -> column of the table."""
        t = np.full(0x110000, len(self.alphabet), np.int16)
        low = _letters()
        for i, c in enumerate(self.alphabet):
            t[ord(c)] = i
        letters = np.flatnonzero(low)
        t[letters] = t[low[letters]]
        return t

    def run(self, sym: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """State after each word sym[start:end], 0 where no term can match."""
        state = np.full(len(start), self.START, np.int32)
        alive, pos = np.flatnonzero(end > start), start[end > start].copy()
        state[end <= start] = 0
        while len(alive):
            s = self.table[state[alive], sym[pos]]
            state[alive] = s
            pos += 1
            go = (s != 0) & (pos < end[alive])
            alive, pos = alive[go], pos[go]
        return np.where(self.accepting[state], state, 0)


def word_spans(points: np.ndarray, bounds: np.ndarray):
    """White-space separated words, trimmed to their outer letters or digits:
    raw start and end, trimmed start and end, and each text's first word."""
    space = np.isin(points, (32, 9, 10, 11, 12, 13, 0xA0))
    inside = ~space
    prev = np.concatenate(([False], inside[:-1])) if len(points) else inside
    edges = bounds[(bounds > 0) & (bounds < len(points))]
    prev[edges] = False
    st = np.flatnonzero(inside & ~prev)
    nxt = np.concatenate((inside[1:], [False])) if len(points) else inside
    nxt[edges - 1] = False
    en = np.flatnonzero(inside & ~nxt) + 1
    good = np.flatnonzero((_letters()[points] != 0) | ((points >= 48) & (points < 58)))
    a, b = np.searchsorted(good, st), np.searchsorted(good, en)
    has = b > a
    ts, te = st.copy(), st.copy()
    if len(good):
        ts[has] = good[a[has]]
        te[has] = good[b[has] - 1] + 1
    return st, en, ts, te, np.searchsorted(st, bounds)


class Scorer:
    """Lexicon, automaton, ignored surfaces and weights."""

    def __init__(self, terms: list[tuple[str, bool]], innocent: frozenset = frozenset(), weights: np.ndarray = PRIOR):
        self.terms, self.innocent, self.weights = terms, innocent, weights
        self.parts = []
        for i in range(0, len(terms), PART_TERMS):
            a = Automaton(terms[i:i + PART_TERMS])
            accepts = np.full((len(a.table), 2), (-1, 99), np.int32)  # per state: (term, edits)
            for state, (term, e) in a.accepts.items():
                accepts[state] = (i + term, e)
            self.parts.append((a, a.symbols(), accepts))

    def matches(self, data: np.ndarray, off: np.ndarray):
        """Per text the list of (surface, term, edits, quoted, addressed, char start, char end)."""
        points, bounds = code_points(data, off)
        st, en, ts, te, first = word_spans(points, bounds)
        # least edits, then the first term, over all parts
        best = np.full((len(ts), 2), (-1, 99), np.int32)
        for automaton, sym, accepts in self.parts:
            got = accepts[automaton.run(sym[points], ts, te)]
            better = got[:, 1] < best[:, 1]
            best[better] = got[better]
        hits = np.flatnonzero(best[:, 0] >= 0)
        out: list[list] = [[] for _ in range(len(off) - 1)]
        owner = np.searchsorted(first, hits, "right") - 1
        text = lambda i, j: points[i:j].astype("<u4").tobytes().decode("utf-32-le")
        for h, d in zip(hits.tolist(), owner.tolist(), strict=True):
            term, e = best[h].tolist()
            surface = text(ts[h], te[h]).lower()
            if surface in self.innocent:
                continue
            lo, hi = max(first[d], h - WINDOW), min(first[d + 1], h + WINDOW + 1)
            left, right = text(st[lo], ts[h]), text(te[h], en[hi - 1])
            words = {w.strip(".,;:!?()[]*#&%$" + QUOTES) for w in (left + " " + right).lower().split()}
            quoted = (sum(left.count(q) for q in QUOTES) % 2 == 1 and any(q in right for q in QUOTES)) or bool(words & REPORT)
            base = int(bounds[d])
            out[d].append((surface, term, e, quoted, bool(words & ADDRESS), int(ts[h]) - base, int(te[h]) - base))
        return out

    @staticmethod
    def features(found: list) -> list[float]:
        n = np.zeros(6)
        for _, _, e, quoted, addressed, _, _ in found:
            n[(3 if e else 0) + (1 if quoted else 2 if addressed else 0)] += 1
        return np.log1p(n).tolist()

    def scores(self, found: list[list]) -> np.ndarray:
        x = np.array([[*self.features(f), 1.0] for f in found]).reshape(-1, 7)
        return 1.0 / (1.0 + np.exp(-x @ self.weights))


def fit_weights(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, strength: float = 1.0) -> np.ndarray:
    """Logistic weights with Gaussian priors, by Newton's method."""
    w = prior.copy()
    a = np.c_[x, np.ones(len(x))] if len(x) else np.zeros((0, len(prior)))
    for _ in range(60):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + strength * (w - prior)
        h = (a * (p * (1 - p))[:, None]).T @ a + strength * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


_WORDS = re.compile(r"[^\W\d_]{2,}")


#: Least hashes of a row; near copies share at least one of them.
SKETCH = 8


def witnesses(sample: DataFrame) -> DataFrame:
    """(text, toxic, witness): rows that are near copies of one another, directly
    or over others, have one witness.  Two rows are linked by an equal least hash
    of their five-word shingles under one of SKETCH orders.  The links are those
    of the bounded sample, so they may be joined on the driver."""
    orders = np.random.default_rng(11).integers(1, 2**63, SKETCH, dtype=np.uint64) | np.uint64(1)

    def sketch(batches):
        for b, data, off in text_chunks(batches):
            start, end, first = words(data, off)
            h, bounds = shingles(word_hashes(data, start, end), first)
            least = [[int(x) for x in mix(h[i:j, None] * orders).min(axis=0).view(np.int64)] if j > i else [] for i, j in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("row")), pa.array(least, pa.list_(pa.int64()))], ["row", "least"])

    row = F.xxhash64("text", "toxic")
    keyed = sample.select(row.alias("row"), "text")
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for r in keyed.mapInArrow(sketch, "row long, least array<long>").toLocalIterator():
        for i, k in enumerate(r["least"]):
            parent[find((i, k))] = find(r["row"])
    rows = [x for x in parent if not isinstance(x, tuple)]
    number: dict = {}
    table = [(x, number.setdefault(find(x), len(number))) for x in rows]
    same = sample.sparkSession.createDataFrame(table, "row long, witness long")
    # a text without words is no witness of a term
    return sample.select("text", "toxic", row.alias("row")).join(F.broadcast(same), "row").select("text", "toxic", "witness")


def learn_lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """Terms from rows (text, toxic).  Near copies are one witness, which counts
    every prefix of any of its texts once: no row is left out, and none makes
    the words of its family look like terms."""
    def prefixes(batches):
        for b in batches:
            counts: dict[str, list[int]] = {}
            for texts, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = {w for t in texts for w in _WORDS.findall((t or "").lower())}
                seen = {w[:n] for w in found for n in range(MIN_STEM, min(len(w), MAX_STEM) + 1)} | {w + "$" for w in found}
                for p in seen:
                    counts.setdefault(p, [0, 0])[int(toxic)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
                                              pa.array([c[0] for c in counts.values()], pa.int64())], ["p", "a", "b"])

    groups = witnesses(sample).groupBy("witness", "toxic").agg(F.collect_list("text").alias("texts"))
    total = groups.agg(F.sum(F.col("toxic")).alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    A, B = total["a"] or 0, total["b"] or 0
    if not A:
        return []
    df = (groups.select("texts", "toxic").mapInArrow(prefixes, "p string, a long, b long").groupBy("p").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
          .where((F.col("a") >= MIN_SUPPORT) & (F.col("a") * (B + 1) >= 25 * F.col("b") * A)))
    # bounded by the words of the sample's toxic rows
    rows = df.orderBy(F.desc("a"), "p").collect()
    support = {r["p"]: (r["a"], r["b"]) for r in rows}
    stems = {p: ab for p, ab in support.items() if not p.endswith("$")}
    letters: dict[str, set[str]] = {}
    for s in stems:
        for n in range(len(s)):
            letters.setdefault(s[:n], set()).add(s[n])
    longest_same: dict[str, str] = {}
    for p in sorted(stems, key=len, reverse=True):
        longer = [q for q in (p + c for c in letters.get(p, ())) if stems.get(q, (0,))[0] >= 0.9 * stems[p][0]]
        longest_same[p] = longest_same[longer[0]] if longer else p
    closed = sorted(set(longest_same.values()), key=lambda p: (-(stems[p][0] / A) / (stems[p][1] / max(B, 1) + 1.0 / (B + 1)), -stems[p][0], p))
    chosen: dict[str, None] = {}
    for p in sorted(closed, key=lambda p: (-stems[p][0], len(p), p)):
        if not any(p[:n] in chosen for n in range(1, len(p) + 1)):
            chosen[p] = None
    terms = []
    for p in chosen:
        whole = support.get(p + "$", (0, 0))[0]
        terms.append((p, whole < 0.9 * stems[p][0]))
    return terms


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer | None:
    """Scorer learnt from the labelled rows of ``docs``; None without toxic ones.

    Uses a hash sample of at most about MAX_TOXIC toxic and MAX_CLEAN other
    rows; rows with a null id or label are not used.  An id labelled more than
    once counts as toxic if any of its labels says so.
    """
    ship(docs)
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    n = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    coin = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.when(F.col("toxic") == 1, min(1.0, MAX_TOXIC / max(1, n.get(1, 0)))).otherwise(min(1.0, MAX_CLEAN / max(1, n.get(0, 0))))
    # bounded by the sample's bounds, so the broadcast is too
    sample = F.broadcast(marks.where(coin < share))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .join(sample, "doc_id").select("doc_id", "text", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0).alias("half")))
    # true copies would count as independent evidence: of texts equal but for case and white space one stays
    norm = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+", " ")
    rows = (rows.groupBy(F.sha2(F.trim(norm), 256).alias("key"), "toxic").agg(F.min(F.struct("doc_id", "text", "half")).alias("r"))
            .select("r.doc_id", "r.text", "toxic", "r.half"))
    rows = keep_written(rows, "toxicity-sample")
    terms = learn_lexicon(rows)
    if not terms:
        return None
    scorer = Scorer(terms)
    bc = docs.sparkSession.sparkContext.broadcast((scorer.terms,))

    def surfaces(batches):
        s = Scorer(*bc.value)
        for b, data, off in text_chunks(batches):
            out = [(w, int(t)) for found, t in zip(s.matches(data, off), b.column(2).to_pylist(), strict=True)
                   for w in {f[0] for f in found if f[2] or f[0] != s.terms[f[1]][0]}]
            c = Counter(out)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.int64()),
                                              pa.array(list(c.values()), pa.int64())], ["surface", "toxic", "n"])

    clean = F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0))
    toxic = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0))

    def innocent(frame: DataFrame) -> frozenset:
        # bounded by the words of the sample
        found = (frame.select("doc_id", "text", "toxic").mapInArrow(surfaces, "surface string, toxic long, n long").groupBy("surface")
                 .agg(clean.alias("c"), toxic.alias("t")).where("c > 0 and c >= t"))
        return frozenset(r["surface"] for r in found.select("surface").collect())

    # surfaces learnt on one half, weights on the other, so unseen surfaces weigh what they should
    bc2 = docs.sparkSession.sparkContext.broadcast((scorer.terms, innocent(rows.where("half"))))

    def vectors(batches):
        s = Scorer(*bc2.value)
        for b, data, off in text_chunks(batches):
            x = [s.features(f) for f in s.matches(data, off)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(2).cast(pa.int64())], ["x", "y"])

    got = rows.where("not half").select("doc_id", "text", "toxic").mapInArrow(vectors, "x array<double>, y long").groupBy("x", "y").count().collect()
    x = np.repeat(np.array([r["x"] for r in got]).reshape(-1, 6), [r["count"] for r in got], axis=0)
    y = np.repeat(np.array([r["y"] for r in got], float), [r["count"] for r in got])
    return Scorer(scorer.terms, innocent(rows), fit_weights(x, y))


def score(docs: DataFrame, scorer: Scorer | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and matches (term, surface, edits, quoted, start,
    end in characters) for every row, without a shuffle.

    A null or empty text has no match and the score of the bias, as has every
    row when nothing could be learnt.  Repeated rows repeat; other columns are
    not read; an empty table gives an empty result.
    """
    ship(docs)
    bc = docs.sparkSession.sparkContext.broadcast((scorer.terms, scorer.innocent, scorer.weights) if scorer else ([], frozenset(), PRIOR))

    def scan(batches):
        s = Scorer(*bc.value)
        kind = pa.list_(pa.struct([("term", pa.string()), ("surface", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()),
                                   ("start", pa.int64()), ("end", pa.int64())]))
        for b, data, off in text_chunks(batches):
            found = s.matches(data, off)
            rows = [[{"term": s.terms[t][0], "surface": w, "edits": e, "quoted": q, "start": i, "end": j} for w, t, e, q, _, i, j in f] for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s.scores(found), pa.float64()), pa.array(rows, kind)],
                                             ["doc_id", "score", "matches"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(scan, "doc_id long, score double, matches array<struct<term:string,surface:string,edits:int,quoted:boolean,start:long,end:long>>")

