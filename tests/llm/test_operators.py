"""Operators against brute force, and their defined results on odd tables:
nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge.llm import decontamination, exact_dedup, language_id, language_model, ngram_join, packing, pseudonyms, token_counts, toxicity, warc
from clickforge.llm.queries import TOKENIZERS

VOCAB = f"{TOKENIZERS}/byte_bpe_50k.json"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     *[T.StructField(c, T.StringType()) for c in ("fp", "cls", "label", "score", "tile", "words", "tokens", "shard", "norm")]])
LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (6, LONG), (7, LONG + " tail"), (8, "One  two\tthree"), (8, "One  two\tthree"),
       (None, "a null id with some words in it"), (9, "a null id with some words in it"), (10, "ünïcødé 你好 🙂 words here"), (11, "12345 678")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", *["x"] * 9) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).cache()


def variants(seed=1, families=6, size=7):
    rnd, rows = random.Random(seed), []
    common = [f"c{i}" for i in range(30)]
    for f in range(families):
        base = [f"f{f}w{rnd.randrange(60)}" for _ in range(rnd.randrange(20, 90))]
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.randrange(0, 5)):
                at = rnd.randrange(len(w))
                w[at:at + rnd.randrange(0, 2)] = [f"r{rnd.randrange(10**6)}"]
            rows.append(w if rnd.random() < .7 else w + common)
    rnd.shuffle(rows)
    return [(100 + i, " ".join(w)) for i, w in enumerate(rows)]


def shingled(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return sets


def brute_links(rows):
    sets, n = shingled(rows), [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            n[a] += 1
            n[b] += 1
    return collections.Counter((i, k) for (i, _), k in zip(rows, n, strict=True))


def brute_components(rows):
    sets = shingled(rows)
    low = [i for i, _ in rows]
    while True:
        old = list(low)
        for a, b in itertools.combinations(range(len(rows)), 2):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                known = [x for x in (low[a], low[b]) if x is not None]
                low[a] = low[b] = min(known) if known else None
        if low == old:
            return collections.Counter((i, len(s), c) for (i, _), s, c in zip(rows, sets, low, strict=True))


def rows_of(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("large", [ngram_join.LARGE_TILE, 0])
def test_ngram_join_equals_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(ngram_join, "LARGE_TILE", large)
    monkeypatch.setattr(ngram_join, "BLOCK", 4 if large == 0 else 1024)
    rows = variants()
    got = rows_of(ngram_join.ngram_jaccard_join(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(rows)


def test_ngram_join_deals_ranges_in_rounds(spark, monkeypatch):
    assert ngram_join.dealing(16) == (16, 1) and ngram_join.dealing(512) == (512, 1) and ngram_join.dealing(513) == (23, 2)
    monkeypatch.setattr(ngram_join, "FAN", 3)  # 16 ranges take three rounds
    monkeypatch.setattr(ngram_join, "LOCAL_HEAVY", 3)  # so that marks are dealt too
    assert ngram_join.dealing(16) == (3, 3)
    rows = variants()
    got = rows_of(ngram_join.ngram_jaccard_join(frame(spark, rows).repartition(5), count_links=True), "doc_id", "n_shingles", "component_id", "n_links")
    links = dict(brute_links(rows).keys())
    assert got == collections.Counter((i, n, c, links[i]) for i, n, c in brute_components(rows))


def test_ngram_join_sends_no_row_per_range():
    part = np.random.default_rng(1).integers(0, 1 << 40, 1000)
    cuts = ngram_join._cuts(part)
    assert len(cuts) == 1000 and all((part[o] == p).all() for p, o in cuts) and ngram_join._cuts(part[:0]) == []


@pytest.mark.parametrize("block", [1024, 3])
def test_ngram_join_counts_all_links(spark, odd, empty, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # with blocks of 3, components go over several blocks and bands
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    # one group whose sizes go over several bands, so many of its members link with some others only
    chain = [(1000 + k, " ".join(base[rnd.randrange(0, 12):60 + 5 * (k % 12)])) for k in range(40)]
    rows = variants() + chain + [(2000, chain[3][1]), (2001, chain[3][1])]
    result = ngram_join.ngram_jaccard_join(frame(spark, rows), count_links=True)
    got, want = rows_of(result, "doc_id", "n_links"), brute_links(rows)
    assert got == want and len({k for _, k in want}) > 8
    assert rows_of(result, "doc_id", "n_shingles", "component_id") == brute_components(rows)
    assert rows_of(ngram_join.ngram_jaccard_join(odd, count_links=True), "doc_id", "n_links") == brute_links(ODD)
    assert ngram_join.ngram_jaccard_join(empty, count_links=True).count() == 0


def test_ngram_join_odd_tables(odd, empty):
    got = rows_of(ngram_join.ngram_jaccard_join(odd), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(ODD)
    assert ngram_join.ngram_jaccard_join(empty).count() == 0


def test_bitmaps_bound_the_overlap():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        pool = rnd.integers(0, 2**48, 400, dtype=np.uint64)
        a, b = (np.unique(rnd.choice(pool, rnd.integers(1, 300))) for _ in range(2))
        bound = ngram_join.overlap_bound(ngram_join.signature(a, len(a)), ngram_join.signature(b, len(b)), len(a), len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_exact_dedup(odd, empty, spark):
    rows = ODD + [(20, "A B"), (21, "AB"), (22, "A  B"), (23, "A  B"), (19, "ab")]
    norm = lambda t: (t or "").encode().translate(None, b" \t\n\x0b\x0c\r")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((i, t or ""))
    want = collections.Counter()
    for n, g in groups.items():
        keep = min(g, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        left = 1
        for i, t in g:
            kept = (i, t) == keep and left > 0
            left -= kept
            want[i, keep[0], len(g), kept, hashlib.sha256(n).hexdigest()] += 1
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows_of(exact_dedup.exact_dedup(frame(spark, rows)), *cols) == want
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_quotient_filters_merge_losslessly():
    rnd = np.random.default_rng(1)
    fps = rnd.integers(-2**63, 2**63 - 1, 300)
    near = 7 << 60 | rnd.integers(0, 50, 300)  # one quotient's long run, shifting those behind it
    top = 2**64 - 1 - rnd.integers(0, 9, 700).astype(np.uint64)  # runs past the last slot, counts beyond a byte
    parts = [*(rnd.choice(fps, 400).view(np.uint64) for _ in range(4)), near.astype(np.uint64), np.repeat(top, 6), np.zeros(0, np.uint64)]
    whole = []
    merged = collections.Counter()
    for p in parts:
        values, counts = np.unique(p, return_counts=True)
        f = exact_dedup.QuotientFilter.build(values, counts, 64)
        assert f.values()[0].tolist() == values.tolist() and f.values()[1].tolist() == counts.tolist()
        whole.append(f)
        for block, f in exact_dedup.filters_by_block(values, counts, 64, 3):
            merged.update({int(v) | block << 61: int(c) for v, c in zip(*f.values(), strict=True)})
    want = collections.Counter(int(x) for p in parts for x in p)
    assert merged == want
    assert dict(zip(*(x.tolist() for x in exact_dedup.merge_filters(whole)), strict=True)) == want


def test_fingerprints_are_dealt_in_rounds(spark, monkeypatch):
    assert exact_dedup.block_levels(10, 10) == [5]
    assert exact_dedup.block_levels(200_000 << 19, 200_000) == [9, 10]  # a task sends 512 filters, not one per block
    rnd = random.Random(4)
    fps = [(rnd.randrange(-2**63, 2**63),) for _ in range(900)]
    fps += [rnd.choice(fps) for _ in range(500)] + [fps[0]] * 700
    want = {f: n for (f,), n in collections.Counter(fps).items() if n > 1}
    df = spark.createDataFrame(fps, "fp long").repartition(7)
    for bits in (2, 3, 10):
        monkeypatch.setattr(exact_dedup, "LEVEL_BITS", bits)
        got = exact_dedup.repeated_fingerprints(df, len(fps), 30)
        assert {r["fp"]: r["copies"] for r in got.collect()} == want


def test_groups_larger_than_a_salt(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_SALT", 7)
    rows = [(i, "same  text" if i % 3 else "same text") for i in range(100)] + [(None, "other")] * 30 + [(5, "x")]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert len(got) == 131 and sum(r["kept"] for r in got) == 3
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got if r["kept"]} == {(1, 1, 100), (None, None, 30), (5, 5, 1)}


def test_token_counts_equal_the_library(odd, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(VOCAB)
    n = lambda s: len(lib.encode(s, add_special_tokens=False).ids)
    c = token_counts.PrefixCounter(VOCAB)
    rnd = random.Random(5)
    texts = ["", "  a  b", "I'll we're 've", "x<|endoftext|>y <|endo", "''| '' ", "a  b\x1c c\x85", "你好 🙂👍🏽 x"]
    texts += ["".join(rnd.choice("ab  \n\t'srelvtdm19!é你 <|endoftext|>") for _ in range(rnd.randint(1, 25))) for _ in range(150)]
    for s in texts:
        want = [n(s[:i]) for i in range(len(s) + 1)]
        assert c.prefix_counts(s).tolist() == want and c.count(s) == want[-1]
        for budget in (0, 1, 3):
            assert c.fit(s, budget) == max(i for i, w in enumerate(want) if w <= budget)
    got = rows_of(token_counts.token_counts(odd, VOCAB, 512), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == collections.Counter((i, len((t or "").encode()), n(t or ""), n(t or "") > 512) for i, t in ODD)
    assert token_counts.token_counts(empty, VOCAB).count() == 0


def test_whole_text_counts_equal_the_library(monkeypatch):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(VOCAB)
    rnd = random.Random(8)
    texts = ["", "'s't", "x'll", "'", "a'", " 's", "\n're x'rex ''d 'l", "a\u3000b \u00a0c", "  ", "a \n b", "'ve'", "I'M y'all'd", "<|endoftext|> a", "", "\u00b2x'sé"]
    texts += ["".join(rnd.choice("ab  \n\t''srelvtdm19!é你\u00a0\u3000A") for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    texts += ["<|endoftext|>".join(texts[-2:]), "word " * 5000, "", ""]
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    for slots in (1 << 20, 2):  # with two places nearly everything is overwritten
        monkeypatch.setattr(token_counts.TotalCounter, "SLOTS", slots)
        c = token_counts.TotalCounter(token_counts.counter(VOCAB))
        for part in (texts, [t for t in texts if t.isascii()], ["", ""]):
            raw = [t.encode() for t in part]
            off = np.cumsum([0, *map(len, raw)])
            for _ in range(2):
                got = c.counts(np.frombuffer(b"".join(raw), np.uint8), off).tolist()
                assert got == [w for t, w in zip(texts, want, strict=True) if t in part][:len(part)] if part != ["", ""] else got == [0, 0]


def test_packing_keeps_everything(odd, empty):
    got = packing.best_fit_packing(odd, F.octet_length(F.coalesce("text", F.lit(""))), (64, 256, 1024), shard=40).collect()
    size = collections.defaultdict(int)
    for r in got:
        size[r["bin_id"]] += r["length"]
    for r in got:
        assert size[r["bin_id"]] == r["bin_fill"] <= r["capacity"] == min(c for c in (64, 256, 1024) if c >= r["bin_fill"])
    pieces = collections.Counter((r["doc_id"], r["start"], r["length"]) for r in got)
    want = collections.Counter((i, s, min(1024, len((t or "").encode()) - s)) for i, t in ODD for s in range(0, max(1, len((t or "").encode())), 1024))
    assert pieces == want
    assert packing.best_fit_packing(empty, F.octet_length("text")).count() == 0


def test_packing_is_near_the_optimum():
    def optimum(items, caps):
        best = [float("inf")]

        def place(i, bins):
            if i == len(items):
                best[0] = min(best[0], sum(packing.cost(min(c for c in caps if c >= b)) for b in bins))
                return
            for b in range(len(bins) + 1):
                new = [*bins, 0] if b == len(bins) else list(bins)
                new[b] += items[i]
                if new[b] <= caps[-1]:
                    place(i + 1, new)
        place(0, [])
        return best[0]

    rnd = random.Random(2)
    for _ in range(12):
        items = [rnd.randrange(1, 100) for _ in range(6)]
        of, sized, fill = packing.pack(items, (40, 70, 100))
        assert all(sum(n for n, b in zip(items, of, strict=True) if b == k) == f <= s for k, (s, f) in enumerate(zip(sized, fill, strict=True)))
        assert sum(map(packing.cost, sized)) <= 1.5 * optimum(items, (40, 70, 100))


def test_packing_plan_beats_every_opening_size():
    caps = (2048, 4096, 8192, 16384)
    total = lambda p: sum(map(packing.cost, p[1]))
    rnd = random.Random(9)
    wins = 0
    for _ in range(20):
        # lengths of which several fill one size well and few fill all
        items = [rnd.choice((1100, 1500, 2700, 3900, 6000, 900)) + rnd.randrange(60) for _ in range(300)]
        fixed = min(total(packing.pack(items, caps, (c,))) for c in caps)
        planned = total(packing.pack(items, caps, (None,)))
        wins += planned < fixed
        assert total(packing.pack(items, caps)) == min(fixed, planned)
    assert wins == 20
    # what a bin would hold: 100 + 60 + 30 + 5 of 195, not the second 60
    assert packing._filling(100, [-120, -60, -60, -30, -5, 0], 195) == (195, [1, 3, 4, 5])
    assert packing._filling(100, [-120, -60, -60, -30], 200) == (190, [1, 3])
    assert packing._filling(100, [], 200) == (100, [])


def test_packing_counts_tokens(odd, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(VOCAB)
    got = packing.pack_tokens(odd, VOCAB, (64, 256, 1024)).collect()
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["bin_id"]].append(r)
    for rows in bins.values():
        end = 0
        for place, r in enumerate(sorted(rows, key=lambda r: r["position"])):
            assert (r["position"], r["offset"]) == (place, end)
            end += r["length"]
        assert end == r["bin_fill"] <= r["capacity"]
    n = lambda t: len(lib.encode(t or "", add_special_tokens=False).ids)
    want = collections.Counter((i, s, min(1024, k - s)) for i, t in ODD for k in [n(t)] for s in range(0, max(1, k), 1024))
    assert collections.Counter((r["doc_id"], r["start"], r["length"]) for r in got) == want
    assert packing.pack_tokens(empty, VOCAB).count() == 0


def test_feistel_permutes():
    for size in (1, 2, 7, 100, 1000):
        net = pseudonyms.Feistel(b"k", "t", size)
        image = [net.permute(x) for x in range(size)]
        assert sorted(image) == list(range(size)) and [net.permute(y, back=True) for y in image] == list(range(size))


def test_pseudonyms(odd, empty):
    p = pseudonyms.Pseudonyms(b"key")
    text = ("card 4111 1111 1111 1111, bad 4111111111111112, mail jo.doe+x@mail.example.com ip 10.0.200.7 not 999.1.1.1 ssn 123-45-6789 "
            "on 2024-02-29 and 31/12/1999 or 13.40.2020 iban DE89 3704 0044 0532 0130 00 call +1 (555) 123-4567 token = \"0123456789abcdef0123\" v1.2.3")
    out, spans = p.replace(text)
    assert collections.Counter(k for k, _, _ in spans) == {"card": 1, "email": 1, "ip": 1, "ssn": 1, "date": 2, "iban": 1, "phone": 1, "secret": 1}
    for secret in ("4111 1111 1111 1111", "jo.doe", "10.0.200.7", "123-45-6789", "2024-02-29", "31/12/1999", "0130 00", "123-4567", "89abcdef"):
        assert secret not in out
    assert "4111111111111112" in out and "999.1.1.1" in out and "13.40.2020" in out and len(out) - len(text) in range(-6, 7)
    card = next(out[a:b] for k, a, b in spans if k == "card").replace(" ", "")
    assert pseudonyms.luhn_digit(card[:-1]) == card[-1]
    assert p.replace(out, back=True)[0] == text
    assert p.replace("again 4111111111111111 x")[0][6:22].replace(" ", "") == card
    df = pseudonyms.pseudonymise(odd, "key")
    assert rows_of(df, "doc_id", "text", "pii_count") == collections.Counter((i, t, 0) for i, t in ODD)
    assert pseudonyms.pseudonymise(empty, "key").count() == 0


def test_automaton_equals_edit_distance():
    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (x != y))
        return d[-1]

    terms = [("idiot", False), ("disgusting", False), ("lowei", True), ("worthless", False), ("chllaxaz", True)]
    auto, rnd = toxicity.Automaton(terms), random.Random(4)
    sym = auto.symbols()
    words = {"".join(rnd.choice("idotswrhle") for _ in range(rnd.randint(1, 9))) for _ in range(400)}
    for t, _ in terms:
        for _ in range(150):
            w = list(t + rnd.choice(["", "ab"]))
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(w))
                w[at:at + rnd.randint(0, 1)] = rnd.choice(["", "q", "e"])
                w = w or ["x"]
            words.add("".join(w))
    for w in words:
        points = np.array([ord(c) for c in w], np.uint32)
        state = int(auto.run(sym[points], np.array([0]), np.array([len(w)]))[0])
        best = min((min(distance(t, w[:i]) for i in range(len(w) + 1)) if stem else distance(t, w)) - 100 * 0 for t, stem in terms
                   if (min(distance(t, w[:i]) for i in range(len(w) + 1)) if stem else distance(t, w)) <= toxicity.edits_allowed(t, stem)) if any(
            (min(distance(t, w[:i]) for i in range(len(w) + 1)) if stem else distance(t, w)) <= toxicity.edits_allowed(t, stem) for t, stem in terms) else None
        assert (auto.accepts[state][1] if state else None) == best, w


def test_toxicity_learns_terms(spark, odd, empty):
    rnd = random.Random(7)
    filler = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(150)]
    rows, labels = [], []
    for i in range(400):
        w = [rnd.choice(filler) for _ in range(25)]
        if i % 4 == 0:
            w[rnd.randrange(25)] = rnd.choice(["worthless", "pathetic", "moronic"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    scorer = toxicity.learn(frame(spark, rows), marks)
    assert {t for t, _ in scorer.terms} >= {"worthless", "pathetic", "moronic"}
    more = [(1000, "you are wortless"), (1001, "so pathetic."), (1002, "plain words here"), (1003, None), (1004, "PATHETIC!!"), (1005, "path ethical")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, more), scorer).collect()}
    assert all(got[i] >= .5 for i in (1000, 1001, 1004)) and all(got[i] < .5 for i in (1002, 1003, 1005))
    assert toxicity.score(odd, scorer).count() == len(ODD) and toxicity.score(empty, None).count() == 0
    assert toxicity.learn(empty, marks) is None


def test_language_id(spark, odd, empty):
    words = {"en": "the of and that with tion ing".split(), "de": "der die und ung keit sch über".split(), "es": "el ción que ñan los mente".split()}
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice(words[lang]) + rnd.choice(words[lang]) for _ in range(30)), lang) for i in range(300) for lang in (list(words)[i % 3],)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df.where("doc_id % 5 <> 0"))
    got = language_id.with_language(df.where("doc_id % 5 = 0"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= .95 * len(got) and all(0 <= r["score"] <= 1 for r in got)
    out = {(r["doc_id"], r["text"]): r for r in language_id.with_language(odd, model).collect()}
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")) for (_, t), r in out.items())
    assert language_id.fit(empty) is None and language_id.with_language(empty, None).count() == 0
    assert {r["lang_pred"] for r in language_id.with_language(odd, None).collect()} == {"und"}


def test_ngrams_do_not_cross_texts():
    import pyarrow as pa

    from clickforge.llm.common import string_parts

    texts = ["ab, cd", "", "é", "12", "xyz"]
    together, bounds = language_id.ngrams(*string_parts(pa.array(texts)))
    for i, t in enumerate(texts):
        alone, _ = language_id.ngrams(*string_parts(pa.array([t])))
        assert together[bounds[i]:bounds[i + 1]].tolist() == alone.tolist()


def test_gram_blocks_give_the_same_as_whole_texts():
    import pyarrow as pa
    from clickforge.llm.common import string_parts

    texts = ["", "abc déf 12 ghi" * 9, "  ", "a", "längerer Text, mit Zeichen!" * 5, "x y"]
    parts = string_parts(pa.array(texts))
    whole, bounds = language_id.ngrams(*parts)
    for block in (1, 2, 7, 50, 10_000):
        got = [[] for _ in texts]
        for first, grams, b in language_id.gram_blocks(*parts, block):
            for t in range(len(b) - 1):
                got[first + t] += grams[b[t]:b[t + 1]].tolist()
        assert got == [whole[i:j].tolist() for i, j in zip(bounds[:-1], bounds[1:])]


def test_language_model(odd, empty, spark):
    got = {(r["doc_id"], r["n_tokens"]): r for r in language_model.language_model_scores(odd).collect()}
    assert got[1, 0]["sum_logprob"] == 0 and got[1, 0]["mean_logprob"] is None and got[6, 20_000]["sum_logprob"] < 0
    assert language_model.language_model_scores(empty).count() == 0
    rnd = random.Random(3)
    rows = [(i, " ".join(f"{a} b{a}" for a in (rnd.choice("xyz") for _ in range(60)))) for i in range(200)]
    shuffled = [(1000 + i, " ".join(sorted(t.split(), key=lambda _: rnd.random()))) for i, t in rows[:50]]
    scores = {r["doc_id"]: r["mean_logprob"] for r in language_model.language_model_scores(frame(spark, rows + shuffled)).collect()}
    assert np.mean([scores[i] for i in range(50)]) > np.mean([scores[1000 + i] for i in range(50)])


def lm_vocabulary(n=1500, known=1000):
    """(vocabulary of the ``known`` commonest of n words, all words' counts and shapes)."""
    rnd = np.random.default_rng(1)
    counts = np.sort(rnd.integers(1, 90, n))[::-1].astype(float)
    shape = rnd.integers(0, language_model.SHAPES, n)
    total = np.bincount(shape, counts, language_model.SHAPES)
    distinct = np.bincount(shape, minlength=language_model.SHAPES)
    h = rnd.permutation(n).astype(np.uint64)
    return language_model.listed(h[:known], counts[:known], shape[:known], total, distinct), counts, shape


def test_conditional_probabilities_sum_to_one():
    vocab, counts, shape = lm_vocabulary()
    net = language_model.Network.start(vocab)
    net.cls[:] = np.random.default_rng(1).normal(0, 1, net.cls.shape)
    targets = np.arange(language_model.SYMBOLS, dtype=np.int32)
    ctx = np.tile(np.array([[3, 9, 990, vocab.pad]]), (len(targets), 1))
    logp = net.logprob(ctx, targets)
    assert abs(np.exp(logp).sum() - 1) < 1e-4
    # every counted word has a probability, with an embedding or without; those of shapes without words are nobody's
    token = np.where(np.arange(len(counts)) < vocab.n_words, np.arange(len(counts)), vocab.n_words + shape)
    nobody = np.setdiff1d(np.arange(language_model.HEAD, language_model.SYMBOLS), vocab.symbol[token])
    assert abs(np.exp(logp[vocab.symbol[token]] + vocab.within[token]).sum() + np.exp(logp[nobody]).sum() - 1) < 1e-4


def test_scores_are_sums_of_conditional_log_probabilities(spark):
    rnd = random.Random(12)
    word = [f"w{i}{'abcdefgh'[i % 8] * (i % 5)}" for i in range(2500)]
    rows = [(i, " ".join(word[int(2500 * rnd.random() ** 3)] for _ in range(rnd.randrange(1, 60)))) for i in range(300)]
    src = frame(spark, rows).select("doc_id", "text")
    vocab = language_model.vocabulary(src)
    n = collections.Counter(w for _, t in rows for w in t.split())
    size = language_model.HEAD + 2 * math.ceil(math.sqrt(n.total()))
    whole = [k for k in n.values() if sum(m >= k for m in n.values()) <= size]  # all words of a count, or none
    assert 0 < vocab.n_words == len(whole) <= size < len(n)
    encoded = language_model.encode(src, vocab)
    params = language_model.train(encoded, vocab)
    net = language_model.Network(params)
    got = {r["doc_id"]: r for r in language_model.score(encoded, vocab, params).collect()}
    p = {name: np.asarray(getattr(net, name), np.float64) for name in ("emb", "pos", "layer", "bias", "cls", "cls_b", "word", "word_b")}
    for r in encoded.limit(20).collect():  # plain loops over positions and their windows
        tokens = np.frombuffer(bytes(r["tokens"]), "<u4").astype(int)
        want = 0.0
        for i, t in enumerate(tokens):
            x = np.zeros(language_model.DIM)
            for s, d in enumerate((-2, -1, 1, 2)):
                x += p["emb"][tokens[i + d] if 0 <= i + d < len(tokens) else vocab.pad] * p["pos"][s] / 4
            h = np.tanh(x @ p["layer"] + p["bias"])
            c, m = divmod(int(vocab.symbol[t]), language_model.CLASSES)
            a, b = h @ p["cls"] + p["cls_b"], h @ p["word"][c] + p["word_b"][c]
            want += a[c] - np.log(np.exp(a).sum()) + b[m] - np.log(np.exp(b).sum()) + vocab.within[t]
        assert got[r["doc_id"]]["n_tokens"] == len(tokens) and abs(got[r["doc_id"]]["sum_logprob"] - want) < 1e-3 * max(1, len(tokens))


def test_rare_words_of_one_shape_score_apart(spark):
    rnd = random.Random(13)
    common = [f"c{i}" for i in range(800)]
    rows = [(i, " ".join(rnd.choice(common) for _ in range(40))) for i in range(900)]
    # both words are rarer than the softmax's and end alike
    rows += [(1000 + i, "c1 c2 zebra c3") for i in range(9)] + [(2000, "c1 c2 umbra c3")]
    got = {r["doc_id"]: r["sum_logprob"] for r in language_model.language_model_scores(frame(spark, rows)).collect()}
    assert got[1000] - got[2000] > 1


def test_warc_roundtrip(spark, tmp_path):
    big = "<p>" + "ä\r\n\r\nWARC/1.1\r\n" * 30
    rows = [(3, "http://a.b/c?d#e", big), (1, "http://a.b/x", big), (2, None, "small"), (4, "http://q/", "small"), (5, "u\r\nx", None), (6, "http://z", ""),
            (None, "http://n", big), (7, "http://r", "r" * 200), (7, "http://r", "r" * 200)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_id string")
    got = warc.roundtrip(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next(h or "" for i, _, h in rows if i == r["page_id"]).encode()
        assert r["response"]["payload_digest"] == hashlib.sha256(html).hexdigest() and r["response"]["payload_bytes"] == len(html)
        assert bytes(r["response"]["payload"]) == html and r["request"]["line"].startswith("GET /") and r["metadata"]["page_id"] == r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("revisit", 1) if r["page_id"] in (3, None) else ("response", None))
    assert warc.roundtrip(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort"))


def test_decontamination(spark, odd, empty):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    items = [(i, [word() for _ in range(rnd.choice((3, 8, 20, 40)))]) for i in range(8)]
    docs, want = [], set()
    for i in range(40):
        w = [word() for _ in range(60)]
        if i % 2:
            item, text = items[i % 8]
            text = list(text)
            if i % 3 == 0 and len(text) == 40:
                text[0] = "edited"
            if i % 5 == 0 and len(text) > 8:
                text = text[:len(text) // 3]
            at = rnd.choice((0, 30, 60))
            w[at:at] = text
        docs.append((i, w))
    for d, w in docs:
        for item, t in items:
            k = min(5, len(t))
            grams = lambda x: collections.Counter(tuple(x[j:j + k]) for j in range(len(x) - k + 1))  # noqa: E731, B023
            a = grams(t)
            for s in range(max(1, len(w) - len(t) + 1)):
                b = grams(w[s:s + len(t)])
                common = sum((a & b).values())
                if common >= .75 * (sum(a.values()) + sum(b.values()) - common):
                    want.add((d, item))
    bench = spark.createDataFrame([*((i, " ".join(t).upper() + "!", "x") for i, t in items), (98, None, "x"), (99, "", "x"), (None, "null item has words of its own here", "x")],
                                  "item_id long, text string, doc_id string")
    got = decontamination.contaminated(frame(spark, [(i, ", ".join(w)) for i, w in docs]), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) > 8
    assert decontamination.contaminated(odd, bench).count() == 0
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.contaminated(odd, bench.limit(0)).count() == 0
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()


def test_decontamination_of_texts_shorter_than_the_item(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate((6, 10, 25, 50, 90))]
    docs, want = [], set()
    for _, t in items:
        for cut in (.6, .7, .75, .78, .8, .82, .84, .86, .9, 1):
            n = round(cut * len(t))
            docs += [(len(docs), t[:n]), (len(docs) + 1, t[len(t) - n:]), (len(docs) + 2, [word(), *t[:n]])]
    for d, w in docs:
        for item, t in items:
            grams = lambda x: collections.Counter(tuple(x[j:j + 5]) for j in range(len(x) - 4))
            a = grams(t)
            for s in range(max(1, len(w) - len(t) + 1)):
                b = grams(w[s:s + len(t)])
                common = sum((a & b).values())
                if common >= .75 * (sum(a.values()) + sum(b.values()) - common):
                    want.add((d, item))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    # a longer text under the same id does not raise the bound
    repeated = (0, [word() for _ in range(200)])
    got = decontamination.contaminated(frame(spark, [(i, " ".join(w)) for i, w in [*docs, repeated]]), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    # the case of 42 words of 50: 38 of 46 shingles
    one = frame(spark, [(1, " ".join(items[3][1][:42]))])
    assert [round(r["similarity"], 6) for r in decontamination.contaminated(one, bench).collect()] == [round(38 / 46, 6)]


def test_pseudonyms_inside_longer_matches(spark):
    tool = pseudonyms.Pseudonyms(b"k")
    card, iban = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"
    cases = [(f"pay {iban} EUR 500", "iban", iban), (f"{iban} PAID NOW", "iban", iban), ("AT61 1904 3002 3457 3201 100 is it", "iban", "AT61 1904 3002 3457 3201"),
             ("to BE68 5390 0754 7034 EUR", "iban", "BE68 5390 0754 7034"), (f"AB12 {iban}", "iban", iban), (f"invoice 12 {card}", "card", card), (f"{card} 123", "card", card),
             (f"1234 {card} 12/27", "card", card), (f"7 7 7 {card} 9", "card", card), ("on 1999 3782 822463 10005", "card", "3782 822463 10005"),
             ("password=correcthorsebatterystaple", "secret", "correcthorsebatterystaple"), ("API-KEY: abcdefghijklmnopqrst", "secret", "abcdefghijklmnopqrst")]
    alone = {v: tool.replace(v)[0] for _, k, v in cases if k != "secret"}
    for text, kind, value in cases:
        assert tool.MAYBE.search(text), text
        new, found = tool.replace(text)
        assert [k for k, _, _ in found] == [kind], (text, new)
        at = text.index(value)
        assert found[0][1:] == (at, at + len(value)) and new[:at] + value + new[at + len(value):] == text and new != text, (text, new)
        assert kind == "secret" or new[at:at + len(value)] == alone[value]  # as the value alone
        assert tool.replace(new, back=True)[0] == text
    # numbers that are no values stay, also in a long run
    for text in ("100 200 300 400 500 600 700 800 900", "ES91 2100 0418 4502 0005 1333 EUR 500", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", "999.1.1.1 and 31/31/2020"):
        assert tool.replace(text) == (text, []), text
    rows = pseudonyms.pseudonymise(frame(spark, [(i, t) for i, (t, _, _) in enumerate(cases)]), "k").select("pii_count").collect()
    assert [r[0] for r in rows] == [1] * len(cases)


def test_toxicity_keeps_all_terms(spark):
    rnd = random.Random(11)
    word = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    terms, filler = [word("klmnopqrstuv", 7) for _ in range(200)], [word("abcdefgh", rnd.randint(2, 6)) for _ in range(150)]
    rows = [(i, [rnd.choice(filler) for _ in range(25)]) for i in range(3600)]
    for i, w in rows[:1600]:
        w[rnd.randrange(25)] = terms[i % 200]  # each in one of 200 toxic rows
    scorer = toxicity.learn(frame(spark, [(i, " ".join(w)) for i, w in rows]), spark.createDataFrame([(i, int(i < 1600)) for i in range(3600)], "doc_id long, toxic int"))
    assert all(any(t.startswith(p) for p, _ in scorer.terms) for t in terms)
    got = toxicity.score(frame(spark, [(i, f"so {t} here") for i, t in enumerate(terms)]), scorer).collect()
    assert all(r["score"] >= .5 for r in got)


def test_parts_of_a_lexicon_match_like_one_automaton(monkeypatch):
    rnd = random.Random(12)
    terms = list({"".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 10))): None for _ in range(30)})
    terms = [(t, i % 3 == 0) for i, t in enumerate(terms)]
    text = " ".join("".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 11))) for _ in range(3000)).encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    one = toxicity.Scorer(terms).matches(data, off)
    monkeypatch.setattr(toxicity, "PART_TERMS", 4)
    assert toxicity.Scorer(terms).matches(data, off) == one and len(one[0]) > 20
    assert toxicity.Scorer([]).matches(data, off) == [[]]


def brute_windows(w, t):
    """Greatest similarity of an item's windows, all of them, and the first start that has it."""
    k = min(5, len(t))
    grams = lambda x: collections.Counter(tuple(x[j:j + k]) for j in range(len(x) - k + 1))
    a, best = grams(t), (0, 0)
    for s in range(max(1, len(w) - len(t) + 1)):
        b = grams(w[s:s + len(t)])
        common = sum((a & b).values())
        best = max(best, (common / max(1, sum(a.values()) + sum(b.values()) - common), -s))
    return best


def test_decontamination_of_windows_without_a_common_alignment(spark):
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    many = lambda n: [word() for _ in range(n)]
    a, b, c = many(20), many(20), many(40)
    items = [(0, a + b), (1, many(30)), (2, ["again"] * 12), (3, a + c), (4, many(15) + ["again"] * 15), (5, many(40))]
    docs = [b + a, many(30) + b + a + many(30), many(7) + items[1][1][15:] + items[1][1][:15] + many(7), ["again"] * 300,
            many(20) + ["again"] * 11 + many(20), c + a, many(50) + c + a + many(3), many(10) + items[4][1][15:] + items[4][1][:15],
            (items[1][1] + many(2)) * 4, many(60), b + many(1) + a, a + many(40) + b]
    for edits in range(1, 5):  # around the threshold
        for _ in range(12):
            t = list(items[5][1])
            for at in rnd.sample(range(40), edits):
                t[at:at + 1] = rnd.choice(([], many(1), many(2)))
            docs.append(many(rnd.randrange(20)) + t + many(rnd.randrange(20)))
    docs = list(enumerate(docs))
    want = {(d, i): best for d, w in docs for i, t in items if (best := brute_windows(w, t))[0] >= .75}
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    rows = decontamination.contaminated(frame(spark, [(d, " ".join(w)) for d, w in docs]), bench).collect()
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], -r["start"]) for r in rows}
    assert {(1, 0), (0, 0), (3, 2), (4, 2), (6, 3)} <= set(want)
    assert set(got) == set(want)
    assert all(abs(got[x][0] - want[x][0]) < 1e-12 and got[x][1] == want[x][1] for x in want)


def test_window_starts_are_all_and_only_those_with_enough_hits(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(400):
        n, m = rnd.randrange(1, 40), rnd.randrange(1, 15)
        p = sorted(rnd.sample(range(n), rnd.randrange(1, n + 1)))
        need = rnd.randrange(1, min(len(p), m) + 1)
        rows.append((p, n, m, need))
    got = spark.createDataFrame(rows, "p array<int>, n int, m int, need int").select("p", "n", "m", "need", F.expr(decontamination.STARTS).alias("s")).collect()
    for r in got:
        want = [s for s in range(max(1, r["n"] - r["m"] + 1)) if sum(s <= x < s + r["m"] for x in r["p"]) >= r["need"]]
        assert r["s"] == want, r
