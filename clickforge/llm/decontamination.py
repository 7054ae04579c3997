"""Benchmark decontamination with DataFrame functions only.

1. Texts and items become arrays of word shingle hashes.  An item's windows in a
   text are its runs of as many shingles as the item has.  A window can only be
   similar enough to an item of its size if so many of its shingles occur in
   items of that size; the sorted positions of such shingles give exactly the
   starts of all windows for which this holds, whichever item they may be
   similar to and however its parts are ordered.
2. Each distinct window content and each item gets a 64-bit SimHash fingerprint.
   A multi-index of RADIUS + 1 bit blocks, joined on the block's bits alone
   (of one window size), finds every pair within RADIUS: by the pigeonhole
   principle such a pair agrees in at least one block.
3. Pairs within the radius are verified by their exact similarity: the
   weighted Jaccard of their shingles, each weighing as often as it occurs.

Contents are fingerprinted and verified once, however many documents hold them.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_written

SHINGLE = 5
SIMILARITY = 0.75
#: At similarity 0.75 fingerprints differ in 11 bits on average, with a
#: standard deviation of 3; this is four deviations further out.
RADIUS = 23
#: Benchmark shingles up to which they are broadcast; beyond, the join shuffles.
BROADCAST_SHINGLES = 400_000
WORD = r"[\p{L}\p{N}]+"


def _words(text):
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(words: str, k: int) -> str:
    """SQL for the hashes of the k-word shingles of an array column."""
    parts = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return f"if(size({words}) >= {k}, transform(sequence(0, size({words}) - {k}), i -> xxhash64({parts})), array())"


#: SQL of the SimHash of an array column of 64-bit hashes named w.
SIMHASH = ("aggregate(sequence(0, 63), 0L, (f, b) -> f | if(2 * aggregate(w, 0, (n, h) -> n + cast(shiftrightunsigned(h, b) & 1L as int)) > size(w), "
           "shiftleft(1L, b), 0L))")


#: SQL of the starts of all windows of m shingles with at least ``need`` of the sorted positions p, in a text of n shingles.
#: Position i is a window's first one if the window starts after position i - 1, so no start is named twice.
STARTS = ("if(n <= m, if(size(p) >= need, array(0), array()), flatten(transform(sequence(0, size(p) - need), "
          "i -> transform(array(struct(greatest(p[i + need - 1] - m + 1, if(i = 0, 0, p[greatest(i - 1, 0)] + 1), 0) as low, least(p[i], n - m) as high)), "
          "r -> if(r.low <= r.high, sequence(r.low, r.high), array()))[0])))")


def _blocks(fingerprint: str):
    """(block, value) rows of a fingerprint: RADIUS + 1 runs of bits."""
    n = RADIUS + 1
    cut = [64 * i // n for i in range(n + 1)]
    structs = [f"struct({i} as block, shiftrightunsigned({fingerprint}, {cut[i]}) & {(1 << (cut[i + 1] - cut[i])) - 1}L as value)" for i in range(n)]
    return F.expr(f"inline(array({', '.join(structs)}))")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and benchmark item that it holds a passage of:
    doc_id, item_id, similarity, hamming, start (word of the best window, its
    first of equals).

    Words are runs of letters and digits in lower case.  An item of fewer than
    five words is one shingle; null or empty items and texts match nothing.
    Windows lie inside the text; a text shorter than
    the item is compared whole; very long texts are whole too.  Of equally similar
    windows the first counts.  Repeated rows and ids give one row per id; a
    null id is an id like others.  Other columns are not read, whatever their
    names; empty tables give an empty result.
    """
    items = (benchmark.select(F.col(item_col).alias("item_id"), _words(F.col(item_text)).alias("words")).where(F.size("words") > 0)
             .withColumns({"k": F.least(F.size("words"), F.lit(SHINGLE))}))
    ks = sorted(r["k"] for r in items.select("k").distinct().collect()) or [SHINGLE]  # at most SHINGLE values
    sets = _per_k(ks, lambda k: items.where(F.col("k") == k).select("item_id", "k", F.expr(_shingles("words", k)).alias("w")))
    sets = sets.withColumn("m", F.size("w")).withColumn("fp", F.expr(SIMHASH)).withColumn("item", F.monotonically_increasing_id())
    sets = keep_written(sets, "benchmark-items")
    n_bench = sets.agg(F.sum("m")).first()[0] or 0
    few = (lambda n: F.broadcast if n <= BROADCAST_SHINGLES else (lambda df: df))

    # 1. shingles of the texts that occur in items, by the size of these items
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), _words(F.col("text")).alias("words"))
    grams = _per_k(ks, lambda k: texts.select("text_key", F.lit(k).alias("k"), (F.size("words") - k + 1).alias("n_grams"),
                                              F.posexplode(F.expr(_shingles("words", k))).alias("pos", "h")))
    sizes = sets.select("k", "m", F.explode("w").alias("h")).distinct()
    hits = grams.join(few(n_bench)(sizes), ["k", "h"])
    # copies of a text are one: its positions are a set, not longer than the text
    found = hits.groupBy("text_key", "k", "m").agg(F.collect_set("pos").alias("p"), F.max("n_grams").alias("n"))
    # a window that reaches the similarity shares this many of its shingles with the item
    need = F.ceil(F.lit(similarity / (1 + similarity)) * (F.least("m", "n") + F.col("m")) - F.lit(1e-9)).cast("int")
    found = found.withColumn("need", F.greatest(need, F.lit(1))).where(F.size("p") >= F.col("need")).withColumn("p", F.sort_array("p"))
    windows = found.withColumn("starts", F.expr(STARTS)).where(F.size("starts") > 0)
    # rows of one text: its windows, not more than its words for each size
    windows = windows.groupBy("text_key").agg(F.collect_list(F.struct("k", "m", "starts")).alias("found"))
    windows = keep_written(windows, "benchmark-windows")

    # 2. all these windows, cut from their texts; each content once
    rows = texts.join(windows, "text_key").select("doc_id", "words", F.explode("found").alias("f")).select("doc_id", "words", "f.*")
    cut = _per_k(ks, lambda k: rows.where(F.col("k") == k).select("doc_id", "k", "m", "starts", F.expr(_shingles("words", k)).alias("all")))
    cut = cut.select("doc_id", "k", "m", "all", F.explode("starts").alias("start")).select("doc_id", "k", "m", "start", F.expr("slice(all, start + 1, m)").alias("w"))
    content = F.struct(F.xxhash64("k", "w").alias("a"), F.xxhash64("w", F.lit(1), "k").alias("b"))
    cut = keep_written(cut.withColumn("content", content), "benchmark-cuts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # fingerprints are the costly part: spread over as many tasks whatever the rows' size
    contents = cut.groupBy("content", "k", "m").agg(F.first("w").alias("w")).repartition(parts, "content")
    contents = keep_written(contents.withColumn("fp", F.expr(SIMHASH)), "benchmark-contents")

    left = contents.select("content", "k", "m", "fp", _blocks("fp"))
    right = sets.select("item", "k", "m", F.col("fp").alias("ifp"), _blocks("fp"))
    near = left.join(few(sets.count() * (RADIUS + 1))(right), ["k", "m", "block", "value"])
    near = near.withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp")))).where(F.col("hamming") <= RADIUS)
    near = near.select("content", "item", "hamming").distinct()

    # 3. exact similarity, then back to the documents
    pairs = near.join(contents.select("content", "w"), "content").join(few(n_bench)(sets.select("item", "item_id", F.col("w").alias("iw"))), "item")
    common = F.expr("aggregate(array_intersect(w, iw), 0, (n, x) -> n + least(size(filter(w, y -> y = x)), size(filter(iw, y -> y = x))))")
    scored = pairs.withColumn("common", common).withColumn("similarity", F.col("common") / (F.size("w") + F.size("iw") - F.col("common")))
    same = keep_written(scored.where(F.col("similarity") >= similarity).select("content", "item_id", "similarity", "hamming"), "benchmark-matches")
    held = cut.select("doc_id", "start", "content").join(few(same.count())(same), "content")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("first"), (-F.col("hamming")).alias("near")))
    return (held.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.near")).alias("hamming"), (-F.col("b.first")).alias("start")))


def _per_k(ks: list[int], make) -> DataFrame:
    """The union of a table per shingle length."""
    return functools.reduce(DataFrame.unionByName, [make(k) for k in ks])
