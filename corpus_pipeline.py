"""Corpus pipeline: language ID, exact dedup, near dedup, benchmark
decontamination and packing, each stage one operator's decisions applied.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  A stage's result is written as
Parquet and read again as the next one's docs.

Rows whose doc_id is null are documents like others.  Rows repeated with the
same doc_id and text count as copies of one document: exact dedup keeps one.
A corpus without a single language label has nothing to learn languages from:
the language stage then keeps every row.  Null and empty texts have no letter and
go with the language stage, or else stay as documents that link with nothing.
Empty tables pass through all stages; texts of any length are whole; more
columns of any name stay as they are.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickforge.llm import decontamination, exact_dedup, language_id, ngram_join, packing
from clickforge.llm.common import keep_written, table
from clickforge.llm.queries import VOCABULARY

#: Texts whose language is this uncertain go, as do those without a letter.
LEAST_LANGUAGE_SCORE = 0.3


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``docs`` has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    return [next(x for i in itertools.count() if (x := f"__{n}{i or ''}") not in taken) for n in names]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that the language identifier recognises; all of them where no
    row has a language to learn from."""
    model = language_id.fit(docs)
    if model is None:
        return docs
    lang, score = fresh(docs, "lang", "score")
    out = language_id.with_language(docs, model, lang_out=lang, score_out=score)
    return out.where((F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts."""
    key, sha, kept_id, kept_sha, place = fresh(docs, "id", "sha", "kept_id", "kept_sha", "n")
    kept = exact_dedup.exact_dedup(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha)).distinct()
    # a row is known by its id and its normalised text; of repeated rows any one stays
    norm = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", ""), 256)
    rows = docs.withColumn(sha, norm).withColumn(key, F.col("doc_id"))
    rows = rows.join(kept, F.col(key).eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha)))
    order = Window.partitionBy(key, sha).orderBy(F.length("text").desc(), *[F.col(c) for c in docs.columns if c not in ("doc_id", "text")])
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns)


def with_key(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """(``docs`` with a key of the row's doc_id and text, a written table of the
    keys with their doc_ids, the key's name).  Only rows that are copies share a
    key: the digests show whether two others do, and then all keys are drawn
    anew."""
    (key,) = fresh(docs, "key")
    for salt in range(64):
        text = F.col("text").cast("string")
        keyed = docs.withColumn(key, F.xxhash64(F.lit(salt), F.col("doc_id").isNull(), F.col("doc_id"), text.isNull(), text))
        keys = keep_written(keyed.select(F.col(key).alias("key"), "doc_id", F.unhex(F.sha2(text, 256)).alias("sha")), "stage-keys")
        row = F.struct("doc_id", "sha")
        if keys.groupBy("key").agg(F.min(row).alias("low"), F.max(row).alias("high")).where(~F.col("low").eqNullSafe(F.col("high"))).isEmpty():
            return keyed, keys, key
    raise RuntimeError("no salt gives different documents different keys")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near
    duplicates, one without an id only if none has one; texts without words
    link with nothing and stay."""
    keyed, keys, key = with_key(docs)
    joined = ngram_join.ngram_jaccard_join(keyed.select(key, "text"), id_col=key).select(F.col("doc_id").alias("key"), "component_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("key").alias("key")))
    kept = joined.join(keys.select("key", "doc_id").distinct(), "key").groupBy("component_id").agg(first.alias("first")).select(F.col("first.key").alias(key))
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    keyed, _, key = with_key(docs)
    found = decontamination.contaminated(keyed.select(key, "text"), table(spark, sf_dir, "benchmark"), id_col=key)
    return keyed.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of what is left into sequences."""
    return packing.pack_tokens(docs, VOCABULARY)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The stages train a model and pack heuristically; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    def step(docs: DataFrame, stage) -> DataFrame:
        name, function = stage
        return keep_written(function(spark, docs, sf_dir), f"stage-{name}")

    return functools.reduce(step, STAGES, table(spark, sf_dir, "documents"))
