"""Training-corpus pipeline: language, near copies, benchmark leaks, secrets, packing; each stage calls one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontam, langid, packing, secrets, simhash
from shelfwise.llm.common import written

WORD_TOKENIZER = "word_bpe_49k.json"


def _with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """A column of id and text hash under a name that is free: rows without id, or with a shared one, are told apart
    by their texts."""
    name = "_key"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tag"))), name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts that are null or hold no letters go."""
    return langid.keep_identified(docs, langid.train(docs.where(~langid.held_out(F.col("doc_id")))))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id; of wholly equal rows one."""
    keyed, key = _with_key(docs)
    groups = simhash.simhash_groups(keyed, shingle=3, radius=2, id_col=key)
    heads = groups.where(F.col(key) == F.col("component_id")).select(key).distinct()
    return keyed.join(heads, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is 0.8 similar to a benchmark item."""
    (keyed, key), benchmark = _with_key(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontam.benchmark_leaks(keyed, benchmark, similarity=0.8, id_col=key)
    return keyed.join(leaks.select(key).distinct(), key, "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, confirmed secrets masked; ``n_chars`` follows the text."""
    clean = secrets.mask_secrets(docs)
    changed = F.coalesce(F.col("text").contains(secrets.MASK), F.lit(False))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars"))).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER), capacity=4096, end_id=1)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # the stages are not expressible in SQL; tests hold each against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
