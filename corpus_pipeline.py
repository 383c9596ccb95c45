"""Corpus pipeline: documents in, token shards out.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)``.
Every stage but the last returns the columns of ``documents`` (and any extra
ones) untouched; ``run`` writes each result as Parquet to the shared folder
and rereads it for the next one.

Nulls and odd rows follow the operators: rows without text or letters go in
the first stage; null doc_id, null source, repeated rows and empty tables
pass through every stage with the result its operator defines.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import decontaminate, langid, mixture, repair, setsketch
from ledgerlake.llm.common import filter_rows
from ledgerlake.llm.queries import benchmark, documents, tokenizer_path
from ledgerlake.session import scratch_path

MIN_POSTERIOR = 0.5      # of the best language; below it a document is rejected
WIDTH, PERCENT = 5, 80   # near-duplicates: word shingles and similarity


#: One executor runs stages with different Python workers one after the other;
#: idle ones keep what their allocator holds. Freed arrays go back to the
#: system, and Spark hands over documents in batches of some 8 MB. Arrays of up
#: to 4 MB (a block of ids, a slice of letters) are taken from the heap again:
#: fresh pages for each of them cost as much CPU time as the work on them.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "4194304", "MALLOC_TRIM_THRESHOLD_": "16777216", "MALLOC_ARENA_MAX": "2",
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}
LETTERS_SLICE = 1 << 18  # text scored at once (its arrays stay below 4 MB)
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def bounded_workers(spark: SparkSession) -> None:
    """Settings of the pipeline's Python workers, where the session has none."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    if spark.conf.get(BATCH_BYTES[0]) == "67108864b":   # Spark's own default
        spark.conf.set(*BATCH_BYTES)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter or no clearly best language."""
    bounded_workers(spark)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"), 4, 2)))
    shared = spark.sparkContext.broadcast((model.langs, model.logp, model.prior))

    def keep(texts):
        own = langid.Model(*shared.value)
        if not own.langs:
            return np.zeros(len(texts), bool)
        _, posterior, letters = langid.score(own, *langid.letters(texts))
        return letters & (posterior >= MIN_POSTERIOR)
    return filter_rows(docs, keep, LETTERS_SLICE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    bounded_workers(spark)
    return setsketch.drop_near_duplicates(docs, WIDTH, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that contain a benchmark item."""
    bounded_workers(spark)
    return decontaminate.drop_leaks(docs, benchmark(spark, sf_dir))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each up to twice, near the sources' target weights."""
    return mixture.mix_documents(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left, write compressed token shards, read them back."""
    bounded_workers(spark)
    return repair.encode_documents(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("source_mixture", source_mixture), ("token_shards", token_shards)]

#: Language models, sketches and tokenizers are outside SQL; tests compare
#: the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
