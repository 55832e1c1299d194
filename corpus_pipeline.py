"""A training corpus from `documents`: five stages, each one operator, each written and
reread before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from liftwise.llm.batches import bounded, stored, table
from liftwise.session import tune

# Ids that a stage rejects are broadcast up to this many, and joined by a shuffle beyond.
BROADCAST_IDS = 200_000
# Near copies of the stage: shingles of five words, four fifths in common (op4 has its own).
STAGE_WIDTH, STAGE_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the classifier go."""
    tune(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = quality.judge(docs.select(F.struct("*").alias("row"), "text"), model).where("kept")
    return kept.select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; documents left without a word go too."""
    tune(spark)
    slim = line_dedup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    words = F.coalesce(F.btrim(text, F.lit(line_dedup.SPACES)) != "", F.lit(False))
    fresh = {"text": text, "n_chars": F.when(changed, F.char_length("kept")).otherwise(F.col("n_chars"))}
    return slim.where(~changed | words).select(
        *[fresh.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]
    )


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of the smallest doc_id."""
    tune(spark)
    found = ngram_join.jaccard_components(docs, STAGE_WIDTH, STAGE_PERCENT)
    gone = stored(
        found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(),
        "duplicates",
    )
    return docs.join(bounded(gone, BROADCAST_IDS), F.col("doc_id") == F.col("_gone"), "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    tune(spark)
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(found.select(F.col("doc_id").alias("_gone")).distinct(), "contaminated")
    return docs.join(bounded(gone, BROADCAST_IDS), F.col("doc_id") == F.col("_gone"), "left_anti")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the encoding and of the text decoded from it."""
    tune(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encoding_digests(docs.select("doc_id", "text"), path).drop("text")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding", bpe_encoding),
]

# The classifier, the similarity join and the tokenizer have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are stored before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
