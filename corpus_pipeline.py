"""Documents to training tokens: quality rules, line dedup, SimHash near-dedup,
benchmark decontamination, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last keep the columns of ``documents``.  :func:`run` writes what a stage returns
as Parquet in the session's shared folder and hands that to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.llm import bpe, decontamination, line_dedup, quality_rules, simhash
from actlens.llm.queries import tokenizer_file
from actlens.sources.scratch import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fit(docs, labels))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; ``n_chars`` follows the text."""
    cut = line_dedup.drop_boilerplate(docs, counts=False)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest ``doc_id``."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, its token ids and their digests; the ids are decoded again for the last digest."""
    return bpe.digests(docs, *tokenizer_file(), with_ids=True, memo=100_000)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_boilerplate),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: The learned rules, fingerprints, retrieval and encoding are not SQL; tests
#: compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
