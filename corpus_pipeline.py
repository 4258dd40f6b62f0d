"""A training corpus from raw documents: five stages, each an operator over what its predecessor kept.

Null and empty texts are documents: they have no toxic words and no copies, lose no passage, and are packed as an end id
alone where the mix takes them. Very long texts are read whole. Rows that repeat a doc_id are rows of their own, decided
each; of rows equal in doc_id and text the second stage keeps one. Ties go to the smaller doc_id, rows without one come
last. An empty table gives an empty result. Extra columns play no part; all stages but the last return COLUMNS.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from grainmill.llm import common, mixing, neardup, packing, suffixes, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents at or above this probability of label 1 are rejected.
TOXIC_AT = 0.7


#: Rows and bytes that go to a Python worker at once. One executor runs all stages, one after the other; what buffers they
#: needed at most stays with it.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _frugal(stage):
    """The stage, with the session's batches bounded, and what earlier stages left in this process given back."""

    @wraps(stage)
    def run_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCH.items():
            spark.conf.set(name, value)
        common.trim()
        return stage(spark, docs, sf_dir)

    return run_


@_frugal
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely to be toxic go. The model is learnt from the labelled ones among docs."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, TOXIC_AT).where("predicted = 0").select(*COLUMNS)


@_frugal
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that of the least doc_id; rows without words all stay."""
    return neardup.one_of_each(docs).select(*COLUMNS)


@_frugal
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that an earlier document has go; bytes that no longer form a character go too."""
    found = suffixes.repeats(docs.withColumn("none", F.col("text").isNull()), carry=("lang", "source", "none"))
    text = F.when(~F.col("none"), suffixes.readable("kept"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_frugal
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.mixed(docs).select(*COLUMNS)


@_frugal
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", toxic), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages), ("mixing", mixed), ("packing", packed)]

#: A nearest-neighbour model, sampling and a tokenizer stand in the stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if before is not None:
            common.discard(before)
        before = docs
    return docs
