"""The corpus pipeline: each stage reads what its predecessor wrote.

A stage is called after the result of its predecessor is written, so it first removes what that one has staged.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm import chunks, metric_join, packing, pfair, toxicity
from zonelake.llm.common import stage, staging
from zonelake.llm.queries import OTHER, WEIGHTS, prepare


def stage_function(function):
    """Removes what the last stage has staged, and sets the session up."""

    @wraps(function)
    def run_alone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with staging(spark):
            return function(prepare(spark), docs, sf_dir)

    return run_alone


@stage_function
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


@stage_function
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of lines that stand elsewhere; ``n_chars`` counts what is left."""
    cut = chunks.remove_repeats(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return cut


@stage_function
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all documents without words."""
    return metric_join.one_of_each(docs)


@stage_function
def mix_by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the files and the rows in them follow the schedule."""
    mixed = pfair.mix_sources(docs, "source", "doc_id", WEIGHTS, OTHER)
    return mixed.orderBy("slot", "place").select(*docs.columns)


@stage_function
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens; the sequences follow the mix."""
    return packing.pack_documents_in_order(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("source_mixing", mix_by_weight),
    ("packing", pack_sequences),
]

#: The classifier and the tokenizer are beyond SQL; tests check columns, counts and kept rows of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
