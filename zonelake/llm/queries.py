"""The operators of this package applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonelake.llm import (
    alignment, bestfit, chunks, languages, metric_join, negatives, neighbours, packing, pfair, spotsigs, suffixes, toxicity,
    urls,
)
from zonelake.session import ensure_runtime

#: Target weights of the mix; sources that are not named share ``OTHER``.
WEIGHTS = {"src0": 3.0, **{f"src{i}": 1.0 for i in range(1, 15)}, **{f"src{i}": 0.5 for i in range(15, 20)}}
OTHER = 0.5
#: Rows that go to a Python worker at once: texts can be long.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> SparkSession:
    ensure_runtime(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = metric_join.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, folder, "documents"))


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return pfair.mix_sources(docs, "source", "doc_id", WEIGHTS, OTHER)


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, folder, "pages"), keep=("page_id",))
    return judged.select("page_id", "host", "path", "rule", "verdict", "soft_hits")


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, folder, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeated_strings(table(spark, folder, "documents")).drop("kept")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    names, chances = languages.train(table(spark, folder, "documents"))
    return languages.identify(table(spark, folder, "pages"), names, chances)


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.link_statistics(table(spark, folder, "documents"), *alignment.default_paths())


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return bestfit.pack_documents(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_line_dedup, op3_packing, op4_document_fingerprints, op5_source_mixing,
        op6_url_filters, op7_nearest_neighbours, op8_suffix_dedup, op9_toxicity, op10_language_id,
        op11_tokenizer_alignment, op12_hard_negatives, op13_best_fit_packing,
    )
}
ORACLES = {"op6_url_filters": urls.url_sql(), "op12_hard_negatives": negatives.negatives_sql()}
