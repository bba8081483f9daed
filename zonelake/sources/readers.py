"""Batch sources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A table by catalog name, or by path when the text contains a slash.  Evolved schemas are merged."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", "true") if fmt == "parquet" else reader).load(name_or_path)


def read_parquet_tree(spark: SparkSession, path: str, file_column: str | None = None) -> DataFrame:
    """Parquet files under a path or glob with hive partitions, optionally with the file name of each row."""
    df = spark.read.parquet(path)
    return df.select("*", F.col("_metadata.file_path").alias(file_column)) if file_column else df


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays a string."""
    return spark.read.option("header", True).csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Multi-line JSON files: an object is one row, an array is one row per element.

    Give the schema for documents with dynamic keys (as MAP); without it the shape is inferred.
    """
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def land_api_payload(spark: SparkSession, payload: dict | list | None, path: str) -> str | None:
    """Append one API response to a landing folder, one JSON document per line; empty input writes nothing."""
    documents = payload if isinstance(payload, list) else [payload] if payload else []
    if not documents:
        return None
    rows = [(json.dumps(document),) for document in documents]
    spark.createDataFrame(rows, "value STRING").write.mode("append").text(path)
    return path


def read_landed_payloads(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Documents landed by :func:`land_api_payload`."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def rows_as_table(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame | None:
    """Rows fetched by a client, with an explicit schema (all-NULL columns keep their type); no rows gives None."""
    return spark.createDataFrame(rows, schema) if rows else None


def read_relational(
    spark: SparkSession, url: str, query: str, split: tuple[str, int, int, int] | None = None, **options: str
) -> DataFrame:
    """A query over JDBC, run in the database.  ``split`` (column, low, high, parts) reads it in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS pending").options(**options)
    if split:
        column, low, high, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()
