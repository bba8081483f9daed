"""Counts, profiles and classification statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from zonelake.sources.readers import read_table


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text, n) for each distinct value, NULL included, in one scan and one shuffle.

    Counts are combined before the shuffle, so a frequent value is a single row per task.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], columns, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, columns: list[str] | None = None, table: str = "", exact: bool = True) -> DataFrame:
    """(table, column, type, rows, nulls, distinct) per column.

    ``exact=False`` uses sketches: one pass and no shuffle of values, for very large tables.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    columns = columns or list(types)
    named_types = F.create_map(*[F.lit(part) for c in columns for part in (c, types[c])])
    if exact:
        summary = (
            value_counts(df, columns)
            .groupBy("column")
            .agg(
                F.sum("n").alias("rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
                F.count("value").alias("distinct"),
            )
        )
    else:
        parts = [
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.approx_count_distinct(c).alias("distinct"),
            )
            for c in columns
        ]
        summary = df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))
    return summary.select(
        F.lit(table).alias("table"), "column", F.element_at(named_types, F.col("column")).alias("type"),
        "rows", "nulls", "distinct",
    )


def profile_tables(spark: SparkSession, names: list[str], exact: bool = True) -> tuple[DataFrame | None, dict[str, str]]:
    """(profiles of all readable tables, problem per unreadable table): one bad table does not stop the others."""
    profiles, problems = [], {}
    for name in names:
        try:
            profiles.append(column_profile(read_table(spark, name), table=name, exact=exact))
        except AnalysisException as problem:
            problems[name] = problem.getCondition() or str(problem)
    return (reduce(DataFrame.unionByName, profiles) if profiles else None), problems


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows as JSON text, for a profile or preview."""
    return df.limit(n).select(F.to_json(F.struct("*")).alias("row"))


def schema_tree(df: DataFrame) -> str:
    """Schema as JSON, as it is recorded by audits."""
    return df.schema.json()


def max_value(df: DataFrame | None, column: str) -> DataFrame | None:
    """One-row frame with the maximum; None when the table or column is missing or the type has no useful order."""
    if df is None or column not in df.columns:
        return None
    if isinstance(df.schema[column].dataType, (T.StructType, T.MapType, T.ArrayType)):
        return None
    return df.agg(F.max(column).alias("max_value"))


def dominant_value(df: DataFrame, key: str, column: str, name: str = "dominant") -> DataFrame:
    """Most frequent non-NULL value per key, the smallest on a tie.

    Counts per (key, value) are made first, so a hot key arrives as one row per value.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(name))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Count per (actual, predicted)."""
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per class: support, precision, recall, F1; a ratio with denominator 0 is 0.

    Each matrix cell adds to the row of its actual and of its predicted class, so the report is a second small
    aggregation over the confusion matrix.
    """
    cell = confusion(df, actual, predicted)
    hit = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0)
    roles = F.array(
        F.struct(F.col(actual).alias("label"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("p"), hit.cast("bigint").alias("h")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("h")),
    )
    totals = cell.select(F.inline(roles)).groupBy("label").agg(
        F.sum("a").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("hits")
    )
    ratio = lambda top, bottom: F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))
    scored = totals.select(
        "label", "support", ratio("hits", "predicted").alias("precision"), ratio("hits", "support").alias("recall")
    )
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", F.coalesce(f1, F.lit(0.0)))
