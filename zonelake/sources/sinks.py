"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from zonelake.sources.catalog import published_name, table_path


def write_table(
    df: DataFrame | None,
    path: str | None = None,
    *,
    base: str | None = None,
    zone: str | None = None,
    datasource: str | None = None,
    dataset: str | None = None,
    mode: str = "append",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    fmt: str = "parquet",
) -> str | None:
    """Write to a path, or to the table named by base, zone, datasource and dataset; no frame writes nothing.

    Appended files may add columns: parquet readers merge schemas, and ``delta`` is told to.  ``sort_by`` orders the
    rows inside each file, which sharpens the min/max statistics for later filters without a global sort.
    """
    if df is None:
        return None
    if path is None:
        if not (base and zone and datasource and dataset):
            raise ValueError("give either path or all of base, zone, datasource and dataset")
        path = table_path(base, zone, datasource, dataset)
    writer = (df.sortWithinPartitions(*sort_by) if sort_by else df).write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def append_evolving(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Rows of both frames by column name; a column missing on one side is NULL there."""
    return new if existing is None else existing.unionByName(new, allowMissingColumns=True)


def replace_table(df: DataFrame, name: str) -> None:
    """Create or replace a managed table from a query."""
    df.write.mode("overwrite").saveAsTable(name)


def replace_view(df: DataFrame, name: str) -> None:
    """Create or replace a session view: nothing is written, consumers share Catalyst's plan."""
    df.createOrReplaceTempView(name)


def export_tables(tables: dict[tuple[str, str], DataFrame], target: str) -> dict[str, str]:
    """Overwrite one flat parquet folder per (datasource, dataset)."""
    paths = {}
    for (datasource, dataset), df in tables.items():
        name = published_name(datasource, dataset)
        paths[name] = write_table(df, f"{target.rstrip('/')}/{name}", mode="overwrite")
    return paths


def register_exports(spark: SparkSession, target: str, names: list[str]) -> DataFrame:
    """Register exported folders as views.  A folder that cannot be read is reported, not fatal: (table, status)."""
    status = []
    for name in names:
        try:
            replace_view(spark.read.parquet(f"{target.rstrip('/')}/{name}"), name)
            status.append((name, "registered"))
        except AnalysisException as problem:
            status.append((name, f"skipped: {problem.getCondition() or 'unreadable'}"))
    return spark.createDataFrame(status, "`table` STRING, status STRING")


def append_json(df: DataFrame, path: str) -> None:
    """Append rows as JSON documents."""
    df.write.mode("append").json(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def mark_rows_exported(ids: DataFrame, ledger: str) -> None:
    """Append exported ids with the time; the next extract leaves them out."""
    ids.withColumn("exported_at", F.current_timestamp()).write.mode("append").parquet(ledger)
