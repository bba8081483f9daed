"""Zones, table discovery and the property ledger."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = ("Landing", "Trusted", "Exploitation")
SNAPSHOT = "snapshot_ts"
LEDGER_SCHEMA = "`table` STRING, property STRING, value STRING, updated_at TIMESTAMP"


def table_path(
    base: str, zone: str, datasource: str, dataset: str, snapshot: datetime.datetime | None = None
) -> str:
    """Folder of a table.  Landing and Exploitation tables end in a snapshot partition that sorts by time."""
    if zone not in ZONES:
        raise ValueError(f"invalid zone '{zone}'; valid zones are {', '.join(ZONES)}")
    stable = f"{base.rstrip('/')}/{zone}/{datasource}/{dataset}"
    if zone == "Trusted":
        return stable
    moment = snapshot or datetime.datetime.now(datetime.timezone.utc)
    return f"{stable}/{SNAPSHOT}={moment:%Y%m%dT%H%M%S}"


def published_name(datasource: str, dataset: str) -> str:
    """Flat name of a published table."""
    return f"{datasource}_{dataset}"


def discover_tables(spark: SparkSession, root: str) -> DataFrame:
    """(table, files): folders below ``root`` that hold parquet data, as paths relative to it.

    The file listing is a distributed scan of paths only; no content is read.  Hive partition folders belong to
    their table, except the snapshot partition, which is part of the table's name.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path")
    )
    below = F.regexp_replace("path", rf"^.*?\Q{root.rstrip('/')}\E/", "")
    folder = F.regexp_replace(below, r"/[^/]*$", "")
    table = F.regexp_replace(folder, rf"/(?!{SNAPSHOT}=)[^/=]+=[^/]*", "")
    return files.groupBy(table.alias("table")).agg(F.count(F.lit(1)).alias("files"))


def catalog_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the registered tables and views, sorted."""
    return sorted(table.name for table in spark.catalog.listTables(database))


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A registered table, or an empty frame of the schema when it does not exist."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- properties


def set_property(spark: SparkSession, ledger: str, table: str, name: str, value: bool | str) -> None:
    """Append the new value of a table property; earlier values stay as history."""
    entry = spark.createDataFrame([(table, name, str(value).lower())], "`table` STRING, property STRING, value STRING")
    entry.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    from pyspark.sql.utils import AnalysisException

    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def latest_flags(ledger: DataFrame, names: tuple[str, ...] = ("exported", "quarantine")) -> DataFrame:
    """One row per table with the latest value of each flag; a flag never set is false."""
    flag = lambda name: F.coalesce(
        F.max_by(F.when(F.col("property") == name, F.lower("value") == "true"),
                 F.when(F.col("property") == name, F.col("updated_at"))),
        F.lit(False),
    )
    return ledger.groupBy("table").agg(*[flag(name).alias(name) for name in names])


def settled_tables(ledger: DataFrame) -> DataFrame:
    """Tables that are exported or quarantined."""
    return latest_flags(ledger).filter("exported OR quarantine").select("table")


def is_settled(spark: SparkSession, ledger: str, table: str) -> bool:
    return not settled_tables(read_ledger(spark, ledger)).filter(F.col("table") == table).isEmpty()
