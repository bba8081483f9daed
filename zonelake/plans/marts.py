"""KPI tables and the data marts that hold them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.scalars import month_key
from zonelake.operators.windows import change_over_previous


def monthly_transactions(transactions: DataFrame) -> DataFrame:
    """Amount, count and mean login attempts per user and month.

    Grouped by the month's first day, a number; the month is written out as text once per result row.
    """
    totals = transactions.groupBy("user_id", F.trunc("timestamp", "month").alias("_first_day")).agg(
        F.sum("amount").alias("total_amount"),
        F.count(F.lit(1)).alias("tx_count"),
        F.avg("login_attempts").alias("avg_login_attempts"),
    )
    return totals.select(
        "user_id", month_key("_first_day").alias("month"), "total_amount", "tx_count", "avg_login_attempts"
    )


def status_counts(kyc: DataFrame) -> DataFrame:
    return kyc.groupBy("status").agg(F.count(F.lit(1)).alias("cnt"))


def indicator_growth(indicators: DataFrame) -> DataFrame:
    """Change of each indicator over its previous year."""
    return change_over_previous(indicators, ["indicator"], "year", "value", "yoy_change").select(
        "indicator", "year", "yoy_change"
    )


def volume_by_currency(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("currency").agg(F.sum("amount").alias("total_amount"))


def financial_totals(report: DataFrame) -> DataFrame:
    """Sum of all line items per company, period and statement."""
    return report.groupBy("symbol", "year", "quarter", "statement").agg(F.sum("value").alias("total_value"))


@dataclass(frozen=True)
class Kpi:
    """A KPI table: the input it is computed from and the order it is presented in."""

    name: str
    source: str
    compute: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class Mart:
    name: str
    inputs: tuple[str, ...]
    kpis: tuple[Kpi, ...]


# Names of the marts, their inputs and KPI tables.
RISK = Mart(
    "risk_mgmt",
    ("ops_db_user_transactions", "ops_db_user_profiles", "ops_db_kyc_metadata"),
    (
        Kpi("kpi_monthly_tx", "ops_db_user_transactions", monthly_transactions, ("user_id", "month")),
        Kpi("kpi_kyc_status", "ops_db_kyc_metadata", status_counts),
    ),
)
MARKET = Mart(
    "market_intel",
    ("eodhd_financial_news", "imf_indicators"),
    (Kpi("kpi_imf_growth", "imf_indicators", indicator_growth, ("indicator", "year")),),
)
FINANCE = Mart(
    "finance_reporting",
    ("finnhub_financial_report", "ops_db_user_transactions"),
    (
        Kpi("kpi_tx_volume_currency", "ops_db_user_transactions", volume_by_currency),
        Kpi("kpi_financial_totals", "finnhub_financial_report", financial_totals, ("symbol", "year", "quarter", "statement")),
    ),
)
MARTS = (RISK, MARKET, FINANCE)


def mart_tables(mart: Mart, tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]]]:
    """(KPI frames that can be computed, status of every input and KPI as (mart, table, status)).

    A missing input is reported and only the KPIs that need it are left out.
    """
    status = [(mart.name, name, "loaded" if name in tables else "missing") for name in mart.inputs]
    frames = {kpi.name: kpi.compute(tables[kpi.source]) for kpi in mart.kpis if kpi.source in tables}
    status += [
        (mart.name, kpi.name, "built" if kpi.name in frames else f"skipped: {kpi.source} is missing") for kpi in mart.kpis
    ]
    return frames, status


def publish_mart(spark: SparkSession, mart: Mart, tables: dict[str, DataFrame], keep_inputs: bool = True) -> DataFrame:
    """Write a mart as a database of tables and return its status rows.

    KPI tables are range-partitioned and sorted by their presentation order; inputs are written as they are.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {mart.name}")
    frames, status = mart_tables(mart, tables)
    for name in mart.inputs if keep_inputs else ():
        if name in tables:
            tables[name].write.mode("overwrite").saveAsTable(f"{mart.name}.{name}")
    for kpi in mart.kpis:
        if kpi.name in frames:
            ordered = frames[kpi.name].orderBy(*kpi.order) if kpi.order else frames[kpi.name]
            ordered.write.mode("overwrite").saveAsTable(f"{mart.name}.{kpi.name}")
    return spark.createDataFrame(status, "mart STRING, `table` STRING, status STRING")
