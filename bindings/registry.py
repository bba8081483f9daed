"""Registration of queries with their oracle SQL, and the adapters that several bindings share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.session import ensure_runtime

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given parquet tables by name: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = ensure_runtime(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register ``function(tables)`` under its own name, with its oracle."""

    def register(function: Callable[[Tables], DataFrame]):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def money(column: str) -> Column:
    """Two-decimal doubles as exact decimals, so that sums do not depend on the order of addition."""
    return F.col(column).cast("decimal(18,2)")


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def local_times(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# ---------------------------------------------------------------- adapters


def transactions(t: Tables) -> DataFrame:
    """Orders in the shape of user transactions."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(F.col("o_orderstatus") == "F", "Debit").otherwise("Credit").alias("type"),
        money("o_totalprice").alias("amount"),
        F.upper(F.substring("o_orderpriority", 3, 3)).alias("currency"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("login_attempts"),
    )


TRANSACTIONS_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_custkey AS user_id, o_orderdate AS "timestamp",
           CASE WHEN o_orderstatus = 'F' THEN 'Debit' ELSE 'Credit' END AS type,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount, upper(substr(o_orderpriority, 3, 3)) AS currency,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS login_attempts
    FROM orders"""


def report_lines(t: Tables) -> DataFrame:
    """Line items with their parts in the shape of financial report lines."""
    lines = t.lineitem.select("l_partkey", "l_shipdate", "l_returnflag", money("l_extendedprice").alias("value"))
    parts = t.part.select("p_partkey", "p_brand", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("symbol"),
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"),
        F.col("l_returnflag").alias("statement"),
        F.col("p_type").alias("concept"),
        "value",
    )


REPORT_LINES_SQL = """
    SELECT p_brand AS symbol, CAST(year(l_shipdate) AS INT) AS year, CAST(quarter(l_shipdate) AS INT) AS quarter,
           l_returnflag AS statement, p_type AS concept, CAST(l_extendedprice AS DECIMAL(18,2)) AS value
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


def nation_years(t: Tables) -> DataFrame:
    """Yearly order value per nation in the shape of indicators (indicator, year, value)."""
    orders = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), money("o_totalprice").alias("value"))
    customers = t.customer.select("c_custkey", "c_nationkey")
    sums = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "year")
        .agg(F.sum("value").cast("double").alias("value"))
    )
    nations = t.nation.select("n_nationkey", F.col("n_name").alias("indicator"))
    return sums.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("indicator", "year", "value")


NATION_YEARS_SQL = """
    SELECT n_name AS indicator, CAST(year(o_orderdate) AS INT) AS year,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL"""
