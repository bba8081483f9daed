"""KPI tables of the data marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from bindings.registry import (
    NATION_YEARS_SQL, REPORT_LINES_SQL, TRANSACTIONS_SQL, doubles, money, nation_years, query, report_lines, transactions,
)
from zonelake.plans import marts


@query(f"""
    SELECT user_id, strftime("timestamp", '%Y-%m') AS month, CAST(SUM(amount) AS DOUBLE) AS total_amount,
           COUNT(*) AS tx_count, AVG(login_attempts) AS avg_login_attempts
    FROM ({TRANSACTIONS_SQL}) GROUP BY ALL""")
def kpi_monthly_tx(t):
    return doubles(marts.monthly_transactions(transactions(t)), "total_amount")


@query("SELECT o_orderstatus AS status, COUNT(*) AS cnt FROM orders GROUP BY 1")
def kpi_status_counts(t):
    return marts.status_counts(t.orders.select(F.col("o_orderstatus").alias("status")))


@query(f"SELECT currency, CAST(SUM(amount) AS DOUBLE) AS total_amount FROM ({TRANSACTIONS_SQL}) GROUP BY 1")
def kpi_volume_by_currency(t):
    return doubles(marts.volume_by_currency(transactions(t)), "total_amount")


@query("""
    SELECT c_mktsegment AS currency, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def kpi_volume_by_segment(t):
    customers = t.customer.select("c_custkey", F.col("c_mktsegment").alias("currency"))
    paid = t.orders.select("o_custkey", money("o_totalprice").alias("amount"))
    joined = paid.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return doubles(marts.volume_by_currency(joined), "total_amount")


@query(f"""
    SELECT symbol, year, quarter, statement, CAST(SUM(value) AS DOUBLE) AS total_value
    FROM ({REPORT_LINES_SQL}) GROUP BY ALL""")
def kpi_totals_4key(t):
    return doubles(marts.financial_totals(report_lines(t)), "total_value")


@query(f"""
    SELECT indicator, year, value - lag(value) OVER (PARTITION BY indicator ORDER BY year) AS yoy_change
    FROM ({NATION_YEARS_SQL})""")
def kpi_yoy_change(t):
    return marts.indicator_growth(nation_years(t))


@query(f"""
    SELECT 'risk_mgmt' AS mart, 'kpi_monthly_tx' AS kpi, COUNT(*) AS "rows"
    FROM (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') FROM orders)
    UNION ALL SELECT 'risk_mgmt', 'kpi_kyc_status', COUNT(DISTINCT o_orderstatus) FROM orders
    UNION ALL SELECT 'finance_reporting', 'kpi_tx_volume_currency', COUNT(DISTINCT o_orderpriority) FROM orders
    UNION ALL SELECT 'finance_reporting', 'kpi_financial_totals', COUNT(*)
    FROM (SELECT DISTINCT symbol, year, quarter, statement FROM ({REPORT_LINES_SQL}))
    UNION ALL SELECT 'market_intel', 'kpi_imf_growth', COUNT(*) FROM ({NATION_YEARS_SQL})""")
def mart_rows(t):
    tables = {
        "ops_db_user_transactions": transactions(t),
        "ops_db_kyc_metadata": t.orders.select(F.col("o_orderstatus").alias("status")),
        "imf_indicators": nation_years(t),
        "finnhub_financial_report": report_lines(t),
    }
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(mart.name).alias("mart"), F.lit(kpi).alias("kpi"), "rows")
        for mart in marts.MARTS
        for kpi, frame in marts.mart_tables(mart, tables)[0].items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)
