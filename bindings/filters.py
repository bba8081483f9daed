"""Row filters, lookups and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import NATION_YEARS_SQL, REPORT_LINES_SQL, doubles, nation_years, query, report_lines
from zonelake.functions.scalars import quarter_start, url_container, url_key
from zonelake.operators import filters
from zonelake.plans import analysis


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT MAX(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1999-12-31')""")
def hwm_filter(t):
    loaded = t.orders.filter(F.col("o_orderdate") <= F.lit("1999-12-31").cast("timestamp_ntz"))
    return filters.newer_than(t.orders.select("o_orderkey", "o_orderdate"), loaded, "o_orderdate")


@query(f"SELECT indicator, year, value FROM ({NATION_YEARS_SQL}) WHERE year >= (SELECT MAX(year(o_orderdate)) - 3 FROM orders)")
def last_n_years(t):
    return filters.last_years(nation_years(t), "year", 3)


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-15' AND o_orderdate < TIMESTAMP '1998-07-16'""")
def lookback_6m(t):
    return filters.months_back(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate", "1998-07-15", 6)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 10")
def first_entries(t):
    return filters.first_entries(t.part.select("p_partkey", "p_name"), ["p_name", "p_partkey"], 10)


@query("""
    SELECT n_nationkey, r_name, CAST(len(list(c_custkey)) AS INT) AS n FROM nation JOIN region ON n_regionkey = r_regionkey
    JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING' GROUP BY ALL""")
def nested_lookup(t):
    """Per nation a map segment -> (region -> number of customers); pick one path, skip what is empty."""
    counts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    counted = F.array(F.col("n").cast("int"))
    documents = placed.groupBy("n_nationkey", "r_name").agg(
        F.map_from_entries(F.collect_list(F.struct("c_mktsegment", F.create_map("r_name", counted)))).alias("values")
    )
    found = filters.nested_series(documents, "values", F.lit("BUILDING"), F.col("r_name"))
    return found.select("n_nationkey", "r_name", F.get("series", 0).alias("n"))


@query("""
    SELECT c_custkey, quality FROM customer LEFT JOIN labels ON doc_id = c_custkey
    WHERE quality IS NOT NULL AND nullif(c_mktsegment, 'BUILDING') IS NOT NULL""")
def drop_incomplete(t):
    joined = t.customer.join(t.labels, F.col("doc_id") == F.col("c_custkey"), "left").select(
        "c_custkey", "quality", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return filters.drop_incomplete(joined).select("c_custkey", "quality")


@query("""
    SELECT o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.095::DOUBLE) AS listed, COUNT(*) AS n
    FROM orders GROUP BY 1""")
def membership_split(t):
    listed = t.lineitem.filter("l_discount > 0.095D").select("l_orderkey")
    flagged = filters.flag_membership(t.orders.select("o_orderkey"), listed, "o_orderkey")
    return flagged.groupBy("listed").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT page_id, regexp_extract(url, '^[^:/]+://([^/]+)/', 1) AS container,
           nullif(regexp_extract(url, '^[^:/]+://[^/]+/(.+)$', 1), '') AS key FROM pages""")
def url_parts(t):
    return t.pages.select("page_id", url_container("url").alias("container"), url_key("url").alias("key"))


@query(f"""
    SELECT symbol, CAST(make_date(year, quarter * 3 - 2, 1) AS DATE) AS date, CAST(value AS DOUBLE) AS value
    FROM (SELECT symbol, year, quarter, SUM(value) AS value FROM ({REPORT_LINES_SQL})
          WHERE lower(concept) = 'economy' AND symbol IN ('Brand#1', 'Brand#2', 'Brand#3') AND statement = 'A' GROUP BY ALL)""")
def asset_series(t):
    lines = report_lines(t).withColumnRenamed("concept", "label")
    report = lines.groupBy("symbol", "year", "quarter", "statement", "label").agg(F.sum("value").alias("value"))
    series = analysis.asset_series(report, ["Brand#1", "Brand#2", "Brand#3"], label="Economy", statement="A")
    return doubles(analysis.in_order(series, "symbol", "date"), "value")


@query(f"""
    SELECT indicator, year, value FROM ({NATION_YEARS_SQL}) WHERE indicator IN ('NATION_1', 'NATION_7')
    AND year >= (SELECT MAX(year(o_orderdate)) - 4 FROM orders)""")
def indicator_series(t):
    series = analysis.indicator_series(nation_years(t), ["NATION_1", "NATION_7"], years=4)
    return analysis.in_order(series, "indicator", "year")


@query("""
    SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS year, CAST(quarter(l_shipdate) AS INT) AS quarter,
           CAST(date_trunc('quarter', l_shipdate) AS DATE) AS start FROM lineitem""")
def quarter_starts(t):
    quarters = t.lineitem.select(F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter")).distinct()
    return quarters.withColumn("start", quarter_start("year", "quarter"))
