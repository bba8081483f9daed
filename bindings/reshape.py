"""Nested and wide shapes, built from the tables and taken apart again."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import NATION_YEARS_SQL, REPORT_LINES_SQL, doubles, local_times, money, nation_years, query, report_lines
from zonelake.functions import maps
from zonelake.operators import reshape
from zonelake.sources.schemas import parse_ddl
from zonelake.streaming import feeds

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("""
    SELECT l_orderkey, l_linenumber, measure, value FROM lineitem
    UNPIVOT INCLUDE NULLS (value FOR measure IN (l_quantity, l_extendedprice, l_discount, l_tax))""")
def wide_to_long(t):
    return reshape.columns_to_rows(t.lineitem, MEASURES, "measure", "value", keep=["l_orderkey", "l_linenumber"])


@query(f"""
    SELECT y.year, n.n_name AS indicator, v.value
    FROM nation n CROSS JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders) y
    LEFT JOIN ({NATION_YEARS_SQL}) v ON v.indicator = n.n_name AND v.year = y.year
    WHERE n.n_name IN (SELECT indicator FROM ({NATION_YEARS_SQL}))""")
def indicator_years_long(t):
    wide = nation_years(t).groupBy("indicator").pivot("year").agg(F.first("value"))
    return reshape.wide_years_to_long(wide, F.col("indicator"))


@query(NATION_YEARS_SQL)
def indicator_documents_long(t):
    """One JSON document per nation with a key per year that it has."""
    pairs = F.collect_list(F.struct(F.col("year").cast("string"), "value"))
    documents = nation_years(t).groupBy("indicator").agg(F.to_json(F.map_from_entries(pairs)).alias("value"))
    return reshape.year_documents_to_long(documents, F.col("indicator")).select("indicator", "year", "value")


@query("""
    SELECT key, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem
    UNPIVOT (value FOR key IN (l_quantity, l_extendedprice, l_discount, l_tax)) GROUP BY 1""")
def struct_fields_long(t):
    nested = t.lineitem.select(F.struct(F.struct(*MEASURES).alias("measures")).alias("line"))
    entries = nested.select(maps.struct_as_map(nested, "line.measures").alias("m"))
    long = maps.map_to_rows(entries, "m", "key", "value")
    return doubles(long.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total")), "total")


@query("""
    SELECT l_returnflag, key, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem
    UNPIVOT (value FOR key IN (l_quantity, l_tax)) GROUP BY ALL""")
def column_map_long(t):
    entries = t.lineitem.select("l_returnflag", maps.columns_as_map(["l_quantity", "l_tax"]).alias("m"))
    long = maps.map_to_rows(entries, "m", "key", "value").select("l_returnflag", "key", "value")
    return doubles(long.groupBy("l_returnflag", "key").agg(F.sum(money("value")).alias("total")), "total")


def rate_documents(t):
    """One nested document per order priority: series per market segment, observations per month.

    The totals are aggregated first, so a document has at most segments x months values.
    """
    customers = t.customer.select("c_custkey", "c_mktsegment")
    paid = t.orders.select(
        "o_custkey", F.col("o_orderpriority").alias("doc"), F.date_format("o_orderdate", "yyyy-MM-01").alias("time"),
        money("o_totalprice").alias("amount"),
    )
    totals = (
        paid.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("doc", "c_mktsegment", "time")
        .agg(F.sum("amount").cast("double").alias("rate"))
    )
    axis = t.orders.select(F.array_sort(F.collect_set(F.date_format("o_orderdate", "yyyy-MM-01")))).scalar()
    segments = t.customer.select(F.array_sort(F.collect_set("c_mktsegment"))).scalar()
    placed = totals.select(
        "doc",
        F.concat(F.lit("0:"), F.array_position(segments, F.col("c_mktsegment")) - 1, F.lit(":0:0:0")).alias("series_key"),
        (F.array_position(axis, F.col("time")) - 1).cast("string").alias("at"),
        F.array("rate").alias("values"),
    )
    series = placed.groupBy("doc", "series_key").agg(
        F.map_from_entries(F.collect_list(F.struct("at", "values"))).alias("observations")
    )
    named = lambda values: F.array(F.struct(F.transform(values, lambda v: F.struct(v.alias("id"))).alias("values")))
    return series.groupBy("doc").agg(
        F.array(F.struct(F.map_from_entries(F.collect_list(F.struct("series_key", F.struct("observations")))).alias("series"))).alias("dataSets")
    ).select(
        "doc", "dataSets", axis.alias("axis"), segments.alias("segments")
    ).select(
        "doc",
        "dataSets",
        F.struct(
            F.struct(
                F.concat(named(F.array(F.lit("D"))), named(F.col("segments"))).alias("series"),
                named(F.col("axis")).alias("observation"),
            ).alias("dimensions")
        ).alias("structure"),
    )


@query("""
    SELECT o_orderpriority AS doc, date_trunc('month', o_orderdate)::TIMESTAMP AS time, c_mktsegment AS currency,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS rate
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def nested_series_long(t):
    return local_times(reshape.rates_to_long(rate_documents(t), keep=["doc"]), "time")


def filings(t):
    """One filing per brand and quarter with line arrays per return flag; at most one line per part type."""
    lines = report_lines(t).groupBy("symbol", "year", "quarter", "statement", "concept").agg(
        F.sum("value").cast("double").alias("value")
    )
    line = F.struct("concept", F.lower("concept").alias("label"), F.lit("usd").alias("unit"), "value")
    pick = lambda flag: F.collect_list(F.when(F.col("statement") == flag, line))
    return lines.groupBy("symbol", "year", "quarter").agg(
        F.struct(pick("A").alias("bs"), pick("N").alias("cf"), pick("R").alias("ic")).alias("report")
    )


@query(f"""
    WITH lines AS (SELECT symbol, year, quarter, CASE statement WHEN 'A' THEN 'bs' WHEN 'N' THEN 'cf' ELSE 'ic' END AS statement,
                          concept, CAST(SUM(value) AS DOUBLE) AS value FROM ({REPORT_LINES_SQL}) GROUP BY ALL),
         parts AS (SELECT DISTINCT l.symbol, l.year, l.quarter, s.statement
                   FROM lines l CROSS JOIN (VALUES ('bs'), ('cf'), ('ic')) s(statement))
    SELECT p.symbol, p.year, p.quarter, p.statement, l.concept, lower(l.concept) AS label,
           CASE WHEN l.concept IS NOT NULL THEN 'usd' END AS unit, l.value
    FROM parts p LEFT JOIN lines l USING (symbol, year, quarter, statement)""")
def statements_long(t):
    return reshape.statements_to_long(filings(t))


@query("""
    SELECT CASE WHEN lang = 'en' THEN make_timestamp(2024, 1, 1 + CAST(doc_id % 28 AS INT), 8, 0, 0.0) END AS ts,
           CASE WHEN lang = 'en' THEN '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || 'T10:00:00+02:00'
                ELSE 'undated' END AS date,
           source AS title, 'https://' || source || '/' || doc_id AS link, text AS content,
           CAST(toxic AS DOUBLE) AS sent_neg, CAST(1 - quality AS DOUBLE) AS sent_neu, CAST(quality AS DOUBLE) AS sent_pos,
           CAST(quality - toxic AS DOUBLE) AS sent_polarity, source || ',' || lang AS symbols, lang AS tags
    FROM documents LEFT JOIN labels USING (doc_id)""")
def news_flatten(t):
    score = lambda c: c.cast("double")
    quality, toxic = F.col("quality"), F.col("toxic")
    articles = t.documents.join(t.labels, "doc_id", "left").select(
        F.when(
            F.col("lang") == "en",
            F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00+02:00")),
        ).otherwise("undated").alias("date"),
        F.col("source").alias("title"),
        F.concat(F.lit("https://"), "source", F.lit("/"), "doc_id").alias("link"),
        F.col("text").alias("content"),
        F.struct(
            score(toxic).alias("neg"), score(1 - quality).alias("neu"), score(quality).alias("pos"),
            score(quality - toxic).alias("polarity"),
        ).alias("sentiment"),
        F.array("source", "lang").alias("symbols"),
        F.array("lang").alias("tags"),
    )
    flat = reshape.flatten_news(articles)
    return local_times(flat, "ts").withColumns({c: F.array_join(c, ",") for c in ("symbols", "tags")})


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events ORDER BY ts DESC NULLS LAST")
def newest_events(t):
    """Presentation order: newest first, undated last."""
    return reshape.newest_first(t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts")))


@query("""
    SELECT word, COUNT(*) AS n, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_retailprice FROM part) GROUP BY 1""")
def array_messages(t):
    elements = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("word"), F.col("p_retailprice").alias("price")))
    messages = feeds.as_messages(t.part.select(elements.alias("data")))
    parsed = feeds.parse_messages(messages, parse_ddl("data ARRAY<STRUCT<word: STRING, price: DOUBLE>>"))
    rows = reshape.array_messages_to_rows(parsed)
    return doubles(rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(money("price")).alias("total")), "total")
