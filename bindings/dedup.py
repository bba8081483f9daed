"""Duplicates in a batch and against history."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import money, query
from zonelake.operators import dedup
from zonelake.plans import ingest
from zonelake.session import scratch_path
from zonelake.sources.unique import UniqueTable

EVENT_COLUMNS = ["user_id", "event_type", "event_id", "ts", "value"]


def _ranked(direction: str) -> str:
    return f"""
    SELECT user_id, event_type, event_id, ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts {direction}, event_id {direction}) AS rn
        FROM events) WHERE rn = 1"""


@query(_ranked("ASC"))
def dedup_first(t):
    return dedup.keep_one(t.events.select(EVENT_COLUMNS), ["user_id", "event_type"], ["ts", "event_id"], "first")


@query(_ranked("DESC"))
def dedup_last(t):
    return dedup.keep_one(t.events.select(EVENT_COLUMNS), ["user_id", "event_type"], ["ts", "event_id"], "last")


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedup_any(t):
    return dedup.keep_one(t.events.select("user_id", "event_type"), ["user_id", "event_type"])


def _batch_and_history(t):
    """Orders with a NULL in the key where the status is P; the orders before 1998 are history."""
    keyed = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P"))).select(
        "o_custkey", "status", "o_orderkey", "o_orderdate"
    )
    is_old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return keyed.filter(~is_old), keyed.filter(is_old)


def _history_sql(match: str) -> str:
    return f"""
    WITH keyed AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, o_orderkey, o_orderdate FROM orders),
         once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, status ORDER BY o_orderdate, o_orderkey) AS rn
                                 FROM keyed WHERE o_orderdate >= TIMESTAMP '1998-01-01') WHERE rn = 1)
    SELECT o_custkey, status, o_orderkey, o_orderdate FROM once b WHERE NOT EXISTS (
        SELECT 1 FROM keyed h WHERE h.o_orderdate < TIMESTAMP '1998-01-01' AND h.o_custkey = b.o_custkey AND h.status {match} b.status)"""


@query(_history_sql("IS NOT DISTINCT FROM"))
def null_safe_dedup(t):
    batch, history = _batch_and_history(t)
    return dedup.deduplicate(batch, ["o_custkey", "status"], history, ["o_orderdate", "o_orderkey"])


@query(_history_sql("="))
def plain_null_dedup(t):
    batch, history = _batch_and_history(t)
    return dedup.deduplicate(batch, ["o_custkey", "status"], history, ["o_orderdate", "o_orderkey"], null_safe=False)


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def dedup_vs_history(t):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    batch = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return dedup.exclude_existing(batch, returned, ["o_orderkey"], range_column="o_orderkey")


@query("""
    SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment FROM customer b
    WHERE NOT EXISTS (SELECT 1 FROM customer t WHERE t.c_acctbal >= 5000 AND t.c_custkey = b.c_custkey)""")
def insert_if_absent(t):
    target = t.customer.filter("c_acctbal >= 5000").select("c_custkey", "c_name", "c_mktsegment")
    batch = t.customer.select("c_custkey", F.upper("c_name").alias("c_name"), "c_mktsegment")
    return dedup.rows_to_insert(batch, target, ["c_custkey"], order_by=["c_name"])


@query("""
    SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders
    WHERE o_orderstatus = 'O' AND NOT EXISTS (
        SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F' AND l_quantity > 40)""")
def pending_extract(t):
    status = F.when(F.col("o_orderstatus") == "F", "exported").when(F.col("o_orderstatus") == "O", "pending")
    source = t.orders.select(
        "o_orderkey", "o_custkey", money("o_totalprice").cast("double").alias("amount"), status.alias("status")
    )
    exported = t.lineitem.filter("l_linestatus = 'F' AND l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return ingest.pending_rows(source, ["o_orderkey", "o_custkey", "amount"], "o_orderkey", exported)


@query("""
    SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS "exists"
    FROM customer""")
def exists_flag(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return dedup.with_exists_flag(t.customer.select("c_custkey"), urgent, ["c_custkey"])


@query("""
    SELECT o_custkey, status, o_orderkey FROM (
        SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, o_orderkey, row_number() OVER (
            PARTITION BY o_custkey, nullif(o_orderstatus, 'P')
            ORDER BY o_orderdate >= TIMESTAMP '1998-01-01', o_orderdate, o_orderkey) AS rn
        FROM orders) WHERE rn = 1""")
def dedup_bucketed_history(t):
    """Two batches into a table with unique keys: the history is joined in its buckets, without a shuffle."""
    batch, history = _batch_and_history(t)
    table = UniqueTable(t.spark, scratch_path(t.spark, "unique"), ["o_custkey", "status"], buckets=8)
    for name, rows in (("history", history), ("batch", batch), ("batch", batch)):
        table.insert(rows, name, order_by=["o_orderdate", "o_orderkey"])
    return table.read().select("o_custkey", "status", "o_orderkey")
