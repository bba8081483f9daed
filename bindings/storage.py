"""Landing, writing, discovery, ledger and migration, each run on whole tables in the scratch folder."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from bindings.registry import doubles, money, query
from zonelake.operators import quality
from zonelake.plans import extracts
from zonelake.plans import migrate as migration
from zonelake.plans.ingest import Extract
from zonelake.session import scratch_path
from zonelake.sources import catalog, readers, sinks
from zonelake.sources.published import Published

FIRST = datetime.datetime(2024, 1, 1)
SECOND = datetime.datetime(2024, 1, 2)


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
           CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side FROM supplier""")
def csv_landing(t):
    """CSV with a header: every column comes back as text."""
    path = scratch_path(t.spark, "csv")
    side = F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit").alias("side")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey", side).write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path)


@query("""
    SELECT conv_id, CAST(COUNT(*) AS INT) AS turns, CAST(SUM(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1""")
def json_documents(t):
    """One JSON document per turn, read back with a schema."""
    path = scratch_path(t.spark, "json")
    sinks.append_json(t.conversations, path)
    turns = readers.read_landed_payloads(t.spark, path, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).cast("int").alias("turns"), F.sum(F.length("text")).alias("chars")
    )


@query("""
    SELECT c_custkey, c_name, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer WHERE c_acctbal >= 0""")
def schema_evolution(t):
    """Two appends with different columns, read as one table."""
    path = scratch_path(t.spark, "evolving")
    sinks.write_table(t.customer.filter("c_acctbal < 0").select("c_custkey", "c_name"), path)
    sinks.write_table(t.customer.filter("c_acctbal >= 0").select("c_custkey", "c_mktsegment"), path, sort_by=["c_custkey"])
    return readers.read_table(t.spark, path)


@query("""
    SELECT o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus = 'F'""")
def partitioned_table(t):
    """Write partitioned by status; the filter on read prunes to one partition."""
    path = sinks.write_table(
        t.orders.select("o_orderkey", "o_orderstatus"), base=scratch_path(t.spark, "zones"), zone="Trusted",
        datasource="ops", dataset="orders", partition_by=["o_orderstatus"],
    )
    return readers.read_table(t.spark, path).filter("o_orderstatus = 'F'")


@query("""
    SELECT * FROM (VALUES ('ops/customers/snapshot_ts=20240101T000000'), ('ops/orders/snapshot_ts=20240101T000000'),
                          ('ops/orders/snapshot_ts=20240102T000000')) v("table")""")
def discovered_tables(t):
    """Tables found by their files, partition folders left out."""
    base = scratch_path(t.spark, "landing")
    place = lambda name, when: catalog.table_path(base, "Landing", "ops", name, when)
    t.customer.write.partitionBy("c_mktsegment").parquet(place("customers", FIRST))
    t.orders.filter("o_orderstatus <> 'O'").write.parquet(place("orders", FIRST))
    t.orders.filter("o_orderstatus = 'O'").write.parquet(place("orders", SECOND))
    return catalog.discover_tables(t.spark, f"{base}/Landing").select("table")


@query("""
    SELECT n_name AS "table", n_nationkey >= 5 AND n_nationkey < 15 AS exported, n_nationkey >= 20 AS quarantine FROM nation""")
def ledger_flags(t):
    """Latest flags from a ledger in which early entries are overruled by later ones."""
    nation = t.nation
    entry = lambda test, name, value, hour: nation.filter(test).select(
        F.col("n_name").alias("table"), F.lit(name).alias("property"), F.lit(value).alias("value"),
        F.make_timestamp(*[F.lit(x) for x in (2024, 1, 1, hour, 0, 0)]).alias("updated_at"),
    )
    ledger = (
        entry("n_nationkey < 15", "exported", "TRUE", 1)
        .unionByName(entry("n_nationkey < 5", "exported", "false", 2))
        .unionByName(entry("n_nationkey >= 15", "exported", "false", 1))
        .unionByName(entry("n_nationkey >= 20", "quarantine", "true", 1))
    )
    return catalog.latest_flags(ledger)


@query("""
    SELECT name AS "table", status, CASE status WHEN 'registered' THEN n END AS n FROM (
        SELECT 'ops_customer' AS name, 'registered' AS status, (SELECT COUNT(*) FROM customer) AS n
        UNION ALL SELECT 'ops_supplier', 'registered', (SELECT COUNT(*) FROM supplier)
        UNION ALL SELECT 'ops_missing', 'skipped', 0)""")
def exported_tables(t):
    """Export to flat folders and register them; a missing folder is reported."""
    target = scratch_path(t.spark, "export")
    names = list(sinks.export_tables({("ops", "customer"): t.customer, ("ops", "supplier"): t.supplier}, target))
    status = sinks.register_exports(t.spark, target, [*names, "ops_missing"])
    counts = [
        t.spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name in names
    ]
    return status.join(counts[0].unionByName(counts[1]), "table", "left").select(
        "table", F.split_part("status", F.lit(":"), F.lit(1)).alias("status"), "n"
    )


# Order lines as operational transactions in three daily snapshots.  The second has a currency that fails the suite.
SNAPSHOT_OF = """CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1 WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END"""
TX_SUITE = quality.Suite(
    "tx",
    (
        *quality.required("transaction_id", quality.unique("transaction_id")),
        *quality.required("amount", quality.Between("amount", 0, 1e6)),
        *quality.required("currency", quality.Matches("currency", quality.CURRENCY)),
    ),
)
TX = migration.Dataset("ops_db", "tx", ("transaction_id",), TX_SUITE)


def _migrated(t):
    """Land three snapshots and migrate them; the third repeats the urgent orders of the first and of the second."""
    base = scratch_path(t.spark, "migrate")
    tx = t.orders.select(
        F.col("o_orderkey").alias("transaction_id"), money("o_totalprice").alias("amount"), "o_orderpriority",
        F.expr(SNAPSHOT_OF).alias("day"),
    )
    currency = F.when(F.col("day") == 2, "euro").otherwise("EUR").alias("currency")
    for day in (1, 2, 3):
        repeated = (F.col("day") == day) | ((F.lit(day) == 3) & (F.col("o_orderpriority") == "1-URGENT"))
        landed = tx.filter(repeated).select("transaction_id", "amount", currency if day == 2 else F.lit("EUR").alias("currency"))
        landed.write.parquet(f"{TX.landing_root(base)}/{catalog.SNAPSHOT}=2024010{day}T000000")
    trusted = migration.migrate(t.spark, base, TX)
    return base, trusted


@query(f"""
    SELECT o_orderkey AS transaction_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, 'EUR' AS currency
    FROM orders WHERE {SNAPSHOT_OF} <> 2 OR o_orderpriority = '1-URGENT'""")
def migrated_table(t):
    return doubles(_migrated(t)[1], "amount")


@query(f"""
    WITH s AS (SELECT {SNAPSHOT_OF} AS day, o_orderpriority = '1-URGENT' AS urgent FROM orders)
    SELECT day AS snapshot, day <> 2 AS success, day = 2 AS quarantine,
           (SELECT COUNT(*) FROM s WHERE s.day = d.day OR (d.day = 3 AND urgent)) AS cnt_orig,
           (SELECT COUNT(*) FROM s WHERE s.day = d.day OR (d.day = 3 AND s.day = 2 AND urgent)) AS cnt_dedup
    FROM (VALUES (1), (2), (3)) d(day)""")
def migration_audit(t):
    base, _ = _migrated(t)
    audit = migration.read_audit(t.spark, base, TX)
    day = F.regexp_extract("landing_table", "2024010([0-9])T", 1).cast("int")
    return audit.select(day.alias("snapshot"), "success", "quarantine", "cnt_orig", "cnt_dedup")


# Orders as an operational table: finished ones are exported, open ones are pending, all others have no status.
ORDERS = Extract("orders", "orders", "o_orderkey", "o_orderkey BIGINT, o_custkey BIGINT, amount DOUBLE")


def _landed(t):
    """Two batches.  When the second one runs, the source has the marks of the first one's urgent orders only."""
    status = F.when(F.col("o_orderstatus") == "F", "exported").when(F.col("o_orderstatus") == "O", "pending")
    early = F.col("o_orderdate") < F.lit(datetime.datetime(1997, 1, 1)).cast("timestamp_ntz")
    source = t.orders.select(
        "o_orderkey", "o_custkey", money("o_totalprice").cast("double").alias("amount"), status.alias("status"),
        early.alias("early"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    landing = extracts.Landing(t.spark, scratch_path(t.spark, "extract"), ORDERS, buckets=8)
    landing.run(source.filter("early"), "b1")
    marked = source.withColumn("status", F.when(F.col("early") & F.col("urgent") & (F.col("status") == "pending"), "exported").otherwise(F.col("status")))
    for _ in range(2):
        landing.run(marked, "b2")
    return landing, marked


@query("""
    SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'b1' ELSE 'b2' END AS batch
    FROM orders WHERE o_orderstatus = 'O'""")
def extract_landed(t):
    """Every pending row lands once, though the source has missed marks and the second batch is repeated."""
    return _landed(t)[0].read()


@query("""
    SELECT o_orderkey FROM orders
    WHERE o_orderstatus = 'O' AND NOT (o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority = '1-URGENT')""")
def extract_marks(t):
    """Landed rows that the source still has to mark."""
    landing, source = _landed(t)
    return landing.to_mark(source)


def _published(t):
    """Three tables in two steps, the orders anew in the second, beside a folder that nobody has named."""
    lake = Published(t.spark, scratch_path(t.spark, "published"))
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    lake.publish({"ops/customer": t.customer, "ops/orders": orders.filter("o_orderstatus = 'F'")})
    lake.publish({"ops/orders": orders, "ops/supplier": t.supplier}, {"ops/orders": ["o_orderstatus"]})
    t.part.write.parquet(f"{lake.root}/ops/part/staged")
    return lake


@query("""
    SELECT 'ops/customer' AS "table", CAST(0 AS BIGINT) AS version, COUNT(*) AS n FROM customer
    UNION ALL SELECT 'ops/orders', 1, COUNT(*) FROM orders UNION ALL SELECT 'ops/supplier', 1, COUNT(*) FROM supplier""")
def published_tables(t):
    """Tables that the manifest names, with their versions and rows; no file is listed to find them."""
    lake = _published(t)
    return lake.tables().select("table", "version").join(lake.counts(), "table")


@query("""
    SELECT o_orderstatus, COUNT(*) AS orders, (SELECT COUNT(*) FROM customer) AS customers FROM orders GROUP BY 1""")
def export_sweep(t):
    """Every published table exported, registered as a view and used from there."""
    lake = _published(t)
    lake.export_all(scratch_path(t.spark, "sweep")).register()
    # By name, as a user of the export does; the views are read into the plan here, so later ones change nothing.
    return t.spark.sql("""
        SELECT o_orderstatus, COUNT(*) AS orders, (SELECT COUNT(*) FROM ops_customer) AS customers
        FROM ops_orders GROUP BY o_orderstatus""")
