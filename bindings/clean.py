"""Cleaning steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query
from zonelake.functions import cleaning, maps
from zonelake.functions.scalars import number_or_zero, parse_time, three_way

NON_WORD = r"[^a-zA-Z0-9_\s]"


@query(f"""
    SELECT doc_id, trim(lower(regexp_replace(text, '{NON_WORD}', '', 'g')), ' ') AS text FROM documents
    WHERE length(trim(lower(regexp_replace(text, '{NON_WORD}', '', 'g')), ' ')) >= 30""")
def clean_text(t):
    clean = cleaning.normalise_text(t.documents.select("doc_id", "text"), ["text"])
    trimmed = cleaning.computed_once(cleaning.trim_text(clean, ["text"]), ["text"])
    return cleaning.min_length(trimmed, "text", 30)


@query("""
    SELECT c_custkey, c_name AS profile_name, c_acctbal AS profile_balance, c_mktsegment AS profile_segment FROM customer""")
def flatten_one_level(t):
    profile = F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return cleaning.flatten_one_level(t.customer.select("c_custkey", profile.alias("profile")))


@query("""
    SELECT p_partkey AS "id", p_brand AS "part.brand.name", p_size AS "part.size", p_retailprice AS "part.price" FROM part""")
def flatten_deep(t):
    nested = F.struct(
        F.struct(F.col("p_brand").alias("name")).alias("brand"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")
    )
    return cleaning.flatten(t.part.select(F.col("p_partkey").alias("id"), nested.alias("part")))


@query("SELECT s_suppkey, s_name FROM supplier")
def unwrapped(t):
    record = F.struct(F.struct("s_suppkey", "s_name").alias("result"))
    return cleaning.unwrap(t.supplier.select(record.alias("data")))


@query("""
    SELECT o_orderkey, COALESCE(nullif(o_orderstatus, 'P'), 'unknown') AS status,
           COALESCE(CASE WHEN o_totalprice > 100000 THEN o_totalprice END, 0) AS price FROM orders""")
def fill_defaults(t):
    gaps = t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
    )
    return cleaning.fill_defaults(gaps, {"status": "unknown", "price": 0.0})


@query("""
    SELECT doc_id, nullif(replace(lang, 'en', ''), '') AS lang, CASE WHEN lang <> 'fr' THEN lang END AS tag FROM documents""")
def empty_to_null(t):
    texts = t.documents.select(
        "doc_id", F.replace("lang", F.lit("en"), F.lit("")).alias("lang"),
        F.filter(F.array("lang"), lambda x: x != "fr").alias("tags"),
    )
    return cleaning.null_empty(texts).select("doc_id", "lang", F.get("tags", F.lit(0)).alias("tag"))


@query("""
    SELECT event_id, try_cast(replace(k, '7', 'x') AS INT) AS k FROM (
        SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)""")
def typed_columns(t):
    raw = t.events.select("event_id", F.replace(F.get_json_object("props", "$.k"), F.lit("7"), F.lit("x")).alias("k"))
    return cleaning.enforce_types(raw, {"k": "int"})


@query("""
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'unknown' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_time,
           event_type FROM events""")
def normalised_times(t):
    text = F.when(F.col("event_type") == "view", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return cleaning.normalise_times(t.events.select("event_id", text.alias("event_time"), "event_type"))


@query("SELECT event_id, ts AS parsed FROM events WHERE event_type <> 'view'")
def valid_times(t):
    text = F.when(F.col("event_type") == "view", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    valid = cleaning.valid_time(t.events.select("event_id", text.alias("parsed")), "parsed")
    return valid.withColumn("parsed", F.col("parsed").cast("timestamp_ntz"))


@query("SELECT c_custkey, c_acctbal, p_size FROM customer JOIN part ON p_partkey = c_custkey WHERE p_size < 120 AND c_acctbal >= 0")
def plausible_numbers(t):
    joined = t.customer.join(t.part, F.col("p_partkey") == F.col("c_custkey")).select("c_custkey", "c_acctbal", "p_size")
    return cleaning.non_negative(cleaning.valid_age(joined, "p_size"), "c_acctbal")


@query("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)")
def required_columns(t):
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return cleaning.require(joined, ["quality"])


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    pairs = t.lineitem.select("l_returnflag", "l_linestatus")
    return cleaning.drop_duplicate_rows(pairs, ["l_returnflag", "l_linestatus"])


@query("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status, n_name AS nation
    FROM orders LEFT JOIN nation ON n_nationkey = o_custkey""")
def dictionary_lookup(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("int").alias("at"))
    named = cleaning.lookup(orders, "o_orderstatus", {"F": "finished", "O": "open"}, "status")
    return cleaning.lookup(named, "at", t.nation.select("n_nationkey", "n_name"), "nation").select("o_orderkey", "status", "nation")


@query("""
    SELECT p_partkey, CAST(i - 1 AS INT) AS idx, words[i] AS val FROM (
        SELECT p_partkey, words, unnest(range(1, len(words) + 1)) AS i FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part))""")
def array_positions(t):
    words = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    return maps.array_to_indexed_rows(words, "words").select("p_partkey", "idx", "val")


@query("""
    SELECT p_partkey, w AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_size > 25)
    UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size <= 25""")
def array_outer(t):
    words = t.part.select("p_partkey", F.when(F.col("p_size") > 25, F.split("p_name", " ")).alias("words"))
    return maps.array_to_rows(words, "words", "word").select("p_partkey", "word")


@query("""
    SELECT s_suppkey, round(s_acctbal / 10000, 4) AS score, CASE WHEN s_acctbal / 10000 > 0.2 THEN 'positive'
           WHEN s_acctbal / 10000 < -0.2 THEN 'negative' ELSE 'neutral' END AS label FROM supplier""")
def three_way_labels(t):
    score = F.col("s_acctbal") / 10000
    return t.supplier.select("s_suppkey", F.round(score, 4).alias("score"), three_way(score).alias("label"))


@query("""
    SELECT page_id, COALESCE(try_cast(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT), 0) AS number FROM pages""")
def numbers_or_zero(t):
    return t.pages.select("page_id", number_or_zero(F.regexp_extract("url", "/([0-9]+)", 1), "bigint").alias("number"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate - INTERVAL 2 HOUR END AS ts FROM orders""")
def parsed_times(t):
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    return t.orders.select("o_orderkey", parse_time(text).cast("timestamp_ntz").alias("ts"))
