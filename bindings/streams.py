"""Streams: events as messages of the topics.  Streaming results must equal the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import local_times, money, query
from zonelake.session import scratch_path
from zonelake.streaming import aggregates, feeds, jobs, scoring, sinks, topics, upserts

PROPS = "k INT"
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
# Messages of error events lose their closing brace.
_PROPS_TEXT = "CASE WHEN event_type = 'error' THEN replace(props, '}', '') ELSE props END"


def _props_messages(t):
    return t.events.select("event_type", money("value").alias("amount"), F.expr(_PROPS_TEXT).alias("value"))


@query("""
    SELECT CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INT) END AS k, COUNT(*) AS n,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1""")
def json_props(t):
    parsed = feeds.parse_messages(_props_messages(t), PROPS, keep=["amount"])
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"))


@query("""
    SELECT event_type, replace(props, '}', '') AS value, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL""")
def dead_letters(t):
    dead = feeds.dead_letters(_props_messages(t), PROPS)
    return dead.groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("n"))


WINDOW_SQL = """
    SELECT event_type AS symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
           round(AVG(value), 8) AS avg_price, CAST(SUM(user_id) AS BIGINT) AS total_volume
    FROM events GROUP BY ALL"""


@query(WINDOW_SQL)
def window_agg_5m(t):
    quotes = t.events.select(
        F.col("event_type").alias("symbol"), F.col("ts").alias("timestamp"), F.col("value").alias("current_price"),
        F.col("user_id").alias("volume"),
    )
    return aggregates.window_totals(quotes, "5 minutes").withColumn("avg_price", F.round("avg_price", 8))


def _event_stream(t):
    """The events table as a file stream, one row per event."""
    return feeds.read_files(t.spark, t.folder, EVENTS_SCHEMA, glob="events.parquet")


def _finish(query_handle) -> None:
    query_handle.awaitTermination()


@query(WINDOW_SQL)
def stream_window_agg_5m(t):
    """The same windows, from JSON messages through the streaming job in complete mode."""
    folder = scratch_path(t.spark, "quotes")
    messages = feeds.as_messages(
        _event_stream(t).select(
            F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.col("value").alias("current_price"), F.col("user_id").alias("volume"),
        )
    )
    _finish(jobs.aggregate_quotes(messages, f"{folder}/table", f"{folder}/checkpoint", window="5 minutes", available_now=True))
    totals = sinks.latest_epoch(t.spark, f"{folder}/table").withColumn("avg_price", F.round("avg_price", 8))
    return local_times(totals, "window_start", "window_end")


@query("""
    SELECT event_type AS symbol, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           round(AVG(value), 8) AS avg_price, CAST(SUM(user_id) AS DOUBLE) AS total_volume
    FROM events GROUP BY ALL""")
def stream_trades_hourly(t):
    """The trade feed (epoch milliseconds, short names) through the same job."""
    folder = scratch_path(t.spark, "trades")
    messages = feeds.as_messages(
        _event_stream(t).select(
            F.lit("trade").alias("c"), F.col("value").alias("p"), F.col("event_type").alias("s"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("t"), F.col("user_id").cast("double").alias("v"),
        )
    )
    _finish(jobs.aggregate_quotes(messages, f"{folder}/table", f"{folder}/checkpoint", "crypto_stream", "1 hour", available_now=True))
    totals = sinks.latest_epoch(t.spark, f"{folder}/table").withColumn("avg_price", F.round("avg_price", 8))
    return local_times(totals, "window_start", "window_end")


RULES = [
    scoring.RiskRule("error", "event_type = 'error'", 0.5),
    scoring.RiskRule("large", "value > 100", 0.25),
    scoring.RiskRule("new user", "user_id < 10", 0.25),
]
_SCORE_SQL = """
    (CASE WHEN event_type = 'error' THEN 0.5::DOUBLE ELSE 0 END + CASE WHEN value > 100 THEN 0.25 ELSE 0 END
     + CASE WHEN user_id < 10 THEN 0.25 ELSE 0 END)"""
SCORED_SQL = f"""
    SELECT event_id, CAST({_SCORE_SQL} AS DOUBLE) AS risk_score, {_SCORE_SQL} >= 0.5 AS is_fraud FROM events"""


@query(SCORED_SQL)
def scored_events(t):
    return scoring.score_events(t.events, RULES, 0.5).select("event_id", "risk_score", "is_fraud")


@query(f"""
    SELECT '{{"event_id":' || event_id || ',"event_type":"' || event_type || '","is_fraud":' ||
           CASE WHEN {_SCORE_SQL} >= 0.5 THEN 'true' ELSE 'false' END || '}}' AS value FROM events""")
def scored_json(t):
    scored = scoring.score_events(t.events, RULES, 0.5)
    return feeds.as_messages(scored.select("event_id", "event_type", "is_fraud"))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS request_id, CASE WHEN user_id >= 10 THEN CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN user_id < 10 THEN 0.6::DOUBLE ELSE 0 END + CASE WHEN event_type = 'error' THEN 0.5 ELSE 0 END
           + CASE WHEN event_type = 'click' THEN 0.5 ELSE 0 END AS risk_score,
           (user_id < 10 OR event_type IN ('error', 'click')) AS is_fraud
    FROM events""")
def stream_scored_messages(t):
    """Topic to topic: messages in, scored messages and a table out, by one streaming query."""
    folder = scratch_path(t.spark, "fraud")
    event = F.col("event_type")
    messages = feeds.as_messages(
        _event_stream(t).select(
            F.lit("kyc").alias("event"), F.col("event_id").cast("string").alias("request_id"),
            F.when(F.col("user_id") >= 10, F.col("user_id").cast("string")).alias("user_id"),
            F.when(event != "error", "a.jpg").alias("doc_s3_path"),
            F.when(event == "click", "a.jpg").otherwise("b.jpg").alias("face_s3_path"),
            F.col("ts").cast("string").alias("upload_time"), F.lit("pending").alias("status"),
        )
    )
    outputs = [sinks.message_sink(f"{folder}/topic"), sinks.table_sink(f"{folder}/table")]
    _finish(jobs.score_topic(messages, outputs, f"{folder}/checkpoint", available_now=True))
    answered = feeds.parse_messages(
        t.spark.read.text(f"{folder}/topic"), "request_id STRING, user_id STRING, risk_score DOUBLE, is_fraud BOOLEAN"
    )
    return answered


@query("""
    SELECT event_type AS event, user_id, CASE WHEN event_type = 'purchase' THEN value END AS amount,
           CASE WHEN event_type IN ('click', 'view') THEN json_extract_string(props, '$.k') END AS target, COUNT(*) AS n
    FROM events WHERE event_type IN ('purchase', 'click', 'view') GROUP BY ALL""")
def typed_dispatch(t):
    messages = feeds.as_messages(
        t.events.select(
            F.col("event_type").alias("event"), "user_id", F.col("value").alias("amount"),
            F.get_json_object("props", "$.k").alias("target"),
        )
    )
    schemas = {
        "purchase": "event STRING, user_id BIGINT, amount DOUBLE",
        "click": "event STRING, user_id BIGINT, target STRING",
        "view": "event STRING, user_id BIGINT, target STRING",
    }
    wide = feeds.dispatch_events(messages, schemas)
    return wide.groupBy("event", "user_id", "amount", "target").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT 'unknown type' AS reason, event_type AS event, COUNT(*) AS n FROM events
    WHERE event_type NOT IN ('purchase', 'error') GROUP BY ALL
    UNION ALL SELECT 'malformed or without type', NULL, COUNT(*) FROM events WHERE event_type = 'error' HAVING COUNT(*) > 0""")
def dispatch_rejects(t):
    """Messages that the dispatch by type doesn't return: other types, and those that lost their opening brace."""
    whole = F.to_json(F.struct(F.col("event_type").alias("event"), "user_id"))
    value = F.when(F.col("event_type") == "error", F.substring(whole, 2, 1000)).otherwise(whole)
    rejected = feeds.rejected_events(t.events.select(value.alias("value")), {"purchase": "event STRING, user_id BIGINT"})
    event = F.get_json_object("value", "$.event").alias("event")
    return rejected.groupBy("reason", event).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT 'quotes' AS topic, event_type AS symbol, NULL::VARCHAR AS s, COUNT(*) AS n FROM events WHERE event_type <> 'view' GROUP BY ALL
    UNION ALL SELECT 'trades', NULL, event_type, COUNT(*) FROM events WHERE event_type = 'view' GROUP BY ALL""")
def topic_dispatch(t):
    is_view = F.col("event_type") == "view"
    body = F.to_json(F.struct(F.when(~is_view, F.col("event_type")).alias("symbol"), F.when(is_view, F.col("event_type")).alias("s")))
    topics = t.events.select(F.when(is_view, "trades").otherwise("quotes").alias("topic"), body.alias("value"))
    united = feeds.dispatch_topics(topics, {"quotes": "symbol STRING", "trades": "s STRING"})
    return united.groupBy("topic", "symbol", "s").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT event_type AS symbol, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
           arg_max(event_id, ts) - arg_min(event_id, ts) AS volume_growth
    FROM events GROUP BY ALL""")
def window_growth_daily(t):
    quotes = t.events.select(
        F.col("event_type").alias("symbol"), F.col("ts").alias("timestamp"), F.col("event_id").alias("volume")
    )
    return aggregates.window_growth(quotes, "1 day")


# ---------------------------------------------------------------- topics of landed files


def _event_topic(t, folder: str, partitions: int = 4) -> None:
    """The events as a topic, written by a stream."""
    events = _event_stream(t).select(
        (F.col("user_id") % partitions).cast("int").alias("partition"), F.col("event_type").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"),
    )
    _finish(topics.to_topic_log(events, f"{folder}/topics/events", f"{folder}/write", "events", partitions, available_now=True))


@query("""
    SELECT CAST(user_id % 4 AS INT) AS partition, CAST(0 AS BIGINT) AS first_offset, COUNT(*) - 1 AS last_offset,
           COUNT(*) AS n, COUNT(*) AS offsets, CAST(SUM(event_id) AS BIGINT) AS ids
    FROM events GROUP BY 1""")
def stream_topic_offsets(t):
    """Stream to topic to stream: every partition's offsets run from 0 without a gap, and no message is lost or repeated."""
    folder = scratch_path(t.spark, "topics")
    _event_topic(t, folder)
    stream = topics.stream_topics(t.spark, f"{folder}/topics", ["events"], "earliest")
    for _ in range(2):  # the second query goes on where the first one stopped, and finds nothing
        _finish(sinks.to_table(stream, f"{folder}/table", f"{folder}/read", "append", available_now=True))
    body = feeds.parse_messages(sinks.all_epochs(t.spark, f"{folder}/table"), "event_id BIGINT", keep=["partition", "offset"])
    return body.groupBy("partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("n"),
        F.count_distinct("offset").alias("offsets"), F.sum("event_id").alias("ids"),
    )


@query("""
    SELECT CAST(user_id % 4 AS INT) AS partition, COUNT(*) - 100 * CAST(user_id % 4 AS INT) AS n
    FROM events GROUP BY user_id % 4 HAVING COUNT(*) > 100 * CAST(user_id % 4 AS INT)""")
def topic_positions(t):
    """A batch read from explicit positions: each partition from a hundred times its number on."""
    folder = scratch_path(t.spark, "positions")
    _event_topic(t, folder)
    starts = {"events": {str(p): 100 * p for p in range(4)}}
    return topics.read_topics(t.spark, f"{folder}/topics", ["events"], starts).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


@query(WINDOW_SQL)
def stream_window_upserts(t):
    """The same windows in update mode, from a topic that grows between two runs of the job; the later half of the
    events reaches windows that the first run has written."""
    folder = scratch_path(t.spark, "upserts")
    quotes = t.events.select(
        "ts", F.to_json(F.struct(
            F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.col("value").alias("current_price"), F.col("user_id").alias("volume"),
        )).alias("value"),
    )
    is_late = F.col("ts") >= F.lit(quotes.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2")).first()[0])
    for half in (~is_late, is_late):
        topics.append_to_topic(quotes.filter(half), f"{folder}/topics/quotes", 4)
        stream = topics.stream_topics(t.spark, f"{folder}/topics", ["quotes"], "earliest")
        _finish(jobs.aggregate_quotes(
            stream, f"{folder}/table", f"{folder}/checkpoint", window="5 minutes", mode="update", available_now=True
        ))
    totals = upserts.read_upserts(t.spark, f"{folder}/table").withColumn("avg_price", F.round("avg_price", 8))
    return local_times(totals, "window_start", "window_end")
