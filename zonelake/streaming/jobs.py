"""The two streaming jobs: quote aggregates, and event scoring from topic to topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonelake.sources.schemas import get_schema
from zonelake.streaming import aggregates, feeds, scoring, sinks, upserts


def aggregate_quotes(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    datasource: str = "stock_stream",
    window: str = "1 minute",
    watermark: str = "2 minutes",
    mode: str = "complete",
    partition_by: list[str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Topic -> typed quotes -> tumbling windows -> table.  Works for the stock and the crypto feed.

    ``update`` writes a table with one row per symbol and window, in parts by day: read it with
    :func:`upserts.read_upserts`.  The other modes write epochs (see :func:`sinks.to_table`).
    """
    quotes = feeds.parse_messages(messages, get_schema(datasource))
    if datasource == "crypto_stream":
        quotes = feeds.trades_as_quotes(quotes)
    totals = aggregates.window_totals(quotes, window, watermark)
    if mode == "update":
        if partition_by:
            raise ValueError("an updated table has parts by day, not partitions")
        day = F.date_format("window_start", "yyyy-MM-dd")
        return upserts.to_upsert_table(totals, path, checkpoint, ["symbol", "window_start"], day, available_now)
    return sinks.to_table(totals, path, checkpoint, mode, partition_by, available_now)


def score_topic(
    messages: DataFrame,
    outputs: list[Callable[[DataFrame, int], None]],
    checkpoint: str,
    datasource: str = "fraud_detect",
    rules: list[scoring.RiskRule] | None = None,
    threshold: float = scoring.KYC_THRESHOLD,
    available_now: bool = False,
    rejects: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Topic -> typed events -> risk score -> every output, all from one query.

    Messages from which nothing can be read are not scored; they go to ``rejects`` as they came, by default to a table
    beside the checkpoint (see :func:`rejects_path`).
    """
    schema = get_schema(datasource)
    rejects = rejects or sinks.table_sink(rejects_path(checkpoint))

    def scored(batch: DataFrame) -> DataFrame:
        events = feeds.parse_messages(batch, schema).dropna(how="all")
        return scoring.score_events(events, scoring.KYC_RULES if rules is None else rules, threshold)

    sends = [lambda batch, epoch, send=send: send(scored(batch), epoch) for send in outputs]
    sends.append(lambda batch, epoch: rejects(feeds.dead_letters(batch, schema), epoch))
    return sinks.fan_out(messages, sends, checkpoint, available_now)


def rejects_path(checkpoint: str) -> str:
    """Where unreadable messages of a scoring job lie unless it is given a place."""
    return f"{checkpoint.rstrip('/')}_rejects"
