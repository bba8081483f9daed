"""Stream sinks.  Every query needs a stable checkpoint folder, so that a restart goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from zonelake.sources.manifests import Manifests
from zonelake.streaming.feeds import as_messages

EPOCH = "epoch_id"


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def to_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    available_now: bool = False,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Write each micro-batch to its own partition ``epoch_id``; a repeated epoch replaces itself.

    With ``complete`` each epoch holds the whole result, so only the last ones are kept: read it with
    :func:`latest_epoch`.  With ``append`` the table is the union of the epochs: read it with :func:`all_epochs`.
    ``update`` is refused, because no reader of epochs can tell which version of a row is the last: use
    :func:`upserts.to_upsert_table`.
    """
    if mode == "update":
        raise ValueError("epochs hold whole results or new rows; use 'append' or 'complete', or an upsert table")

    def write(batch: DataFrame, epoch: int) -> None:
        writer = batch.write.format(fmt).mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{path}/{EPOCH}={epoch}")
        if mode == "complete":
            remove_old_epochs(batch.sparkSession, path, epoch)

    return _start(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, available_now)


def remove_old_epochs(spark: SparkSession, path: str, epoch: int) -> None:
    """Delete the epochs that the last two of a ``complete`` stream have replaced."""
    table = Manifests(spark, path)
    for name in table.names(path):
        if name.startswith(f"{EPOCH}=") and int(name.partition("=")[2]) < epoch - 1:
            table.remove(f"{table.path}/{name}")


def latest_epoch(spark: SparkSession, path: str) -> DataFrame:
    """Result of the newest epoch of a ``complete`` stream; the epoch is a partition, so only it is read."""
    epochs = spark.read.parquet(path)
    return epochs.filter(F.col(EPOCH) == epochs.agg(F.max(EPOCH)).scalar()).drop(EPOCH)


def all_epochs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(EPOCH)


def fan_out(
    df: DataFrame, sinks: list[Callable[[DataFrame, int], None]], checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """One query, several sinks: each micro-batch is computed once and handed to every sink."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, epoch)
        finally:
            batch.unpersist()

    return _start(df.writeStream.outputMode("append").foreachBatch(write), checkpoint, available_now)


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")


def message_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Messages as text files, one JSON document per line."""
    return lambda batch, epoch: as_messages(batch).write.mode("overwrite").text(f"{path}/{EPOCH}={epoch}")


def topic_sink(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Messages to a Kafka topic (needs Spark's Kafka connector)."""
    return lambda batch, epoch: (
        as_messages(batch).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )


def to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """All columns of a stream as JSON messages to a Kafka topic (needs Spark's Kafka connector)."""
    writer = as_messages(df).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return _start(writer.outputMode("append"), checkpoint, available_now=False)


def to_console(df: DataFrame) -> StreamingQuery:
    """Print every row in full, for trying things out."""
    return df.writeStream.format("console").option("truncate", False).outputMode("append").start()
