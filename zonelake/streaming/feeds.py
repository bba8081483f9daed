"""Topics as DataFrames with a text column ``value``, and their messages as typed columns.

All functions but the two readers work on batch and streaming frames alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.functions.cleaning import computed_once
from zonelake.sources.schemas import parse_ddl


def read_topics(spark: SparkSession, servers: str, topics: list[str], starting: str = "latest", **options: str) -> DataFrame:
    """One or several Kafka topics: (topic, value as text).  Needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select("topic", F.col("value").cast("string").alias("value"))
    )


def read_files(
    spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of files as a stream, e.g. landed messages; ``glob`` picks files by name."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def parse_messages(df: DataFrame, schema: T.StructType | str, keep: list[str] | None = None) -> DataFrame:
    """JSON ``value`` to typed columns.  A malformed message gives a row of NULLs."""
    schema = parse_ddl(schema) if isinstance(schema, str) else schema
    return df.select(*(keep or []), F.from_json(F.col("value").cast("string"), schema).alias("_data")).select(
        *(keep or []), "_data.*"
    )


def _all_null(schema: T.StructType, parsed: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{parsed}.`{name}`").isNull() for name in schema.names])


def dead_letters(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The messages from which no field can be read, as they came."""
    schema = parse_ddl(schema) if isinstance(schema, str) else schema
    parsed = df.withColumn("_data", F.from_json(F.col("value").cast("string"), schema))
    return parsed.filter(_all_null(schema, "_data")).drop("_data")


def typed_branch(df: DataFrame, event: str, schema: T.StructType | str) -> DataFrame:
    """Messages of one event type, parsed with that type's schema."""
    return parse_messages(df.filter(F.get_json_object("value", "$.event") == event), schema)


def dispatch_events(df: DataFrame, schemas: dict[str, str], event_field: str = "event") -> DataFrame:
    """A topic that mixes event types to one wide frame; a field that a type does not have is NULL there.

    The message is parsed once, with the union of all schemas; the field's type must agree between schemas.
    """
    fields: dict[str, T.StructField] = {}
    owners: dict[str, set[str]] = {}
    for event, ddl in schemas.items():
        for field in parse_ddl(ddl).fields:
            known = fields.setdefault(field.name, field)
            if known.dataType != field.dataType:
                raise ValueError(f"field '{field.name}' has two types: {known.dataType}, {field.dataType}")
            owners.setdefault(field.name, set()).add(event)
    parsed = computed_once(parse_messages(df, T.StructType(list(fields.values()))), list(fields)).filter(
        F.col(event_field).isin(*schemas)
    )
    return parsed.select(
        *[
            F.col(f"`{name}`")
            if owners[name] == set(schemas)
            else F.when(F.col(event_field).isin(*sorted(owners[name])), F.col(f"`{name}`")).alias(name)
            for name in fields
        ]
    )


def rejected_events(df: DataFrame, schemas: dict[str, str], event_field: str = "event") -> DataFrame:
    """What :func:`dispatch_events` does not return: the message as it came, with ``reason``."""
    event = F.get_json_object(F.col("value").cast("string"), f"$.{event_field}")
    reason = F.when(event.isNull(), "malformed or without type").when(~event.isin(*schemas), "unknown type")
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def dispatch_topics(df: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """Rows of several topics, each parsed with its own schema, united by column name (``topic`` is kept).

    One scan serves all topics: each row is parsed with the schema of its topic.  Rows of other topics are in
    :func:`rejected_topics`.
    """
    parsed = {t: parse_ddl(ddl) for t, ddl in schemas.items()}
    structs = {t: F.when(F.col("topic") == t, F.from_json(F.col("value").cast("string"), s)) for t, s in parsed.items()}
    names = {f"_d{i}": t for i, t in enumerate(structs)}
    rows = df.filter(F.col("topic").isin(*schemas)).select("topic", *[structs[t].alias(c) for c, t in names.items()])
    fields: dict[str, list[Column]] = {}
    for c, t in names.items():
        for name in parsed[t].names:
            fields.setdefault(name, []).append(F.col(f"{c}.`{name}`"))
    return rows.select("topic", *[F.coalesce(*found).alias(name) for name, found in fields.items()])


def rejected_topics(df: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """Rows of topics without a schema, as they came."""
    return df.filter(F.col("topic").isNull() | ~F.col("topic").isin(*schemas))


def trades_as_quotes(trades: DataFrame) -> DataFrame:
    """The crypto trade feed (c, p, s, t, v) in the column names of the stock feed, so both can be aggregated."""
    return trades.select(
        F.col("s").alias("symbol"),
        F.timestamp_millis("t").alias("timestamp"),
        F.col("p").alias("current_price"),
        F.col("v").alias("volume"),
    )


def as_messages(df: DataFrame) -> DataFrame:
    """All columns as one JSON ``value``, the form a topic takes."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
