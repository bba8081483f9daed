"""Topics as landed files, read and written by Spark's own streaming with explicit positions.

A topic is a folder.  Messages lie in Parquet files below ``data/<partition>``; a numbered entry in ``log`` names the
files that one commit adds, with the offsets of their first and behind their last message, and carries on the end of
every partition and the last batch of every writer.  A file that no entry names doesn't exist for readers.  So a batch
becomes visible with one small file, a batch that is repeated after a restart finds itself in the log and adds nothing,
and a reader knows all ends from the newest entry.  One writer at a time may write to a topic.

Files are reached through Arrow's file systems (local, HDFS, S3, GCS), in the tasks as on the driver.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

FORMAT = "topic_log"
SCHEMA = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key STRING, value STRING"
STORED = pa.schema([("timestamp", pa.timestamp("us", "UTC")), ("key", pa.string()), ("value", pa.string())])
READ = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), *STORED])
#: Messages that one task reads, if its topic partition has so many.
TASK_ROWS = 1_000_000


@dataclass(frozen=True)
class Segment:
    """One file: messages ``first`` to before ``end`` of a partition."""

    partition: int
    first: int
    end: int
    file: str


class Log:
    """The commits of one topic."""

    def __init__(self, path: str):
        from pyarrow import fs

        uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/(?!/)", "file:///", path)).rstrip("/")
        self.fs, self.root = fs.FileSystem.from_uri(uri)

    def entries(self) -> list[int]:
        """Numbers of all commits, in order."""
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/log", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if re.fullmatch(r"\d+\.json", f.base_name))

    def entry(self, number: int) -> dict:
        with self.fs.open_input_stream(f"{self.root}/log/{number:020d}.json") as file:
            return json.loads(file.read())

    def newest(self) -> dict:
        numbers = self.entries()
        return self.entry(numbers[-1]) if numbers else {"number": -1, "ends": {}, "batches": {}, "segments": []}

    def segments(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        """Files with messages from start to before end, by partition; the log is read backwards as far as needed."""
        open_parts, found = {p for p, n in end.items() if n > start.get(p, 0)}, []
        for number in reversed(self.entries()):
            if not open_parts:
                break
            for s in (Segment(**s) for s in self.entry(number)["segments"]):
                p = str(s.partition)
                if p in open_parts and s.first < end[p] and s.end > start.get(p, 0):
                    found.append(s)
            reached = {str(s.partition) for s in found if s.first <= start.get(str(s.partition), 0)}
            open_parts -= reached
        return sorted(found, key=lambda s: (s.partition, s.first))

    def add(self, parts: list[Written], writer: str | None, batch: int | None) -> bool:
        """Name the written files in one new entry, in order of tasks; False if this batch is in the log already."""
        last = self.newest()
        if writer is not None and batch is not None and last["batches"].get(writer, -1) >= batch:
            return False
        ends, segments = dict(last["ends"]), []
        for part in parts:
            for partition, file, rows in part.files:
                first = ends.get(str(partition), 0)
                segments.append({"partition": partition, "first": first, "end": first + rows, "file": file})
                ends[str(partition)] = first + rows
        batches = {**last["batches"], **({writer: batch} if writer is not None and batch is not None else {})}
        entry = {"number": last["number"] + 1, "ends": ends, "batches": batches, "segments": segments}
        name = f"{self.root}/log/{entry['number']:020d}.json"
        self.fs.create_dir(f"{self.root}/log", recursive=True)
        hidden = f"{self.root}/log/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(hidden) as file:
            file.write(json.dumps(entry).encode())
        self.fs.move(hidden, name)
        return True

    def remove(self, parts: list[Written]) -> None:
        for part in parts:
            for _, file, _ in part.files:
                self.fs.delete_file(f"{self.root}/{file}")


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: (partition, file, messages)."""

    files: list


@dataclass
class Range(InputPartition):
    """What one task reads: files of one partition, messages ``first`` to before ``end``."""

    path: str
    topic: str
    segments: list
    first: int
    end: int


def ranges(path: str, topic: str, start: dict[str, int], end: dict[str, int], task_rows: int) -> list[Range]:
    """Tasks of at most ``task_rows`` messages (a file is read by one task or several) for what lies between."""
    out: list[Range] = []
    for s in Log(path).segments(start, end):
        first, last = max(s.first, start.get(str(s.partition), 0)), min(s.end, end[str(s.partition)])
        while first < last:
            held = out[-1] if out and out[-1].segments[-1].partition == s.partition and out[-1].end == first else None
            room = task_rows - (held.end - held.first) if held else 0
            if held and room > 0:
                held.end = min(last, first + room)
                if held.segments[-1] != s:
                    held.segments.append(s)
                first = held.end
            else:
                out.append(Range(path, topic, [s], first, min(last, first + task_rows)))
                first = out[-1].end
    return out


def read_range(part: Range) -> Iterator[pa.RecordBatch]:
    log = Log(part.path)
    for s in part.segments:
        at = s.first
        with log.fs.open_input_file(f"{log.root}/{s.file}") as file:
            for batch in pq.ParquetFile(file).iter_batches():
                low, high = max(part.first - at, 0), min(part.end - at, len(batch))
                if low < high:
                    rows, n = batch.slice(low, high - low), high - low
                    facts = [pa.repeat(part.topic, n), pa.repeat(pa.scalar(s.partition, pa.int32()), n), pa.array(range(at + low, at + high), pa.int64())]
                    yield pa.RecordBatch.from_arrays([*facts, *[rows.column(c) for c in STORED.names]], schema=READ)
                at += len(batch)


def positions(given: str, topics: dict[str, str]) -> dict[str, dict[str, int]]:
    """Start positions by topic and partition: ``earliest``, ``latest`` or JSON such as {"quotes": {"0": 17}}.

    Topics and partitions that the JSON doesn't name start at 0.  In JSON -1 is the end and -2 the start.
    """
    if given == "earliest":
        return {t: {} for t in topics}
    ends = {t: Log(path).newest()["ends"] for t, path in topics.items()}
    if given == "latest":
        return ends
    named = json.loads(given)
    if unknown := set(named) - set(topics):
        raise ValueError(f"positions of topics that are not read: {sorted(unknown)}")
    place = {-1: lambda t, p: ends[t].get(p, 0), -2: lambda t, p: 0}
    return {t: {p: place.get(n, lambda t, p, n=n: n)(t, p) for p, n in named.get(t, {}).items()} for t in topics}


class _Reads:
    """What the batch and the streaming reader share."""

    def __init__(self, options):
        root = options["path"].rstrip("/")
        self.topics = {t.strip(): f"{root}/{t.strip()}" for t in options["subscribe"].split(",")}
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "earliest"))
        self.ending = options.get("endingoffsets", options.get("endingOffsets", "latest"))
        self.task_rows = int(options.get("taskrows", options.get("taskRows", TASK_ROWS)))

    def plan(self, start: dict, end: dict) -> list[Range]:
        return [r for t, path in self.topics.items() for r in ranges(path, t, start.get(t, {}), end.get(t, {}), self.task_rows)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # Spark calls this once where there is nothing to read
            yield from read_range(partition)


class TopicReader(_Reads, DataSourceReader):
    def partitions(self) -> list[Range]:
        ends = positions("latest", self.topics)
        until = positions(self.ending, self.topics)
        stop = {t: {p: min(n, until[t].get(p, n)) for p, n in ends[t].items()} for t in ends}
        return self.plan(positions(self.starting, self.topics), stop)


class TopicStreamReader(_Reads, DataSourceStreamReader):
    """Progress is {topic: {partition: next offset}}; Spark keeps it in the query's checkpoint."""

    def initialOffset(self) -> dict:
        return positions(self.starting, self.topics)

    def latestOffset(self) -> dict:
        return positions("latest", self.topics)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.plan(start, end)


def deal(batch: pa.RecordBatch, partitions: int, task: int) -> pa.Array:
    """The partition of each message: the one it names, else one by its key, else one by its task."""
    rows = len(batch)
    named = batch.column("partition") if "partition" in batch.schema.names else pa.nulls(rows, pa.int32())
    keys = batch.column("key") if "key" in batch.schema.names else pa.nulls(rows, pa.string())
    by_key = [None if k is None else zlib.crc32(k.encode()) % partitions for k in keys.to_pylist()]
    found = pc.coalesce(named.cast(pa.int32()), pa.array(by_key, pa.int32()), pa.scalar(task % partitions, pa.int32()))
    if rows and (pc.min(found).as_py() < 0 or pc.max(found).as_py() >= partitions):
        raise ValueError(f"messages name a partition outside 0 to {partitions - 1}")
    return found


def write_part(path: str, partitions: int, batches: Iterator[pa.RecordBatch]) -> Written:
    """One file for each topic partition that has messages in this task."""
    from pyspark import TaskContext

    log, context, open_files, counts = Log(path), TaskContext.get(), {}, {}
    task = context.partitionId() if context else 0
    try:
        for batch in batches:
            where = deal(batch, partitions, task)
            columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(len(batch), f.type) for f in STORED]
            rows = pa.Table.from_arrays(columns, schema=STORED)
            for p in pc.unique(where).to_pylist():
                if p not in open_files:
                    name = f"data/{p}/{uuid.uuid4().hex}.parquet"
                    log.fs.create_dir(f"{log.root}/data/{p}", recursive=True)
                    open_files[p] = (name, pq.ParquetWriter(f"{log.root}/{name}", STORED, filesystem=log.fs))
                some = rows.filter(pc.equal(where, p))
                open_files[p][1].write_table(some)
                counts[p] = counts.get(p, 0) + len(some)
    finally:
        for _, writer in open_files.values():
            writer.close()
    return Written([(p, open_files[p][0], counts[p]) for p in sorted(open_files)])


class _Writes:
    def __init__(self, options):
        self.path, self.partitions = options["path"], int(options.get("partitions", 1))
        self.writer, self.batch = options.get("writer"), options.get("batch")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return write_part(self.path, self.partitions, iterator)

    def _commit(self, messages: list, batch: int | None) -> None:
        parts = [m for m in messages if m is not None]
        log = Log(self.path)
        if not log.add(parts, self.writer, batch):
            log.remove(parts)

    def _abort(self, messages: list) -> None:
        Log(self.path).remove([m for m in messages if m is not None])


class TopicWriter(_Writes, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._commit(messages, None if self.batch is None else int(self.batch))

    def abort(self, messages: list) -> None:
        self._abort(messages)


class TopicStreamWriter(_Writes, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._abort(messages)


class TopicLog(DataSource):
    """Format ``topic_log``.  Reading: path (of all topics), subscribe, startingOffsets, endingOffsets, taskRows.
    Writing: path (of the topic), partitions, writer (the same name after every restart), batch."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a topic is only added to; use mode 'append'")
        return TopicWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        if "writer" not in self.options:
            raise ValueError("option 'writer' names the query, so that repeated batches are known")
        return TopicStreamWriter(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(TopicLog)
    return spark


def read_topics(
    spark: SparkSession, root: str, topics: list[str], starting: str | dict = "earliest", ending: str | dict | None = None
) -> DataFrame:
    """The messages of topics from ``starting`` to before ``ending`` (default: the ends as of now), as a batch."""
    reader = _options(_registered(spark).read, root, topics, starting)
    return (reader.option("endingOffsets", _text(ending)) if ending else reader).load()


def stream_topics(spark: SparkSession, root: str, topics: list[str], starting: str | dict = "latest") -> DataFrame:
    """The same as a stream; ``starting`` counts for a new query only, a restarted one goes on where it stopped."""
    return _options(_registered(spark).readStream, root, topics, starting).load()


def _text(given: str | dict) -> str:
    return given if isinstance(given, str) else json.dumps(given)


def _options(reader, root: str, topics: list[str], starting: str | dict):
    return reader.format(FORMAT).option("path", root).option("subscribe", ",".join(topics)).option("startingOffsets", _text(starting))


def _messages(df: DataFrame) -> DataFrame:
    """The columns of a message; the rest is left out."""
    kinds = {"timestamp": "timestamp", "key": "string", "value": "string", "partition": "int"}
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items() if c in df.columns])


def append_to_topic(df: DataFrame, path: str, partitions: int = 1, writer: str | None = None, batch: int | None = None) -> None:
    """Add ``value`` (and ``key``, ``timestamp``, ``partition`` where there are such columns) of a batch to a topic.

    With ``writer`` and ``batch`` a batch that is in the topic already adds nothing.
    """
    out = _messages(df).write
    _registered(df.sparkSession)
    if writer is not None and batch is not None:
        out = out.option("writer", writer).option("batch", batch)
    out.format(FORMAT).mode("append").option("path", path).option("partitions", partitions).save()


def topic_log_sink(path: str, writer: str, partitions: int = 1) -> Callable[[DataFrame, int], None]:
    """One of several sinks of a query (see ``sinks.fan_out``): all columns as JSON messages."""
    from zonelake.streaming.feeds import as_messages

    return lambda batch, epoch: append_to_topic(as_messages(batch), path, partitions, writer, epoch)


def to_topic_log(
    df: DataFrame, path: str, checkpoint: str, writer: str, partitions: int = 1, available_now: bool = False
) -> StreamingQuery:
    """A stream of messages into a topic, each batch once, whatever is restarted."""
    _registered(df.sparkSession)
    out = _messages(df).writeStream.format(FORMAT).outputMode("append")
    out = out.option("path", path).option("partitions", partitions).option("writer", writer).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if available_now else out).start()
