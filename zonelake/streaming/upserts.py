"""Streams in update mode: changed rows replace stored rows with the same key.

The table is cut into parts by an expression over its key.  A micro-batch rewrites only the parts that it touches, into
a folder of its own epoch, and then publishes a manifest that names the folder of every part.  A batch that is repeated
after a restart finds its manifest and does nothing, or replaces its unpublished folders.  Versions of parts that none of
the newest manifests names are removed, so the folder holds the table and what one or two batches have replaced.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zonelake.sources.manifests import Manifests

#: Parts of a table whose key gives no better ones, and manifests that are kept for readers on the way.
PARTS, KEEP = 32, 2


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"{name}_"
    return name


def part_names(keys: list[str], part: Column | None) -> Column:
    """The part of a row as a folder name; parts that share a name are one part."""
    if part is None:
        part = F.pmod(F.xxhash64(*keys), F.lit(PARTS))
    return F.coalesce(F.regexp_replace(part.cast("string"), r"[^A-Za-z0-9.\-]", "_"), F.lit("none"))


def merge_batch(old: DataFrame | None, batch: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: that of the batch, the last by ``order_by`` of several, else the stored one.  NULL keys are equal.

    Rows are combined before the shuffle, so a key that fills the batch is one row per task.
    """
    rest = [c for c in batch.columns if c not in keys]
    both = batch.withColumn("_new", F.lit(1))
    if old is not None:
        both = old.withColumn("_new", F.lit(0)).unionByName(both, allowMissingColumns=True)
        rest += [c for c in old.columns if c not in keys and c not in rest]
    order = F.struct("_new", *(order_by or []))
    merged = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row") if rest else F.max("_new").alias("_row"))
    return merged.select(*keys, "_row.*") if rest else merged.select(*keys)


def upsert_sink(
    path: str, keys: list[str], part: Column | None = None, order_by: list[str] | None = None, keep: int = KEEP
) -> Callable[[DataFrame, int], None]:
    """Merge micro-batches into a table.  ``part`` is an expression over key columns, e.g. the day of a window: the finer
    it follows what changes together, the less is rewritten.  ``keep``: manifests that readers may still be using."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        log = Manifests(spark, path)
        last = log.newest()
        if last is not None and last["number"] >= epoch:
            return
        batch.persist()
        try:
            name = _free(batch, "part")
            touched = sorted(r[0] for r in batch.select(part_names(keys, part).alias(name)).distinct().collect())
            if not touched:
                return
            parts = dict(last["parts"]) if last else {}
            stored = [f"{path.rstrip('/')}/{parts[p]}" for p in touched if p in parts]
            old = spark.read.schema(_schema(last)).parquet(*stored) if stored else None
            merged = merge_batch(old, batch, keys, order_by)
            folder = f"data/epoch={epoch}"
            dealt = merged.withColumn(name, part_names(keys, part)).hint("rebalance", F.col(name))
            dealt.write.mode("overwrite").partitionBy(name).parquet(f"{path.rstrip('/')}/{folder}")
            parts.update({p: f"{folder}/{name}={p}" for p in touched})
            known = {f.name: f for f in _schema(last).fields} if last else {}
            schema = T.StructType(list({**known, **{f.name: f for f in merged.schema.fields}}.values()))
            log.write(epoch, {"parts": parts, "schema": schema.json()})
        finally:
            batch.unpersist()
        remove_unnamed(log, keep)

    return write


def remove_unnamed(log: Manifests, keep: int = KEEP) -> None:
    """Delete all but the newest manifests, and the folders that none of these names."""
    log.forget(keep)
    numbers = log.numbers()
    named = {folder for n in numbers for folder in log.read(n)["parts"].values()}
    for epoch in log.names(f"{log.path}/data"):
        if int(epoch.partition("=")[2]) > numbers[-1]:
            continue
        parts = [p for p in log.names(f"{log.path}/data/{epoch}") if "=" in p]
        unnamed = [p for p in parts if f"data/{epoch}/{p}" not in named]
        if len(unnamed) == len(parts):
            log.remove(f"{log.path}/data/{epoch}")
        else:
            for p in unnamed:
                log.remove(f"{log.path}/data/{epoch}/{p}")


def _schema(manifest: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(manifest["schema"]))


def read_upserts(spark: SparkSession, path: str, parts: list[str] | None = None) -> DataFrame:
    """The table as its newest manifest names it; ``parts`` reads some parts only."""
    last = Manifests(spark, path).newest()
    if last is None:
        raise FileNotFoundError(f"no manifest below {path}")
    folders = [f"{path.rstrip('/')}/{f}" for p, f in sorted(last["parts"].items()) if parts is None or p in parts]
    return spark.read.schema(_schema(last)).parquet(*folders) if folders else spark.createDataFrame([], _schema(last))


def to_upsert_table(
    df: DataFrame, path: str, checkpoint: str, keys: list[str], part: Column | None = None, available_now: bool = False
) -> StreamingQuery:
    """A stream in update mode into a table with one row per key."""
    from zonelake.streaming.sinks import _start

    return _start(df.writeStream.outputMode("update").foreachBatch(upsert_sink(path, keys, part)), checkpoint, available_now)
