"""Tables with unique keys whose history is never shuffled.

Beside the rows lies an index of their keys, bucketed by key.  A batch is dealt into the same buckets and joined with the
index in place: the plan has no exchange on the side of the history, and one row per key, so a key with most of the rows
is one row there as well.  Rows and keys of a batch are written below its id and become visible together, when a manifest
names the batch.  A batch that is repeated replaces what it left unpublished, or is known as done.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.operators.dedup import keep_one
from zonelake.sources.manifests import Manifests

KEY, BATCH = "_key", "batch"
#: Buckets of the index.  Of a table that will have 100 TB of rows: its bytes of keys over some hundred MB.
BUCKETS = 64


class UniqueTable:
    """Rows under ``<path>/data``, the index of their keys under ``<path>/keys``.

    NULL keys equal each other.  The number of buckets is fixed when the table gets its first batch.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.log = Manifests(spark, self.path)
        last = self.log.newest()
        if last is not None and last["keys"] != self.keys:
            raise ValueError(f"the keys of this table are {last['keys']}")
        self.buckets = last["buckets"] if last else buckets
        self.name = f"_unique_{zlib.crc32(self.path.encode()):08x}_{self.buckets}"

    # ------------------------------------------------------------ state

    def _state(self) -> dict:
        return self.log.newest() or {"number": -1, "done": [], "data": [], "index": [], "schema": None}

    def batches(self) -> list[str]:
        """Ids of all published batches, in order."""
        return self._state()["done"]

    def read(self) -> DataFrame:
        """All rows of published batches."""
        state = self._state()
        if state["schema"] is None:
            raise FileNotFoundError(f"no batch is published below {self.path}")
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        folders = [f"{self.path}/data/{BATCH}={b}" for b in state["data"]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read_batches(self) -> DataFrame:
        """As :meth:`read`, with the batch that has added each row in the column ``batch``."""
        state = self._state()
        if state["schema"] is None:
            raise FileNotFoundError(f"no batch is published below {self.path}")
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        if BATCH in (name.lower() for name in schema.names):
            raise ValueError(f"the rows have a column {BATCH} of their own")
        folders = [f"{self.path}/data/{BATCH}={b}" for b in state["data"]]
        return self.spark.read.schema(schema.add(BATCH, "string")).option("basePath", f"{self.path}/data").parquet(*folders)

    def known_keys(self, key_type: T.StructType) -> DataFrame:
        """The index of published batches: ``_key`` in its buckets."""
        self._register(key_type)
        return self.spark.table(self.name).filter(F.col(BATCH).isin(self._state()["index"])).select(KEY)

    def _register(self, key_type: T.StructType) -> None:
        """Make the bucketed folder a table of this session's catalog, with the batches that are there now."""
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(
                f"CREATE TABLE `{self.name}` ({KEY} {key_type.simpleString()}, {BATCH} STRING) USING parquet "
                f"PARTITIONED BY ({BATCH}) CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/keys'"
            )
        if self.log.names(f"{self.path}/keys"):
            self.spark.sql(f"ALTER TABLE `{self.name}` RECOVER PARTITIONS")

    # ------------------------------------------------------------ batches

    def _keyed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(KEY, F.struct(*self.keys))

    def absent(self, df: DataFrame) -> DataFrame:
        """Rows whose key no published batch has."""
        keyed = self._keyed(df)
        # No hint for the index: its buckets spare the shuffle, and its size would forbid a broadcast.
        return keyed.join(self.known_keys(keyed.schema[KEY].dataType), KEY, "left_anti").drop(KEY)

    def insert(self, df: DataFrame, batch: str, order_by: list[str] | None = None, keep: str = "first") -> bool:
        """Add the rows whose key is new, one per key; False if the batch is published already."""
        if not re.fullmatch(r"[A-Za-z0-9.-]+", batch):
            raise ValueError("a batch id is made of letters, digits, dots and hyphens")
        state = self._state()
        if batch in state["done"]:
            return False
        fresh = self.absent(keep_one(df, self.keys, order_by, keep))
        rows = f"{self.path}/data/{BATCH}={batch}"
        fresh.write.mode("overwrite").parquet(rows)
        written = self.spark.read.schema(fresh.schema).parquet(rows)
        self._write_keys(self._keyed(written).select(KEY), batch)
        known = T.StructType.fromJson(json.loads(state["schema"])).fields if state["schema"] else []
        fields = {**{f.name: f for f in known}, **{f.name: f for f in fresh.schema.fields}}
        self._publish(
            done=[*state["done"], batch], data=[*state["data"], batch], index=[*state["index"], batch],
            schema=T.StructType(list(fields.values())).json(),
        )
        return True

    def _write_keys(self, keys: DataFrame, batch: str) -> None:
        dealt = keys.repartition(self.buckets, KEY)
        self.spark.sql(f"INSERT OVERWRITE TABLE `{self.name}` PARTITION ({BATCH} = '{batch}') SELECT {KEY} FROM {{keys}}", keys=dealt)

    def _publish(self, **state) -> None:
        last = self.log.newest()
        self.log.write(last["number"] + 1 if last else 0, {**state, "keys": self.keys, "buckets": self.buckets})

    def compact_index(self) -> None:
        """One file per bucket again: the index of all batches as one.  What it replaces goes after the manifest."""
        state = self._state()
        if len(state["index"]) < 2:
            return
        name = f"index-{state['number'] + 1}"
        types = T.StructType.fromJson(json.loads(state["schema"]))
        key_type = T.StructType([types[k] for k in self.keys])
        self._register(key_type)
        # As plain files: Spark refuses to overwrite a partition of a table that it reads.
        old = self.spark.read.schema(T.StructType([T.StructField(KEY, key_type)]))
        self._write_keys(old.parquet(*[f"{self.path}/keys/{BATCH}={b}" for b in state["index"]]), name)
        self._publish(**{k: state[k] for k in ("done", "data", "schema")}, index=[name])
        for batch in state["index"]:
            self.log.remove(f"{self.path}/keys/{BATCH}={batch}")
            self.spark.sql(f"ALTER TABLE `{self.name}` DROP IF EXISTS PARTITION ({BATCH}='{batch}')")
