"""The published tables of a lake by name, and complete exports of all of them.

A numbered manifest names every published table with its folder and schema.  Discovery, reads and the export sweep ask
the manifest and list no files, so what is staged below the same root and named by no manifest is invisible.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from zonelake.sources.manifests import Manifests
from zonelake.sources.sinks import replace_view

TABLES_SCHEMA = "`table` STRING, path STRING, columns ARRAY<STRING>, version BIGINT"
#: Exports that stay: the last complete one, and the one before it for those who still read it.
KEPT_EXPORTS = 2


class Published:
    """Names, folders and schemas of the tables below ``root``.  One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = Manifests(spark, self.root)

    def _state(self) -> dict:
        return self.log.newest() or {"number": -1, "tables": {}}

    def _write(self, tables: dict, number: int) -> None:
        self.log.write(number, {"tables": tables})
        self.log.forget(KEPT_EXPORTS)

    # ------------------------------------------------------------ tables

    def publish(self, frames: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None) -> None:
        """Write new versions of some tables and name all of them at once; other tables stay as they are.

        A name is made of letters, digits, underscores and slashes.  The last but one version of a table is removed.
        """
        for name in frames:
            if not re.fullmatch(r"\w+(/\w+)*", name):
                raise ValueError(f"'{name}' is no table name")
        state = self._state()
        number, tables = state["number"] + 1, dict(state["tables"])
        gone = []
        for name, df in frames.items():
            folder = f"{name}/v{number}-{uuid.uuid4().hex[:8]}"
            writer = df.write.partitionBy(*(partition_by or {}).get(name, []))
            writer.parquet(f"{self.root}/{folder}")
            last = tables.get(name, {})
            gone += [last["before"]] if last.get("before") else []
            tables[name] = {"folder": folder, "before": last.get("folder"), "schema": df.schema.json(), "version": number}
        self._write(tables, number)
        for folder in gone:
            self.log.remove(f"{self.root}/{folder}")

    def withdraw(self, name: str) -> None:
        """Take a table out.  Its files stay until they are removed by hand."""
        state = self._state()
        tables = dict(state["tables"])
        if tables.pop(name, None) is None:
            raise KeyError(name)
        self._write(tables, state["number"] + 1)

    def names(self) -> list[str]:
        return sorted(self._state()["tables"])

    def tables(self) -> DataFrame:
        """(table, path, columns, version) of all published tables."""
        rows = [
            (name, f"{self.root}/{x['folder']}", T.StructType.fromJson(json.loads(x["schema"])).names, x["version"])
            for name, x in sorted(self._state()["tables"].items())
        ]
        return self.spark.createDataFrame(rows, TABLES_SCHEMA)

    def read(self, name: str) -> DataFrame:
        """A published table, with the schema that it was written with: no footer is opened to find it."""
        entry = self._state()["tables"][name]
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{entry['folder']}").select(*schema.names)

    # ------------------------------------------------------------ exports

    def export_all(self, target: str) -> Published:
        """Write every published table flat below ``target`` and name them there together.

        A sweep that dies names nothing, so readers of ``target`` keep the last complete export.  Tables that are no
        longer published leave the export.
        """
        out = Published(self.spark, target)
        names = self.names()
        flat = {name.replace("/", "_"): name for name in names}
        if len(flat) < len(names):
            raise ValueError("two tables have the same flat name")
        state = out._state()
        if state["tables"].keys() - flat.keys():
            out._write({k: v for k, v in state["tables"].items() if k in flat}, state["number"] + 1)
        if flat:
            out.publish({name: self.read(source) for name, source in flat.items()})
        return out

    def register(self) -> DataFrame:
        """Make each table a view of the session, as of its last complete version: (table, status).

        A table whose files cannot be read is reported and has no view.
        """
        status = []
        for name in self.names():
            view = name.replace("/", "_")
            try:
                df = self.read(name)
                df.limit(0).collect()
                replace_view(df, view)
                status.append((view, "registered"))
            except AnalysisException as problem:
                self.spark.catalog.dropTempView(view)
                status.append((view, f"skipped: {problem.getCondition() or 'unreadable'}"))
        return self.spark.createDataFrame(status, "`table` STRING, status STRING")

    def counts(self) -> DataFrame:
        """(table, n): rows of each published table."""
        out = self.spark.createDataFrame([], "`table` STRING, n BIGINT")
        for name in self.names():
            out = out.unionByName(self.read(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n"))
        return out
