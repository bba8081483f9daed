"""Operational tables land exactly once: extract, landing and marking as one job under a batch id.

A batch is staged (rows, and the ids that they mark) and then named by one manifest, so rows and marks become visible
together.  What a run leaves that dies before is invisible, and a rerun under the same id replaces it; a rerun after it
does nothing.  The source learns its marks last: whichever it has missed are found again by :meth:`Landing.to_mark`, and
until then the landed ids keep these rows out of the next batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.plans.ingest import Extract, pending_rows
from zonelake.sources.catalog import table_path
from zonelake.sources.unique import BATCH, BUCKETS, KEY, UniqueTable

DATASOURCE = "ops_db"


class Landing:
    """The landed rows of one operational table, below ``<base>/Landing/ops_db/<target>``."""

    def __init__(self, spark: SparkSession, base: str, extract: Extract, buckets: int = BUCKETS):
        self.spark, self.extract = spark, extract
        # Batches take the place of snapshots: the manifest says which of them count.
        folder = table_path(base, "Landing", DATASOURCE, extract.target).rpartition("/")[0]
        self.table = UniqueTable(spark, folder, [extract.id_column], buckets)

    def run(self, source: DataFrame, batch: str, order_by: list[str] | None = None) -> bool:
        """Land all pending rows of ``source`` that have not landed yet; False if the batch is there already.

        Of rows that repeat an id the first by ``order_by`` lands.  A row without an id can't be marked, so it doesn't
        land; :meth:`unidentified` has it.
        """
        rows = pending_rows(source, self.extract.columns, self.extract.id_column)
        return self.table.insert(rows.filter(F.col(self.extract.id_column).isNotNull()), batch, order_by)

    def read(self) -> DataFrame:
        """All landed rows with their batch."""
        if not self.table.batches():
            return self.spark.createDataFrame([], f"{self.extract.schema}, {BATCH} STRING")
        return self.table.read_batches()

    def to_mark(self, source: DataFrame) -> DataFrame:
        """Ids of rows that have landed and that the source still counts as pending."""
        name = self.extract.id_column
        ids = pending_rows(source, [name], name).filter(F.col(name).isNotNull()).distinct()
        keyed = ids.withColumn(KEY, F.struct(name))
        return keyed.join(self.table.known_keys(keyed.schema[KEY].dataType), KEY, "left_semi").select(name)

    def unidentified(self, source: DataFrame) -> DataFrame:
        """Pending rows without an id."""
        name = self.extract.id_column
        return pending_rows(source, self.extract.columns, name).filter(F.col(name).isNull())

    def counts(self) -> DataFrame:
        """(batch, landed): rows of each batch, as written; a batch without rows has 0."""
        batches = self.spark.createDataFrame([(b,) for b in self.table.batches()], f"{BATCH} STRING")
        found = self.read().groupBy(BATCH).agg(F.count(F.lit(1)).alias("landed"))
        return batches.join(found, BATCH, "left").select(BATCH, F.coalesce("landed", F.lit(0)).alias("landed"))


def split_of(column: str, low: int, high: int, rows: int, rows_per_part: int = 1_000_000) -> tuple[str, int, int, int] | None:
    """The ``split`` of :func:`~zonelake.sources.readers.read_relational` that gives ranges of about ``rows_per_part``
    rows, for ids that are spread evenly; None if one range will do.  The outer ranges are open, so no row is left out."""
    parts = min(-(-rows // rows_per_part), high - low + 1)
    return (column, low, high + 1, parts) if parts > 1 else None


def bounds_query(extract: Extract, status: str = "status", done: str = "exported") -> str:
    """Smallest and largest id and the number of pending rows, as SQL for the source database."""
    name = extract.id_column
    return f"SELECT MIN({name}) AS low, MAX({name}) AS high, COUNT(*) AS n FROM {extract.source} WHERE {status} <> '{done}'"
