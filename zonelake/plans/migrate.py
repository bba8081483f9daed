"""Landing snapshots to a trusted table: transform, deduplicate, validate, check files, publish, audit.

All pending snapshots go through one Spark job.  Its rows are staged under a batch id, in partitions per snapshot;
nothing is visible to readers until the ledger names the batch.  A run that dies leaves only unnamed staged files, and
a rerun stages anew, so every row is published once.

Snapshots take effect in name order, as if they were migrated one after the other.  The job assumes that all of them
pass.  If one fails, the snapshots before it are published, it is put in quarantine, and those behind it go round
again, because rows that lost to the failed one may now be the first of their key.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from zonelake.operators import quality, reshape
from zonelake.operators.dedup import deduplicate
from zonelake.operators.integrity import flag_files, referenced_paths
from zonelake.sources import schemas
from zonelake.sources.catalog import read_ledger, settled_tables
from zonelake.sources.objects import probe_objects

SNAPSHOT = "landing_table"
BATCH = "batch_id"
FILE_OK = "file_ok"
_LANDED, _KEPT = "rows landed", "rows kept"
AUDIT_SCHEMA = (
    "landing_table STRING, timestamp STRING, success BOOLEAN, error STRING, incoming_schema STRING, "
    "outgoing_schema STRING, cnt_orig BIGINT, cnt_dedup BIGINT, rule_results STRING, quarantine BOOLEAN, "
    "cnt_invalid_file BIGINT"
)


@dataclass(frozen=True)
class Dataset:
    """How one trusted table is made.  ``transform`` keeps the snapshot column it is given."""

    datasource: str
    name: str
    keys: tuple[str, ...]
    suite: quality.Suite
    transform: Callable[[DataFrame], DataFrame] = reshape.same_rows
    order_by: tuple[str, ...] = ()
    file_columns: tuple[str, ...] = ()
    landing_format: str = "parquet"
    landing_schema: str | None = None
    landing_path: str | None = None  # folder below the landing zone, when it is not <datasource>/<name>

    def landing_root(self, base: str) -> str:
        return f"{base.rstrip('/')}/Landing/{self.landing_path or f'{self.datasource}/{self.name}'}"

    def trusted_root(self, base: str) -> str:
        return f"{base.rstrip('/')}/Trusted/{self.datasource}/{self.name}"


def _indicators(df: DataFrame) -> DataFrame:
    # The indicator is the first part of the snapshot's name.
    return reshape.year_documents_to_long(df, reshape.indicator_of_path(SNAPSHOT), [SNAPSHOT])


# The trusted tables.  Fixed values: names and key columns.
DATASETS = (
    Dataset("ecb", "exchange_rates", ("time", "currency"), quality.EXCHANGE_RATES,
            lambda df: reshape.rates_to_long(df, [SNAPSHOT]), landing_format="json", landing_schema=reshape.RATES_SCHEMA),
    Dataset("imf", "indicators", ("year", "indicator"), quality.INDICATORS, _indicators,
            landing_format="text", landing_path="imf"),
    Dataset("finnhub", "financial_report", ("symbol", "year", "quarter", "statement", "concept"),
            quality.FINANCIAL_REPORT, lambda df: reshape.statements_to_long(df, [SNAPSHOT]),
            landing_format="json", landing_schema=reshape.STATEMENTS_SCHEMA, landing_path="finnhub"),
    Dataset("eodhd", "financial_news", ("ts", "title", "link"), quality.NEWS,
            lambda df: reshape.flatten_news(df, [SNAPSHOT]), landing_format="json", landing_schema=reshape.NEWS_SCHEMA),
    Dataset("ops_db", "user_transactions", ("transaction_id",), quality.TRANSACTIONS, landing_schema=schemas.TRANSACTION),
    Dataset("ops_db", "user_profiles", ("user_id",), quality.PROFILES, landing_schema=schemas.USER),
    Dataset("ops_db", "pdf_metadata", ("request_id",), quality.PDF_UPLOADS, landing_schema=schemas.PDF_UPLOAD,
            file_columns=("pdf_s3_path",)),
    Dataset("ops_db", "kyc_metadata", ("request_id",), quality.KYC, landing_schema=schemas.KYC_JOB,
            file_columns=("face_s3_path", "doc_s3_path")),
)


# ---------------------------------------------------------------- landing side


def _relative_folder(path: Column, root: str) -> Column:
    inside = F.regexp_replace(path, rf"^.*?\Q{root.rstrip('/')}\E/", "")
    return F.regexp_replace(inside, r"/[^/]*$", "")


def landing_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Names of the snapshot folders, in order.  ``quarantine`` is no snapshot."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    names = files.select(_relative_folder(F.col("path"), root).alias("name")).distinct()
    return [row.name for row in names.filter("name <> 'quarantine'").orderBy("name").collect()]


def pending_snapshots(spark: SparkSession, base: str, dataset: Dataset) -> list[str]:
    """Snapshots that are neither exported nor in quarantine."""
    settled = settled_tables(read_ledger(spark, ledger_path(base, dataset)))
    names = landing_snapshots(spark, dataset.landing_root(base))
    done = {row.table for row in settled.collect()}
    return [name for name in names if name not in done]


def read_snapshots(spark: SparkSession, base: str, dataset: Dataset, names: list[str]) -> DataFrame:
    """Rows of the named snapshots with the snapshot's name, in one scan of just these folders."""
    root = dataset.landing_root(base)
    reader = spark.read.format(dataset.landing_format).option("recursiveFileLookup", "true")
    if dataset.landing_schema:
        reader = reader.schema(dataset.landing_schema)
    elif dataset.landing_format == "parquet":
        reader = reader.option("mergeSchema", "true")
    df = reader.load([f"{root}/{name}" for name in names])
    file_path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select("*", _relative_folder(file_path, root).alias(SNAPSHOT))


# ---------------------------------------------------------------- trusted side


def ledger_path(base: str, dataset: Dataset) -> str:
    return f"{dataset.trusted_root(base)}/_ledger"


def _staged(spark: SparkSession, base: str, dataset: Dataset) -> DataFrame | None:
    try:
        df = spark.read.option("mergeSchema", "true").parquet(f"{dataset.trusted_root(base)}/data")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # no batch was ever staged
    kinds = {BATCH: "string", SNAPSHOT: "string", FILE_OK: "boolean"}  # partition values, read from folder names
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


def _published(spark: SparkSession, base: str, dataset: Dataset, flag: str) -> DataFrame | None:
    """Staged rows of the batches that the ledger names, for snapshots with the given outcome.

    The ledger has a few rows per snapshot.  Joined on the partition columns it prunes the staged folders at run time.
    """
    staged = _staged(spark, base, dataset)
    if staged is None:
        return None
    ledger = read_ledger(spark, ledger_path(base, dataset))
    named = ledger.filter(F.col("property") == flag).select(F.col("table").alias(SNAPSHOT), F.col("value").alias(BATCH))
    return staged.join(named, [SNAPSHOT, BATCH], "left_semi")


def read_trusted(spark: SparkSession, base: str, dataset: Dataset) -> DataFrame | None:
    """The trusted table; None before the first publish."""
    rows = _published(spark, base, dataset, "exported_batch")
    return None if rows is None else rows.filter(FILE_OK).drop(BATCH, SNAPSHOT, FILE_OK)


def read_quarantine(spark: SparkSession, base: str, dataset: Dataset) -> DataFrame | None:
    """Rows kept out of the trusted table: whole failed snapshots, and rows whose files are not usable."""
    failed = _published(spark, base, dataset, "quarantine_batch")
    bad_files = _published(spark, base, dataset, "exported_batch")
    if failed is None or bad_files is None:
        return None
    reason = lambda df, text: df.drop(BATCH, FILE_OK).withColumn("reason", F.lit(text))
    return reason(failed, "failed validation").unionByName(
        reason(bad_files.filter(~F.col(FILE_OK)), "unusable file"), allowMissingColumns=True
    )


def read_audit(spark: SparkSession, base: str, dataset: Dataset) -> DataFrame:
    """One record for each settled snapshot and for each run that failed.

    Records are written before their batch is named; those of a batch that never was are left out.
    """
    records = spark.read.schema(f"{AUDIT_SCHEMA}, {BATCH} STRING").json(f"{dataset.trusted_root(base)}/_audit")
    ledger = read_ledger(spark, ledger_path(base, dataset)).filter(F.col("property").isin("exported_batch", "quarantine_batch"))
    named = ledger.select(F.col("table").alias("landing_table"), F.col("value").alias(BATCH)).distinct()
    settled = records.filter(F.col(BATCH).isNotNull()).join(named, ["landing_table", BATCH], "left_semi")
    return settled.unionByName(records.filter(F.col(BATCH).isNull())).drop(BATCH)


# ---------------------------------------------------------------- the run


@dataclass
class _Round:
    """What one pass over the pending snapshots found out, per snapshot.  A few values each, never rows of data."""

    batch: str
    incoming: str
    outgoing: str
    before: dict[str, int] = field(default_factory=dict)
    after: dict[str, int] = field(default_factory=dict)
    bad_files: dict[str, int] = field(default_factory=dict)
    rules: dict[str, list[dict]] = field(default_factory=dict)

    def passed(self, name: str) -> bool:
        return all(rule["success"] for rule in self.rules.get(name, []))


def _stage(spark: SparkSession, base: str, dataset: Dataset, names: list[str], probe) -> _Round:
    batch = f"b{datetime.datetime.now(datetime.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    landing = read_snapshots(spark, base, dataset, names)
    tabular = dataset.transform(landing)
    fresh = deduplicate(
        tabular,
        list(dataset.keys),
        history=read_trusted(spark, base, dataset),
        order_by=[SNAPSHOT, *dataset.order_by],
    )
    if dataset.file_columns:
        # The store is asked once per path; the answers are kept, so that no retry asks again.
        columns = list(dataset.file_columns)
        answers = f"{dataset.trusted_root(base)}/_objects/{BATCH}={batch}"
        probe(referenced_paths(fresh, columns)).write.mode("overwrite").parquet(answers)
        fresh = flag_files(fresh, columns, spark.read.parquet(answers), FILE_OK)
    else:
        fresh = fresh.withColumn(FILE_OK, F.lit(True))
    path = f"{dataset.trusted_root(base)}/data/{BATCH}={batch}"
    if len(names) > 1 or dataset.file_columns:
        # Several output folders: bring rows of one folder together, so that not every task writes a small file into
        # each.  Adaptive execution splits the large folders over several tasks.
        fresh = fresh.hint("rebalance", SNAPSHOT, FILE_OK)
    fresh.write.mode("overwrite").partitionBy(SNAPSHOT, FILE_OK).parquet(path)

    # One collect of a few numbers per snapshot.  All but the landed count read the staged files, column by column.
    staged = spark.read.schema(fresh.schema).parquet(path)
    number = F.count(F.lit(1)).alias("n")
    landed = tabular.groupBy(SNAPSHOT).agg(number, F.lit(0).cast("bigint").alias("unexpected"))
    kept = staged.groupBy(SNAPSHOT).agg(number, F.count_if(~F.col(FILE_OK)).alias("unexpected"))
    facts = quality.evaluate(staged, dataset.suite, by=[SNAPSHOT]).drop("suite")
    for counts, name in ((landed, _LANDED), (kept, _KEPT)):
        facts = facts.unionByName(counts.withColumns({"rule": F.lit(name), "success": F.lit(True)}))
    found = _Round(
        batch=batch,
        incoming=landing.drop(SNAPSHOT).schema.json(),
        outgoing=fresh.drop(SNAPSHOT, FILE_OK).schema.json(),
    )
    for row in facts.collect():
        if row.rule == _LANDED:
            found.before[row[SNAPSHOT]] = row.n
        elif row.rule == _KEPT:
            found.after[row[SNAPSHOT]], found.bad_files[row[SNAPSHOT]] = row.n, row.unexpected
        else:
            rule = {"rule": row.rule, "n": row.n, "unexpected": row.unexpected, "success": row.success}
            found.rules.setdefault(row[SNAPSHOT], []).append(rule)
    return found


def _settle(spark: SparkSession, base: str, dataset: Dataset, found: _Round, good: list[str], bad: str | None) -> None:
    """Name the batch for the settled snapshots, in a single ledger write."""
    now = datetime.datetime.now(datetime.timezone.utc)
    entries = [(name, "exported", "true", now) for name in good]
    entries += [(name, "exported_batch", found.batch, now) for name in good]
    if bad:
        entries += [(bad, "quarantine", "true", now), (bad, "quarantine_batch", found.batch, now)]
    spark.createDataFrame(entries, "`table` STRING, property STRING, value STRING, updated_at TIMESTAMP").coalesce(
        1
    ).write.mode("append").parquet(ledger_path(base, dataset))


def _audit_rows(found: _Round, names: list[str], stamp: str) -> list[tuple]:
    return [
        (
            name, stamp, found.passed(name), None, found.incoming, found.outgoing, found.before.get(name, 0),
            found.after.get(name, 0), json.dumps(sorted(found.rules.get(name, []), key=lambda r: r["rule"])),
            not found.passed(name), found.bad_files.get(name, 0), found.batch,
        )
        for name in names
    ]


def migrate(spark: SparkSession, base: str, dataset: Dataset, probe=probe_objects) -> DataFrame | None:
    """Migrate all pending snapshots and return the trusted table.

    ``probe`` turns a frame of distinct ``path`` into (path, size, head) of the existing objects.
    """
    stamp = f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%d_%H%M%S}"
    pending = pending_snapshots(spark, base, dataset)

    def audit(rows: list[tuple]) -> None:
        folder = f"{dataset.trusted_root(base)}/_audit"
        spark.createDataFrame(rows, f"{AUDIT_SCHEMA}, {BATCH} STRING").coalesce(1).write.mode("append").json(folder)

    while pending:
        try:
            found = _stage(spark, base, dataset, pending, probe)
            failed = next((name for name in pending if not found.passed(name)), None)
            good = pending if failed is None else pending[: pending.index(failed)]
            settled = good if failed is None else [*good, failed]
            # First the record, then the name that makes it count, so that a run that dies in between loses neither.
            audit(_audit_rows(found, settled, stamp))
            _settle(spark, base, dataset, found, good, failed)
        except Exception as problem:
            audit([(name, stamp, False, str(problem), *[None] * 8) for name in pending])
            raise
        pending = pending[len(settled) :]
    return read_trusted(spark, base, dataset)
