"""Incremental extract of operational tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.operators.dedup import exclude_existing
from zonelake.sources import schemas
from zonelake.sources.catalog import table_or_empty


@dataclass(frozen=True)
class Extract:
    """One operational table: what to read, how its rows are identified, where they land."""

    source: str
    target: str
    id_column: str
    schema: str

    @property
    def columns(self) -> list[str]:
        return schemas.parse_ddl(self.schema).names


# Operational tables and the dataset each one feeds.
EXTRACTS = (
    Extract("kyc_jobs", "kyc_metadata", "request_id", schemas.KYC_JOB),
    Extract("pdf_uploads", "pdf_metadata", "request_id", schemas.PDF_UPLOAD),
    Extract("user_transactions", "user_transactions", "transaction_id", schemas.TRANSACTION),
    Extract("users", "user_profiles", "user_id", schemas.USER),
)


def pending_rows(
    source: DataFrame,
    columns: list[str],
    id_column: str,
    exported: DataFrame | None = None,
    status: str = "status",
    done: str = "exported",
) -> DataFrame:
    """Rows not yet exported: status differs from ``done`` (a NULL status does not count as pending, as in SQL), and
    the id is not in the ledger of exported ids."""
    pending = source.filter(F.col(status) != done).select(*columns)
    return pending if exported is None else exclude_existing(pending, exported, [id_column], null_safe=False)


def pending_query(extract: Extract, status: str = "status", done: str = "exported") -> str:
    """The same extract as SQL, to be run inside the source database by the JDBC reader."""
    return f"SELECT {', '.join(extract.columns)} FROM {extract.source} WHERE {status} <> '{done}'"


def pending_of_table(spark: SparkSession, extract: Extract, exported: DataFrame | None = None) -> DataFrame:
    """Pending rows of a registered table; a missing table has none."""
    schema = extract.schema if "status" in extract.columns else f"{extract.schema}, status STRING"
    source = table_or_empty(spark, extract.source, schema)
    return pending_rows(source, extract.columns, extract.id_column, exported)
