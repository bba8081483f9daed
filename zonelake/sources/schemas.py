"""Schemas of streams and operational tables, as DDL text."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the messages.
STOCK = (
    "symbol STRING, timestamp TIMESTAMP, current_price DOUBLE, open_price DOUBLE, "
    "day_high DOUBLE, day_low DOUBLE, volume BIGINT"
)
CRYPTO = "c STRING, p DOUBLE, s STRING, t BIGINT, v DOUBLE"
KYC_EVENT = (
    "event STRING, request_id STRING, user_id STRING, doc_s3_path STRING, face_s3_path STRING, "
    "upload_time STRING, status STRING"
)
PDF_EVENT = "event STRING, request_id STRING, user_id STRING, s3_path STRING, upload_time STRING"
TRANSACTION = (
    "transaction_id STRING, user_id STRING, timestamp TIMESTAMP, type STRING, amount DECIMAL(38,18), "
    "currency STRING, description STRING, location STRING, device_id STRING, ip_address STRING, "
    "account_balance DECIMAL(38,18), previous_transaction STRING, transaction_duration BIGINT, login_attempts BIGINT"
)
TRANSACTION_EVENT = f"event STRING, {TRANSACTION}"
KYC_JOB = (
    "request_id STRING, user_id STRING, doc_s3_path STRING, face_s3_path STRING, upload_time TIMESTAMP, status STRING"
)
PDF_UPLOAD = "request_id STRING, user_id STRING, category STRING, pdf_s3_path STRING, upload_time TIMESTAMP"
USER = "user_id STRING, age BIGINT, occupation STRING"

STREAMS = {"stock_stream": STOCK, "crypto_stream": CRYPTO, "fraud_detect": KYC_EVENT}
EVENTS = {"kyc": KYC_EVENT, "pdf": PDF_EVENT, "user_transaction": TRANSACTION_EVENT}


def parse_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def get_schema(datasource: str, dataset: str | None = None) -> T.StructType:
    """Schema of a stream; an unknown name raises ValueError.  ``dataset`` is accepted and not needed so far."""
    if datasource not in STREAMS:
        raise ValueError(f"unknown stream '{datasource}'; known: {', '.join(sorted(STREAMS))}")
    return parse_ddl(STREAMS[datasource])
