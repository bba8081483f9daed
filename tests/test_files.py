"""Objects, integrity, sources, sinks and the catalog."""

import datetime
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from zonelake.functions.scalars import media_kind
from zonelake.operators import integrity
from zonelake.plans import marts
from zonelake.session import scratch_path
from zonelake.sources import catalog, objects, readers, schemas, sinks


def png(width, height):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IEND", b"")


def jpeg(width, height):
    app0 = b"\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00"
    table = b"\xff\xdb\x00\x43" + bytes(65)
    frame = b"\xff\xc0\x00\x11\x08" + struct.pack(">HH", height, width) + b"\x03" + bytes(9)
    return b"\xff\xd8" + app0 + table + frame + b"\xff\xd9"


@pytest.fixture
def store(tmp_path):
    files = {"a.png": png(640, 480), "b.jpg": jpeg(300, 200), "c.pdf": b"%PDF-1.7 text", "empty.pdf": b"", "d.txt": b"plain text"}
    folder = tmp_path / "store"
    folder.mkdir()
    for name, data in files.items():
        (folder / name).write_bytes(data)
    return f"file:{folder}"


@pytest.mark.parametrize("data, kind", [
    (b"%PDF-1.4", "pdf"), (png(1, 1), "png"), (jpeg(1, 1), "jpeg"), (b"\xff\xd8\xff\xe1\x00\x00Exif", "jpeg"),
    (b"GIF89a....", "gif"), (b"BM1234", "bmp"), (b"II*\x00", "tiff"), (b"MM\x00*", "tiff"), (b"RIFF\x10\x00\x00\x00WEBPVP8 ", "webp"),
    (b"P6 3 2", "ppm"), (b"P1\n3", "pbm"), (b"P9 3", None), (b"plain", None), (b"", None), (None, None),
    (b"\xff\xd8\xff\xee\x00\x00none", None),
])
def test_media_kind(spark, data, kind):
    df = spark.createDataFrame([(bytearray(data) if data is not None else None,)], "head BINARY")
    assert df.select(media_kind("head")).first()[0] == kind


def test_null_path_is_invalid_and_spares_good_rows(spark, store, rows):
    df = spark.createDataFrame(
        [(i, f"{store}/{d}" if d else None, f"{store}/{f}") for i, (d, f) in enumerate([
            ("c.pdf", "a.png"), (None, "a.png"), ("c.pdf", "empty.pdf"), ("d.txt", "b.jpg"), ("none.pdf", "a.png"), ("b.jpg", "b.jpg")])],
        "id INT, doc STRING, face STRING",
    )
    scanned = objects.scan_objects(spark, store)
    probed = objects.probe_objects(integrity.referenced_paths(df, ["doc", "face"]))
    for headers in (scanned, probed):
        good, bad = integrity.split_by_files(df, ["doc", "face"], headers)
        assert rows(good, "id") == [(0,), (5,)] and rows(bad, "id") == [(1,), (2,), (3,), (4,)]


def test_image_metadata(spark, store, rows):
    texts = spark.createDataFrame([("a.png", "front page", ["x"])], "filename STRING, short_desc STRING, tags ARRAY<STRING>")
    meta = objects.image_metadata(spark, store, texts)
    assert rows(meta, "filename", "format", "width", "height", "short_desc") == [
        ("a.png", "PNG", 640, 480, "front page"), ("b.jpg", "JPEG", 300, 200, None)
    ]
    assert objects.image_metadata(spark, store).select("id").distinct().count() == 2


def test_table_path():
    moment = datetime.datetime(2024, 5, 6, 7, 8, 9)
    assert catalog.table_path("s3a://b/", "Landing", "s", "d", moment) == "s3a://b/Landing/s/d/snapshot_ts=20240506T070809"
    assert catalog.table_path("s3a://b", "Trusted", "s", "d", moment) == "s3a://b/Trusted/s/d"
    with pytest.raises(ValueError):
        catalog.table_path("b", "Bronze", "s", "d")


def test_write_table(spark, tmp_path, rows):
    base, df = str(tmp_path), spark.createDataFrame([(1, "x")], "a INT, p STRING")
    assert sinks.write_table(None, f"{base}/none") is None
    with pytest.raises(ValueError):
        sinks.write_table(df, base=base, zone="Trusted", datasource="s")
    path = sinks.write_table(df, base=base, zone="Trusted", datasource="s", dataset="d", partition_by=["p"])
    sinks.write_table(df.withColumn("b", F.lit(2.5)), path, partition_by=["p"])
    assert rows(readers.read_table(spark, path), "a", "b", "p") == [(1, None, "x"), (1, 2.5, "x")]
    assert rows(readers.read_parquet_tree(spark, path, "file").filter(F.col("file").contains("p=x")), "a") == [(1,), (1,)]
    both = sinks.append_evolving(df, df.withColumn("c", F.lit(1)))
    assert both.columns == ["a", "p", "c"] and sinks.preview(both, 1).count() == 1


def test_csv_stays_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2.5\n")
    assert readers.read_csv(spark, str(tmp_path)).dtypes == [("a", "string"), ("b", "string")]


def test_empty_payloads_and_rows(spark, tmp_path):
    assert readers.land_api_payload(spark, [], str(tmp_path / "x")) is None
    assert readers.rows_as_table(spark, [], "a INT") is None
    assert readers.rows_as_table(spark, [(None,)], "a INT").dtypes == [("a", "int")]


def test_ledger(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert not catalog.is_settled(spark, ledger, "t")
    catalog.set_property(spark, ledger, "t", "exported", True)
    catalog.set_property(spark, ledger, "u", "quarantine", "TRUE")
    assert catalog.is_settled(spark, ledger, "t") and catalog.is_settled(spark, ledger, "u")
    catalog.set_property(spark, ledger, "t", "exported", False)
    assert not catalog.is_settled(spark, ledger, "t")


def test_catalog_and_exports(spark, tmp_path):
    target = str(tmp_path)
    sinks.export_tables({("ops", "users"): spark.range(3)}, target)
    (tmp_path / "ops_broken").mkdir()
    status = {r.table: r.status.split(":")[0] for r in sinks.register_exports(spark, target, ["ops_users", "ops_broken"]).collect()}
    assert status == {"ops_users": "registered", "ops_broken": "skipped"}
    assert "ops_users" in catalog.catalog_tables(spark) and readers.read_table(spark, "ops_users").count() == 3
    assert catalog.table_or_empty(spark, "no_such_table", "a INT").count() == 0
    spark.catalog.dropTempView("ops_users")


def test_mart_with_missing_input(spark):
    reports = spark.createDataFrame([("A", 2024, 1, "bs", 2.0), ("A", 2024, 1, "bs", 3.0)], "symbol STRING, year INT, quarter INT, statement STRING, value DOUBLE")
    status = {r.table: r.status for r in marts.publish_mart(spark, marts.FINANCE, {"finnhub_financial_report": reports}).collect()}
    assert status["kpi_financial_totals"] == "built"
    assert status["kpi_tx_volume_currency"] == "skipped: ops_db_user_transactions is missing"
    assert spark.table("finance_reporting.kpi_financial_totals").first().total_value == 5.0


def test_stream_schemas():
    assert schemas.get_schema("stock_stream", "AAPL").names[:3] == ["symbol", "timestamp", "current_price"]
    with pytest.raises(ValueError):
        schemas.get_schema("weather")


def test_scratch_path_is_under_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_delta_is_a_parameter(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)delta|data_source_not_found|class"):
        sinks.write_table(spark.range(1), str(tmp_path / "d"), fmt="delta")
