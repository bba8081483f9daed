import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from zonelake.sources import schemas
from zonelake.streaming import aggregates, feeds, jobs, scoring, sinks

MINUTE = "2024-01-01T00:{:02d}:00"


class Topic:
    """A folder of text files; each put is one micro-batch."""

    def __init__(self, folder):
        self.folder, self.count = folder, 0
        folder.mkdir(parents=True)

    def put(self, *messages):
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        file = self.folder / f"{self.count:04d}.txt"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.count,) * 2)  # the source takes files in order of time
        self.count += 1

    def stream(self, spark):
        return feeds.read_files(spark, str(self.folder), "value STRING", "text", files_per_batch=1)


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


def quote(symbol, minute, price, volume=1):
    return {"symbol": symbol, "timestamp": MINUTE.format(minute), "current_price": price, "volume": volume}


def run(spark, topic, tmp_path, mode, **options):
    handle = jobs.aggregate_quotes(
        topic.stream(spark), str(tmp_path / "table"), str(tmp_path / "checkpoint"), window="5 minutes", mode=mode,
        available_now=True, **options,
    )
    handle.awaitTermination()
    return handle


def totals(df):
    return {(r.symbol, r.window_start.minute): (r.avg_price, r.total_volume) for r in df.collect()}


def test_complete_equals_batch_and_keeps_late_rows(spark, topic, tmp_path):
    topic.put(quote("A", 1, 10.0), quote("A", 2, 20.0), quote("B", 6, 1.0), "not json", {"symbol": "A", "current_price": 9.0})
    topic.put(quote("A", 40, 5.0))
    topic.put(quote("B", 45, 5.0))
    topic.put(quote("A", 3, 30.0))  # far behind the watermark
    run(spark, topic, tmp_path, "complete")
    got = totals(sinks.latest_epoch(spark, str(tmp_path / "table")))
    batch = aggregates.window_totals(
        feeds.parse_messages(spark.read.text(str(topic.folder)), schemas.get_schema("stock_stream")), "5 minutes"
    )
    assert got == totals(batch) == {("A", 0): (20.0, 3), ("B", 5): (1.0, 1), ("A", 40): (5.0, 1), ("B", 45): (5.0, 1)}


def test_append_drops_late_rows_and_holds_the_open_window(spark, topic, tmp_path):
    topic.put(quote("A", 1, 10.0))
    topic.put(quote("A", 40, 5.0))
    topic.put(quote("A", 41, 7.0))  # lets the watermark take effect
    topic.put(quote("A", 2, 99.0))  # too late
    handle = run(spark, topic, tmp_path, "append")
    assert totals(sinks.all_epochs(spark, str(tmp_path / "table"))) == {("A", 0): (10.0, 1)}
    dropped = sum(op.numRowsDroppedByWatermark for p in handle.recentProgress for op in p.stateOperators)
    assert dropped == 1


def test_restart_goes_on_without_duplicates(spark, topic, tmp_path):
    topic.put(quote("A", 1, 10.0))
    run(spark, topic, tmp_path, "complete")
    topic.put(quote("A", 2, 30.0))
    run(spark, topic, tmp_path, "complete")
    run(spark, topic, tmp_path, "complete")
    assert totals(sinks.latest_epoch(spark, str(tmp_path / "table"))) == {("A", 0): (20.0, 2)}


def test_partitioned_table(spark, topic, tmp_path):
    topic.put(quote("A", 1, 10.0), quote("B", 1, 4.0))
    run(spark, topic, tmp_path, "complete", partition_by=["symbol"])
    assert totals(sinks.latest_epoch(spark, str(tmp_path / "table"))) == {("A", 0): (10.0, 1), ("B", 0): (4.0, 1)}


def test_trades_go_through_the_same_job(spark, topic, tmp_path):
    topic.put({"c": "x", "p": 2.0, "s": "BTC", "t": 1704067260000, "v": 0.5}, {"c": "x", "p": 4.0, "s": "BTC", "t": 1704067320000, "v": 1.5})
    run(spark, topic, tmp_path, "complete", datasource="crypto_stream")
    got = sinks.latest_epoch(spark, str(tmp_path / "table")).first()
    assert (got.symbol, got.avg_price, got.total_volume, got.window_start) == ("BTC", 3.0, 2.0, datetime.datetime(2024, 1, 1))


KYC = {"event": "kyc", "request_id": "r", "user_id": "u", "doc_s3_path": "d", "face_s3_path": "f", "upload_time": "t", "status": "pending"}


def test_scoring_fans_out_the_same_answers(spark, topic, tmp_path):
    topic.put(KYC, {**KYC, "request_id": "same", "face_s3_path": "d"}, {**KYC, "request_id": "nobody", "user_id": None}, "broken")
    outputs = [sinks.message_sink(str(tmp_path / "out")), sinks.table_sink(str(tmp_path / "scored"))]
    for _ in range(2):
        jobs.score_topic(topic.stream(spark), outputs, str(tmp_path / "cp"), available_now=True).awaitTermination()
    table = {r.request_id: r.is_fraud for r in spark.read.parquet(str(tmp_path / "scored")).collect()}
    messages = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert table == {"r": False, "same": True, "nobody": True}
    assert {m.get("request_id"): m["is_fraud"] for m in messages} == table and len(messages) == 3
    # Nothing is dropped in silence: what can't be read lies beside the checkpoint unless it is given a place.
    assert [r.value for r in spark.read.parquet(jobs.rejects_path(str(tmp_path / "cp"))).collect()] == ["broken"]
    kept = []
    jobs.score_topic(
        topic.stream(spark), outputs, str(tmp_path / "cp2"), available_now=True,
        rejects=lambda batch, epoch: kept.extend(r.value for r in batch.collect()),
    ).awaitTermination()
    assert kept == ["broken"]


def test_console_and_random_flag(spark, topic):
    topic.put(KYC)
    flagged = scoring.flag_at_random(feeds.parse_messages(topic.stream(spark), schemas.KYC_EVENT), seed=1)
    handle = sinks.to_console(flagged)
    handle.processAllAvailable()
    handle.stop()
    shares = scoring.flag_at_random(spark.range(2000), 0.5, seed=3).groupBy("is_fraud").count()
    assert all(800 < r["count"] < 1200 for r in shares.collect())


def test_dead_letters(spark):
    df = spark.createDataFrame([('{"symbol": "A"}',), ("oops",), ('{"other": 1}',)], "value STRING")
    assert sorted(r.value for r in feeds.dead_letters(df, "symbol STRING, volume BIGINT").collect()) == ["oops", '{"other": 1}']


def test_mixed_topic(spark, rows):
    pdf = {"event": "pdf", "request_id": "p", "user_id": "u", "s3_path": "x.pdf", "upload_time": "t"}
    tx = {"event": "user_transaction", "transaction_id": "t", "user_id": "u", "amount": 12.5, "status": "hidden"}
    df = spark.createDataFrame([(json.dumps(m),) for m in (KYC, pdf, tx, {"event": "other"})], "value STRING")
    wide = feeds.dispatch_events(df, schemas.EVENTS)
    assert rows(wide, "event", "request_id", "s3_path", "transaction_id", "status") == [
        ("kyc", "r", None, None, "pending"), ("pdf", "p", "x.pdf", None, None), ("user_transaction", None, None, "t", None)
    ]
    branch = feeds.typed_branch(df, "pdf", schemas.PDF_EVENT)
    assert rows(branch, "request_id", "s3_path") == [("p", "x.pdf")] and branch.columns == schemas.parse_ddl(schemas.PDF_EVENT).names
    with pytest.raises(ValueError):
        feeds.dispatch_events(df, {"a": "event STRING, x INT", "b": "event STRING, x STRING"})


def test_messages_round_trip(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n INT, s STRING")
    assert rows(feeds.parse_messages(feeds.as_messages(df), "n INT, s STRING")) == rows(df)


def test_sliding_windows(spark):
    df = spark.sql("SELECT 'A' AS symbol, timestamp'2024-01-01 00:07:00' AS timestamp, 1.0D AS current_price, 2L AS volume")
    assert aggregates.window_totals(df, "10 minutes", slide="5 minutes").count() == 2


def test_kafka_is_a_parameter(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        feeds.read_topics(spark, "localhost:9092", ["a", "b"])


def test_no_python_in_scoring(spark):
    from conftest import plan_of

    df = spark.createDataFrame([tuple(KYC.values())], schemas.KYC_EVENT)
    plan = plan_of(scoring.score_events(df, scoring.KYC_RULES, 0.5).select(F.to_json(F.struct("*"))))
    assert "Python" not in plan and "Exchange" not in plan
