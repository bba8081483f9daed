"""Update mode: equal to the batch result after every restart, folders bounded, repeated batches harmless."""

import os

import pytest
from pyspark.sql import functions as F
from test_streaming import Topic, quote, totals

from zonelake.sources import schemas
from zonelake.sources.manifests import Manifests
from zonelake.streaming import aggregates, feeds, jobs, sinks, upserts


def part_files(folder):
    return sum(f.endswith(".parquet") for _, _, files in os.walk(folder) for f in files)


def test_update_equals_batch_after_every_restart(spark, tmp_path):
    topic, table = Topic(tmp_path / "topic"), str(tmp_path / "table")

    def run():
        jobs.aggregate_quotes(
            topic.stream(spark), table, str(tmp_path / "cp"), window="5 minutes", mode="update", watermark="1 hour", available_now=True
        ).awaitTermination()

    files = []
    for n in range(6):
        topic.put(quote("A", 1, float(n)), quote("A", 10 + n, 1.0), quote(None, 3, 2.0), quote("B", 5 * n, 1.0))
        run()
        run()
        batch = feeds.parse_messages(spark.read.text(str(topic.folder)), schemas.get_schema("stock_stream"))
        assert totals(upserts.read_upserts(spark, table)) == totals(aggregates.window_totals(batch, "5 minutes"))
        files.append(part_files(f"{table}/data"))
    assert max(files) <= 8 and len(Manifests(spark, table).numbers()) == upserts.KEEP
    with pytest.raises(ValueError, match="parts by day"):
        jobs.aggregate_quotes(topic.stream(spark), table, "x", mode="update", partition_by=["symbol"])


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    table = str(tmp_path / "t")
    sink = upserts.upsert_sink(table, ["day", "k"], F.col("day"))
    rows = lambda *r: spark.createDataFrame(list(r), "day STRING, k INT, v STRING")
    sink(rows(("1/1", 1, "a"), ("1/1", 2, "b"), ("1/2", 1, "c"), (None, 1, "d")), 0)
    first = Manifests(spark, table).newest()["parts"]
    sink(rows(("1/2", 1, "C"), ("1/2", 3, "e"), (None, 1, "D")), 1)
    second = Manifests(spark, table).newest()["parts"]
    assert second["1_1"] == first["1_1"] and second["1_2"] != first["1_2"] and set(second) == {"1_1", "1_2", "none"}
    want = [("1/1", 1, "a"), ("1/1", 2, "b"), ("1/2", 1, "C"), ("1/2", 3, "e"), (None, 1, "D")]
    assert sorted(map(tuple, upserts.read_upserts(spark, table).collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, upserts.read_upserts(spark, table, ["1_2"]).collect())) == [("1/2", 1, "C"), ("1/2", 3, "e")]


def test_crash_before_and_after_the_manifest(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    sink = upserts.upsert_sink(table, ["k"])
    rows = lambda *r: spark.createDataFrame(list(r), "k INT, v INT")
    sink(rows((1, 1), (2, 2)), 0)
    with monkeypatch.context() as m:
        m.setattr(Manifests, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sink(rows((1, 10), (3, 3)), 1)
    assert sorted(map(tuple, upserts.read_upserts(spark, table).collect())) == [(1, 1), (2, 2)]
    for _ in range(2):  # the second time the manifest is there
        sink(rows((1, 10), (3, 3)), 1)
        assert sorted(map(tuple, upserts.read_upserts(spark, table).collect())) == [(1, 10), (2, 2), (3, 3)]
    sink(rows().limit(0), 2)
    assert Manifests(spark, table).newest()["number"] == 1


def test_new_columns_and_several_rows_of_a_key(spark, tmp_path):
    table = str(tmp_path / "t")
    sink = upserts.upsert_sink(table, ["k"], order_by=["at"])
    sink(spark.createDataFrame([(1, 5, "old"), (1, 7, "new"), (2, 1, "x")], "k INT, at INT, v STRING"), 0)
    sink(spark.createDataFrame([(2, 0, "y", True)], "k INT, at INT, v STRING, more BOOLEAN"), 1)
    assert sorted(map(tuple, upserts.read_upserts(spark, table).collect())) == [(1, 7, "new", None), (2, 0, "y", True)]
    with pytest.raises(FileNotFoundError):
        upserts.read_upserts(spark, f"{table}_none")


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    from conftest import plan_of

    df = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    plan = plan_of(upserts.merge_batch(df, df, ["k"]))
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


def test_complete_epochs_are_bounded(spark, tmp_path):
    topic, table = Topic(tmp_path / "topic"), str(tmp_path / "table")
    for n in range(5):
        topic.put(quote("A", n, 1.0))
    jobs.aggregate_quotes(topic.stream(spark), table, str(tmp_path / "cp"), window="5 minutes", available_now=True).awaitTermination()
    assert len([n for n in os.listdir(table) if n.startswith(sinks.EPOCH)]) == 2
    assert totals(sinks.latest_epoch(spark, table)) == {("A", 0): (1.0, 5)}
