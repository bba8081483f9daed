"""Topics of landed files: positions, restarts, repeated and failed batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from zonelake.streaming import feeds, sinks, topics


def messages(spark, low, high, partitions=3):
    numbers = spark.range(low, high, 1, 4)
    return numbers.select(F.col("id").cast("string").alias("value"), (F.col("id") % partitions).cast("int").alias("partition"))


def table_of(spark, folder):
    return sorted((r.topic, r.partition, r.offset, r.value) for r in spark.read.parquet(folder).collect())


def keep(spark, root, names, folder, starting="earliest"):
    stream = topics.stream_topics(spark, str(root), names, starting)
    sinks.to_table(stream, f"{folder}/out", f"{folder}/cp", "append", available_now=True).awaitTermination()


def test_offsets_are_whole_and_in_order(spark, tmp_path):
    root = str(tmp_path)
    topics.append_to_topic(messages(spark, 0, 100), f"{root}/a", 3)
    topics.append_to_topic(messages(spark, 100, 130), f"{root}/a", 3)
    rows = topics.read_topics(spark, root, ["a"]).collect()
    for p in range(3):
        mine = sorted((r.offset, int(r.value)) for r in rows if r.partition == p)
        assert [o for o, _ in mine] == list(range(len(mine))) and {v % 3 for _, v in mine} == {p}
        assert all(v < 100 for o, v in mine if o < 33) and [v for _, v in mine] == sorted(v for _, v in mine)
    ranged = topics.read_topics(spark, root, ["a"], {"a": {"0": 30, "1": 33, "2": -1}}, {"a": {"0": 35, "1": 33}})
    assert sorted((r.partition, r.offset) for r in ranged.collect()) == [(0, o) for o in range(30, 35)]


def test_small_tasks_read_the_same(spark, tmp_path):
    topics.append_to_topic(messages(spark, 0, 200), f"{tmp_path}/a", 3)
    whole = topics.read_topics(spark, str(tmp_path), ["a"])
    cut = spark.read.format("topic_log").option("path", str(tmp_path)).option("subscribe", "a").option("taskRows", 7).load()
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect())) and cut.rdd.getNumPartitions() == 30


def test_restarts_lose_and_repeat_nothing(spark, tmp_path):
    root, folder = tmp_path / "topics", str(tmp_path / "reader")
    topics.append_to_topic(messages(spark, 0, 10), f"{root}/a", 3)
    topics.append_to_topic(messages(spark, 0, 5), f"{root}/b", 3)
    keep(spark, root, ["a", "b"], folder)
    topics.append_to_topic(messages(spark, 10, 30), f"{root}/a", 3)
    keep(spark, root, ["a", "b"], folder)
    keep(spark, root, ["a", "b"], folder)
    everything = sorted((r.topic, r.partition, r.offset, r.value) for r in topics.read_topics(spark, str(root), ["a", "b"]).collect())
    assert table_of(spark, f"{folder}/out") == everything and len(everything) == 35


def test_stream_starts_where_it_is_told(spark, tmp_path):
    root = tmp_path / "topics"
    topics.append_to_topic(messages(spark, 0, 30), f"{root}/a", 3)
    keep(spark, root, ["a"], str(tmp_path / "given"), {"a": {"0": 8, "1": 10, "2": -2}})
    assert [(p, o) for _, p, o, _ in table_of(spark, f"{tmp_path}/given/out")] == [(0, 8), (0, 9), *[(2, o) for o in range(10)]]
    keep(spark, root, ["a"], str(tmp_path / "late"), "latest")
    topics.append_to_topic(messages(spark, 30, 33), f"{root}/a", 3)
    keep(spark, root, ["a"], str(tmp_path / "late"), "latest")
    assert [r[1:3] for r in table_of(spark, f"{tmp_path}/late/out")] == [(0, 10), (1, 10), (2, 10)]


def newest(folder):
    return max(int(f) for f in os.listdir(folder) if f.isdigit())


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    source, target, cp = tmp_path / "in", f"{tmp_path}/out/copy", str(tmp_path / "cp")

    def copy():
        stream = topics.stream_topics(spark, str(source), ["a"], "earliest").select("value", "partition")
        topics.to_topic_log(stream, target, cp, "copier", 3, available_now=True).awaitTermination()

    topics.append_to_topic(messages(spark, 0, 9), f"{source}/a", 3)
    copy()
    topics.append_to_topic(messages(spark, 9, 12), f"{source}/a", 3)
    copy()
    # As after a crash between the topic's commit and the query's: the query repeats its last batch.
    os.remove(f"{cp}/commits/{newest(cp + '/commits')}")
    for name in os.listdir(f"{cp}/commits"):
        if name.startswith("."):
            os.remove(f"{cp}/commits/{name}")
    copy()
    rows = topics.read_topics(spark, f"{tmp_path}/out", ["copy"]).collect()
    assert sorted(int(r.value) for r in rows) == list(range(12)) and len({(r.partition, r.offset) for r in rows}) == 12
    named = {s["file"] for n in topics.Log(target).entries() for s in topics.Log(target).entry(n)["segments"]}
    there = {os.path.relpath(os.path.join(d, f), target) for d, _, fs in os.walk(f"{target}/data") for f in fs if f.endswith(".parquet")}
    assert named == there


def test_a_failed_batch_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/a"
    with pytest.raises(Exception, match="outside 0 to 1"):
        topics.append_to_topic(messages(spark, 0, 30, 3), path, 2)
    assert topics.read_topics(spark, str(tmp_path), ["a"]).count() == 0
    topics.append_to_topic(messages(spark, 0, 30, 2), path, 2)
    assert topics.read_topics(spark, str(tmp_path), ["a"]).count() == 30
    with pytest.raises(Exception, match="only added to"):
        spark.range(1).select(F.lit("x").alias("value")).write.format("topic_log").mode("overwrite").option("path", path).save()


def test_keys_decide_the_partition(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i % 5}", f"v{i}") for i in range(50)] + [(None, "x")], "key STRING, value STRING")
    topics.append_to_topic(df, f"{tmp_path}/a", 4)
    by_key = {}
    for r in topics.read_topics(spark, str(tmp_path), ["a"]).collect():
        by_key.setdefault(r.key, set()).add(r.partition)
    assert len(by_key) == 6 and all(len(p) == 1 for p in by_key.values())


def test_topic_in_topic_out(spark, tmp_path):
    """Scored messages go to a topic beside a table; positions are checked against unknown topics."""
    topics.append_to_topic(spark.createDataFrame([(json.dumps({"n": n}),) for n in range(5)], "value STRING"), f"{tmp_path}/in", 1)
    stream = feeds.parse_messages(topics.stream_topics(spark, str(tmp_path), ["in"], "earliest"), "n INT")
    sends = [topics.topic_log_sink(f"{tmp_path}/doubled", "doubler"), sinks.table_sink(f"{tmp_path}/table")]
    sinks.fan_out(stream.withColumn("twice", F.col("n") * 2), sends, f"{tmp_path}/cp", available_now=True).awaitTermination()
    out = feeds.parse_messages(topics.read_topics(spark, str(tmp_path), ["doubled"]), "n INT, twice INT")
    assert sorted(map(tuple, out.collect())) == [(n, 2 * n) for n in range(5)]
    with pytest.raises(Exception, match="not read"):
        topics.read_topics(spark, str(tmp_path), ["in"], {"other": {"0": 1}}).count()
