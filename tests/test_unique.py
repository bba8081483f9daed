"""Unique tables: no exchange on the history, batches visible at once, repeated batches harmless."""

import os

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from zonelake.sources.manifests import Manifests
from zonelake.sources.unique import UniqueTable

SCHEMA = "a INT, b STRING, v INT"


@pytest.fixture
def table(spark, tmp_path):
    return UniqueTable(spark, str(tmp_path / "t"), ["a", "b"], 4)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_insert_if_absent_with_null_keys(spark, table):
    assert table.insert(frame(spark, (1, "x", 2), (1, "x", 1), (2, None, 3), (None, None, 4)), "b1", ["v"])
    assert table.insert(frame(spark, (1, "x", 9), (2, None, 9), (2, "y", 5), (None, "x", 6), (None, None, 9)), "b2", ["v"])
    assert not table.insert(frame(spark, (7, "z", 7)), "b2")
    want = [(1, "x", 1), (2, None, 3), (None, None, 4), (2, "y", 5), (None, "x", 6)]
    assert content(table) == sorted(want, key=str) and table.batches() == ["b1", "b2"]
    table.compact_index()
    assert table.insert(frame(spark, (1, "x", 8), (3, None, 8)), "b3")
    assert content(table) == sorted([*want, (3, None, 8)], key=str) and table.batches() == ["b1", "b2", "b3"]
    again = UniqueTable(spark, table.path, ["a", "b"], 99)
    assert again.buckets == 4 and content(again) == content(table)
    with pytest.raises(ValueError, match="keys of this table"):
        UniqueTable(spark, table.path, ["a"])


def test_history_is_not_shuffled(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.insert(frame(spark, *[(i, "x", i) for i in range(100)]), "b1")
        table.insert(frame(spark, *[(i, "x", i) for i in range(50, 150)]), "b2")
        plan = plan_of(table.absent(frame(spark, (1, "x", 1), (500, "x", 1))))
        lines = plan.splitlines()
        join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
        assert len(exchanges) == 1 and join < exchanges[0] < scan and "Bucketed: true" in plan
        assert not any("Exchange" in line for line in lines[scan - 3 : scan]) and "hashpartitioning(_key" in lines[exchanges[0]]
        assert table.absent(frame(spark, (1, "x", 1), (500, "x", 1))).count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_one_row_of_the_index(spark, table):
    hot = spark.range(3000).select(F.lit(1).alias("a"), F.lit("x").alias("b"), F.col("id").cast("int").alias("v"))
    for batch in ("b1", "b2"):
        table.insert(hot, batch, ["v"])
    keys = spark.read.parquet(f"{table.path}/keys")
    assert keys.count() == 1 and content(table) == [(1, "x", 0)]


def test_a_crash_publishes_nothing(spark, table, monkeypatch):
    table.insert(frame(spark, (1, "x", 1)), "b1")
    for method in ("_write_keys", "_publish"):
        with monkeypatch.context() as m:
            m.setattr(UniqueTable, method, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                table.insert(frame(spark, (1, "x", 2), (2, "y", 2)), "b2")
        assert content(table) == [(1, "x", 1)]
    assert table.insert(frame(spark, (3, "z", 3)), "b3")  # the keys of b2 don't count
    assert table.insert(frame(spark, (1, "x", 2), (2, "y", 2), (3, "z", 4)), "b2")
    assert content(table) == [(1, "x", 1), (2, "y", 2), (3, "z", 3)]


def test_columns_may_be_added(spark, table):
    table.insert(frame(spark, (1, "x", 1)), "b1")
    table.insert(frame(spark, (2, "x", 1)).withColumn("more", F.lit(True)), "b2")
    assert content(table) == [(1, "x", 1, None), (2, "x", 1, True)]
    assert Manifests(spark, table.path).numbers() == [0, 1] and os.path.isdir(f"{table.path}/data/batch=b2")
