from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from conftest import plan_of
from zonelake.operators import dedup, filters
from zonelake.plans import ingest
from zonelake.sources import sinks

SCHEMA = "k STRING, g INT, t INT"


def test_first_and_last(spark, rows):
    df = spark.createDataFrame([("a", 1, 3), ("a", 1, 1), ("b", 1, 2), (None, 1, 5), (None, 1, 4)], SCHEMA)
    assert rows(dedup.keep_one(df, ["k"], ["t"])) == [(None, 1, 4), ("a", 1, 1), ("b", 1, 2)]
    assert rows(dedup.keep_one(df, ["k"], ["t"], "last")) == [(None, 1, 5), ("a", 1, 3), ("b", 1, 2)]
    assert dedup.keep_one(df, ["k"]).count() == 3


def test_null_keys_against_history(spark, rows):
    batch = spark.createDataFrame([("a", 1, 1), (None, 1, 1), (None, None, 1), ("b", None, 1)], SCHEMA)
    history = spark.createDataFrame([(None, 1, 0), ("b", None, 0), ("z", 9, 0)], SCHEMA)
    assert rows(dedup.exclude_existing(batch, history, ["k", "g"])) == [(None, None, 1), ("a", 1, 1)]
    assert dedup.exclude_existing(batch, history, ["k", "g"], null_safe=False).count() == 4


def test_null_safe_in_shuffled_join(spark, rows):
    """The same result when the join cannot broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.createDataFrame([("a", 1, 1), (None, 1, 1), (None, None, 1), ("b", None, 1)], SCHEMA)
        history = spark.createDataFrame([(None, 1, 0), ("b", None, 0)], SCHEMA)
        result = dedup.deduplicate(batch, ["k", "g"], history, ["t"])
        assert rows(result) == [(None, None, 1), ("a", 1, 1)]
        plan = plan_of(result)
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2  # one per side
        assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_pruning_keeps_the_result(spark, rows):
    batch = spark.createDataFrame([("a", 5, 1), ("b", 7, 1)], SCHEMA)
    history = spark.createDataFrame([("a", 5, 0), ("b", 700, 0)], SCHEMA)
    assert rows(dedup.deduplicate(batch, ["k", "g"], history, range_column="g")) == [("b", 7, 1)]


def test_counts(spark):
    before, after = Observation("before"), Observation("after")
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], SCHEMA)
    dedup.deduplicate(df, ["k"], order_by=["t"], counts=(before, after)).collect()
    assert (before.get["rows"], after.get["rows"]) == (2, 1)


def test_insert_if_absent_is_idempotent(spark, rows):
    target = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    batch = spark.createDataFrame([("a", 2, 2), ("c", 1, 1), ("c", 2, 2)], SCHEMA)
    new = dedup.rows_to_insert(batch, target, ["k"], ["t"])
    assert rows(new) == [("c", 1, 1)]
    assert dedup.rows_to_insert(batch, target.unionByName(new), ["k"], ["t"]).isEmpty()


def test_exists_flag(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k STRING")
    probe = spark.createDataFrame([("a",), ("a",), (None,)], "k STRING")
    assert rows(dedup.with_exists_flag(df, probe, ["k"])) == [(None, False), ("a", True), ("b", False)]
    assert not dedup.with_exists_flag(df, None, ["k"]).filter("exists").count()


def test_split_by_membership_keeps_null_rows(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k STRING")
    inside, outside = filters.split_by_membership(df, spark.createDataFrame([("a",), (None,)], "m STRING"), "k")
    assert rows(inside) == [("a",)] and rows(outside) == [(None,), ("b",)]
    members = spark.createDataFrame([("a",), ("a",), (None,)], "m STRING")
    assert rows(filters.flag_membership(df, members, "k")) == [(None, False), ("a", True), ("b", False)]


def test_pending_rows(spark, rows):
    source = spark.createDataFrame([(1, "pending"), (2, "exported"), (3, None), (4, "approved")], "id INT, status STRING")
    assert rows(ingest.pending_rows(source, ["id"], "id")) == [(1,), (4,)]
    done = spark.createDataFrame([(4,)], "id INT")
    assert rows(ingest.pending_rows(source, ["id"], "id", done)) == [(1,)]


def test_pending_of_missing_and_present_table(spark, rows):
    users = next(e for e in ingest.EXTRACTS if e.source == "users")
    assert ingest.pending_of_table(spark, users).isEmpty()
    spark.createDataFrame([("u1", 30, "clerk", "pending")], "user_id STRING, age BIGINT, occupation STRING, status STRING").createOrReplaceTempView("users")
    assert rows(ingest.pending_of_table(spark, users)) == [("u1", 30, "clerk")]
    spark.catalog.dropTempView("users")
    assert ingest.pending_query(users) == "SELECT user_id, age, occupation FROM users WHERE status <> 'exported'"


def test_exported_ids_are_left_out_next_time(spark, rows, tmp_path):
    ledger = str(tmp_path / "exported")
    source = spark.createDataFrame([(1, "pending"), (2, "pending")], "id INT, status STRING")
    sinks.mark_rows_exported(ingest.pending_rows(source, ["id"], "id").filter("id = 1"), ledger)
    assert rows(ingest.pending_rows(source, ["id"], "id", spark.read.parquet(ledger))) == [(2,)]


KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
ROW = st.tuples(KEY, st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 5))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=12), st.lists(ROW, min_size=1, max_size=6))
def test_against_brute_force(spark, batch, history):
    seen = {(k, g) for k, g, _ in history}
    expected = {}
    for k, g, t in batch:
        if (k, g) not in seen:
            expected[k, g] = min(t, expected.get((k, g), t))
    got = dedup.deduplicate(
        spark.createDataFrame(batch, SCHEMA), ["k", "g"], spark.createDataFrame(history, SCHEMA), ["t"]
    ).collect()
    assert len(got) == len(expected) and {(r.k, r.g): r.t for r in got} == expected
