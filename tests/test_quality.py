import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import plan_of
from zonelake.operators import quality, stats, windows
from zonelake.sources import schemas

ID = "123e4567-e89b-12d3-a456-4266141740{:02d}"
GOOD = dict(
    transaction_id=ID.format(0), user_id="AC00001", timestamp=datetime.datetime(2024, 1, 1), type="Debit",
    amount=Decimal(10), currency="EUR", description="M001 - Online", location="Oslo", device_id="D000001",
    ip_address="10.0.0.1", account_balance=Decimal(100), previous_transaction="2024-01-01 10:00:00",
    transaction_duration=60, login_attempts=1,
)


def transactions(spark, *changes):
    rows = [tuple({**GOOD, "transaction_id": ID.format(i), **change}.values()) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, schemas.TRANSACTION)


def outcome(df, suite, by=()):
    return {r.rule: r.unexpected for r in quality.evaluate(df, suite, by).collect()}


def test_good_transactions_pass(spark):
    results = quality.evaluate(transactions(spark, {}, {}), quality.TRANSACTIONS)
    assert results.filter("NOT success").isEmpty()
    assert quality.batch_verdict(results).first().success


def test_one_violation_per_rule(spark):
    broken = {
        "matches:transaction_id": {"transaction_id": "ABC"}, "not_null:timestamp": {"timestamp": None},
        "in_set:type": {"type": "Transfer"}, "not_null:amount": {"amount": None}, "between:amount": {"amount": Decimal(-1)},
        "not_null:currency": {"currency": None}, "matches:currency": {"currency": "eur"},
        "matches:description": {"description": "online"}, "not_null:location": {"location": None},
        "not_null:device_id": {"device_id": None}, "matches:device_id": {"device_id": "X1"},
        "matches:ip_address": {"ip_address": "localhost"}, "not_null:account_balance": {"account_balance": None},
        "between:account_balance": {"account_balance": Decimal(10**9)},
        "matches:previous_transaction": {"previous_transaction": "yesterday"},
        "between:transaction_duration": {"transaction_duration": 100000}, "between:login_attempts": {"login_attempts": 11},
    }
    got = outcome(transactions(spark, {}, *broken.values()), quality.TRANSACTIONS)
    assert {rule for rule, n in got.items() if n} == set(broken)
    assert all(n in (0, 1) for n in got.values())


def test_null_breaks_only_not_null(spark):
    nulls = {c: None for c in ("type", "description", "ip_address", "previous_transaction", "transaction_duration", "login_attempts")}
    assert not any(outcome(transactions(spark, nulls), quality.TRANSACTIONS).values())


def test_duplicate_ids(spark):
    got = outcome(transactions(spark, {}, {"transaction_id": ID.format(0)}, {}), quality.TRANSACTIONS)
    assert got["unique:transaction_id"] == 2


def test_category_outside_the_set_fails_the_batch(spark):
    moment = datetime.datetime(2024, 1, 1)
    path = "s3a://unstructureddata/pdfs/{}.pdf"
    df = spark.createDataFrame(
        [(ID.format(i), "AC00001", c, path.format(i), moment) for i, c in enumerate(["contract", "invoice"])], schemas.PDF_UPLOAD
    )
    verdict = quality.batch_verdict(quality.evaluate(df, quality.PDF_UPLOADS)).first()
    assert not verdict.success and verdict.failed_rules == ["in_set:category"]


def test_distinct_within_record(spark):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (None, None), (None, "y")], "a INT, b STRING")
    suite = quality.Suite("s", (quality.DistinctWithinRecord(("a", "b")),))
    assert outcome(df, suite) == {"distinct_within_record:a,b": 1}


def test_results_per_batch_equal_brute_force(spark):
    data = [("x", 1, 1.0), ("x", 2, -1.0), ("y", 1, None), ("y", 1, 5.0), ("y", 3, 2.0)]
    df = spark.createDataFrame(data, "b STRING, k INT, v DOUBLE")
    suite = quality.Suite("s", (quality.NotNull("v"), quality.Between("v", 0, 4), quality.unique("k"), quality.Increasing("v", ("k",))))
    got = {(r.b, r.rule): (r.n, r.unexpected) for r in quality.evaluate(df, suite, ["b"]).collect()}
    assert got == {
        ("x", "not_null:v"): (2, 0), ("y", "not_null:v"): (3, 1), ("x", "between:v"): (2, 1), ("y", "between:v"): (3, 1),
        ("x", "unique:k"): (2, 0), ("y", "unique:k"): (3, 2), ("x", "increasing:v"): (2, 1), ("y", "increasing:v"): (2, 1),
    }


def test_row_rules_share_one_aggregation(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    suite = quality.Suite("s", (quality.NotNull("id"), quality.Between("v", 0, 9), quality.InSet("id", (1, 2))))
    plan = plan_of(quality.evaluate(df, suite))
    assert plan.count("Range (0, 10") == 1 and "Python" not in plan


def test_empty_input(spark):
    got = outcome(transactions(spark, {}).limit(0), quality.TRANSACTIONS)
    assert len(got) == len(quality.TRANSACTIONS.rules) and not any(got.values())


def test_split_is_complete(spark):
    df = transactions(spark, {}, {"amount": None}, {"type": "?", "amount": None}, {})
    valid, invalid = quality.split_rows(df, quality.TRANSACTIONS)
    assert valid.count() + invalid.count() == df.count() == 4
    assert sorted(map(len, (r.failed_rules for r in invalid.collect()))) == [1, 2]


def test_order_violations_over_range_ends(spark):
    values = [i if i % 7 else i - 3 for i in range(500)]  # every seventh value falls back
    df = spark.createDataFrame(list(enumerate(values)), "i INT, v INT").repartition(5)
    expected = sum(b <= a for a, b in zip(values, values[1:]))
    assert windows.order_violations(df, "v", ["i"]).first() == (500, expected)
    constant = spark.range(50).withColumn("v", F.lit(1))
    assert windows.order_violations(constant, "v", ["id"], strict=False).first() == (50, 0)
    assert windows.order_violations(constant, "v", ["id"]).first() == (50, 49)


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "n INT, s STRING")
    expected = [("t", "n", "int", 3, 0, 2), ("t", "s", "string", 3, 1, 1)]
    assert rows(stats.column_profile(df, table="t")) == expected
    assert rows(stats.column_profile(df, table="t", exact=False)) == expected


def test_profile_goes_on_after_a_bad_table(spark):
    spark.range(3).createOrReplaceTempView("three")
    profile, problems = stats.profile_tables(spark, ["three", "missing_table"])
    assert [(r.table, r.rows) for r in profile.collect()] == [("three", 3)] and list(problems) == ["missing_table"]
    assert stats.profile_tables(spark, ["missing_table"])[0] is None
    assert stats.sample_rows(spark.table("three"), 2).count() == 2 and '"id"' in stats.schema_tree(spark.table("three"))
    spark.catalog.dropTempView("three")


def test_max_value(spark):
    df = spark.createDataFrame([(1, [1])], "n INT, a ARRAY<INT>")
    assert stats.max_value(df, "n").first() == (1,)
    assert stats.max_value(df, "a") is None and stats.max_value(df, "z") is None and stats.max_value(None, "n") is None
