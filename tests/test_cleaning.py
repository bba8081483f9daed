from pyspark.sql import functions as F

from conftest import plan_of
from zonelake.functions import cleaning, maps


def test_normalise_text(spark, rows):
    df = spark.createDataFrame([("Hello, World! é_1",), ("¡¿?",), (None,)], "t STRING")
    assert rows(cleaning.normalise_text(df, ["t"])) == [(None,), ("",), ("hello world _1",)]
    assert rows(cleaning.normalise_text(df, ["t"], r"(?U)[\w\s]+"))[2] == ("hello world é_1",)


def test_unwrap_opens_nested_wrappers_only(spark):
    df = spark.sql("SELECT named_struct('response', named_struct('result', named_struct('a', 1, 'data', 'text'))) AS data")
    assert cleaning.unwrap(df).columns == ["a", "data"]
    assert cleaning.unwrap(spark.range(1)).columns == ["id"]


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', named_struct('y.z', 2), 'w', array(3)) AS s")
    assert cleaning.flatten(df).columns == ["id", "s.x.y.z", "s.w"] and cleaning.flatten(df).first() == (1, 2, [3])
    assert cleaning.flatten(df, "_").columns == ["id", "s_x_y.z", "s_w"]
    assert cleaning.flatten_one_level(df).columns == ["id", "s_x", "s_w"]


def test_null_empty(spark):
    df = spark.sql("SELECT '' AS a, array() AS b, map() AS c, 'x' AS d, array(1) AS e, 0 AS f")
    assert cleaning.null_empty(df).first() == (None, None, None, "x", [1], 0)


def test_times(spark, rows):
    df = spark.createDataFrame([("2024-01-02", "x"), ("soon", "y"), (None, "z")], "event_date STRING, other STRING")
    assert rows(cleaning.normalise_times(df), "event_date") == [(None,), ("2024-01-02T00:00:00",), ("soon",)]
    assert cleaning.valid_time(df, "event_date").count() == 1


def test_filters(spark, rows):
    df = spark.createDataFrame([(-1,), (0,), (119,), (120,), (None,)], "age INT")
    assert rows(cleaning.valid_age(df)) == [(0,), (119,)]
    assert cleaning.non_negative(df, "age").count() == 3 and cleaning.require(df, ["age"]).count() == 4
    assert rows(cleaning.fill_defaults(df, {"age": 7}).filter("age = 7")) == [(7,)]
    texts = spark.createDataFrame([(" ab ",), ("abc",)], "t STRING")
    assert rows(cleaning.min_length(cleaning.trim_text(texts, ["t"]), "t")) == [("abc",)]


def test_enforce_types_under_ansi(spark):
    df = spark.createDataFrame([("1", "x")], "a STRING, b STRING")
    assert cleaning.enforce_types(df, {"a": "int", "b": "int"}).first() == (1, None)


def test_lookup(spark, rows):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k STRING")
    table = spark.createDataFrame([("a", 1)], "key STRING, value INT")
    for mapping in ({"a": 1}, table):
        assert rows(cleaning.lookup(df, "k", mapping, "v")) == [(None, None), ("a", 1), ("z", None)]


def test_computed_once(spark, rows):
    df = spark.range(5).withColumn("t", F.upper(F.concat(F.lit("v"), "id")))
    kept = cleaning.computed_once(df, ["t"]).filter("t > 'V2'")
    assert kept.columns == ["id", "t"] and rows(kept) == [(3, "V3"), (4, "V4")]
    assert plan_of(kept).count("upper") == 1


def test_arrays(spark, rows):
    df = spark.sql("SELECT 1 AS id, array('x', 'y') AS a UNION ALL SELECT 2, array() UNION ALL SELECT 3, NULL")
    assert rows(maps.array_to_rows(df, "a", "v"), "id", "v") == [(1, "x"), (1, "y"), (2, None), (3, None)]
    assert rows(maps.array_to_indexed_rows(df, "a"), "id", "idx", "val") == [(1, 0, "x"), (1, 1, "y")]
    m = spark.sql("SELECT 1 AS id, map('k', 2) AS m UNION ALL SELECT 2, map()")
    assert rows(maps.map_to_rows(m, "m", "k", "v", outer=True), "id", "k", "v") == [(1, "k", 2), (2, None, None)]
