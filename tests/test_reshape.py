import datetime
import json

import pytest
from pyspark.sql import functions as F

from zonelake.functions import maps
from zonelake.operators import reshape
from zonelake.sources import readers


def rates_document(series):
    axis = ["2024-01-01", "2024-01-02", "2024-01-03"]
    ids = lambda names: [{"values": [{"id": n} for n in names]}]
    return {
        "dataSets": [{"series": {key: {"observations": obs} for key, obs in series.items()}}],
        "structure": {"dimensions": {"series": ids(["D"]) + ids(["USD", "JPY"]), "observation": ids(axis)}},
    }


def test_rates_missing_key_gives_no_row_and_null_gives_null(spark, tmp_path, rows):
    document = rates_document({
        "0:0:0:0:0": {"0": [1.1, 0], "1": [1.2, 0], "2": [1.3, 0]},
        "0:1:0:0:0": {"0": [150.0, 0], "2": [None, 0], "9": [1.0, 0]},
        "0:7:0:0:0": {"0": [5.0]},
    })
    path = str(tmp_path / "rates")
    readers.land_api_payload(spark, document, path)
    long = reshape.rates_to_long(readers.read_landed_payloads(spark, path, reshape.RATES_SCHEMA))
    day = lambda d: datetime.datetime(2024, 1, d)
    assert long.dtypes == [("time", "timestamp"), ("currency", "string"), ("rate", "double")]
    assert set(map(tuple, long.collect())) == {
        (day(1), "USD", 1.1), (day(2), "USD", 1.2), (day(3), "USD", 1.3),
        (day(1), "JPY", 150.0), (day(3), "JPY", None), (day(1), None, 5.0),
    }


def test_rates_documents_do_not_mix(spark, tmp_path):
    path = str(tmp_path / "two")
    one, two = rates_document({"0:0:0:0:0": {"0": [1.0]}}), rates_document({"0:1:0:0:0": {"1": [2.0]}})
    readers.land_api_payload(spark, [one, two], path)
    long = reshape.rates_to_long(readers.read_landed_payloads(spark, path, reshape.RATES_SCHEMA))
    assert {(r.currency, r.rate) for r in long.collect()} == {("USD", 1.0), ("JPY", 2.0)}
    assert long.count() == 2


def test_wide_years(spark, rows):
    wide = spark.createDataFrame([(1.0, None, 3.0, "x")], "`1980` DOUBLE, `1981` DOUBLE, `1982` DOUBLE, note STRING")
    assert rows(reshape.wide_years_to_long(wide, "USA_X")) == [(1980, "USA_X", 1.0), (1981, "USA_X", None), (1982, "USA_X", 3.0)]
    back = reshape.wide_years_to_long(wide, "USA_X").groupBy("indicator").pivot("year").agg(F.first("value"))
    assert back.select("1980", "1981", "1982").first() == (1.0, None, 3.0)


def test_no_year_columns(spark):
    with pytest.raises(ValueError):
        reshape.wide_years_to_long(spark.createDataFrame([(1,)], "a INT"), "x")


def test_statements_keep_empty_and_missing_parts(spark, tmp_path, rows):
    line = {"concept": "c", "label": "l", "unit": "usd", "value": 1.5}
    filing = {"symbol": "AAA", "year": 2024, "quarter": 2, "report": {"bs": [line, line], "cf": [], "ic": None}}
    path = str(tmp_path / "filings")
    readers.land_api_payload(spark, [filing], path)
    long = reshape.statements_to_long(readers.read_landed_payloads(spark, path, reshape.STATEMENTS_SCHEMA))
    assert rows(long, "statement", "concept", "value") == [
        ("bs", "c", 1.5), ("bs", "c", 1.5), ("cf", None, None), ("ic", None, None)
    ]


def test_news(spark, tmp_path):
    articles = [
        {"date": "2024-05-01T10:00:00+02:00", "title": "a", "link": "l", "sentiment": {"neg": 0.1, "polarity": -0.5}, "tags": ["t"]},
        {"date": "soon", "title": "b", "link": "m", "sentiment": None, "tags": []},
    ]
    path = str(tmp_path / "news")
    readers.land_api_payload(spark, articles, path)
    flat = reshape.newest_first(reshape.flatten_news(readers.read_landed_payloads(spark, path, reshape.NEWS_SCHEMA)))
    first, second = flat.collect()
    assert first.ts == datetime.datetime(2024, 5, 1, 8) and first.sent_neg == 0.1 and first.sent_polarity == -0.5
    assert second.ts is None and second.date == "soon" and second.sent_neg is None


def test_multiline_json_array_is_rows(spark, tmp_path, rows):
    (tmp_path / "list.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    (tmp_path / "one.json").write_text(json.dumps({"a": 3}, indent=1))
    assert rows(readers.read_json_documents(spark, str(tmp_path), "a INT")) == [(1,), (2,), (3,)]


def test_struct_as_map(spark, rows):
    df = spark.sql("SELECT named_struct('in', named_struct('a:b', 1, 'c.d', CAST(NULL AS INT))) AS s, 5 AS plain")
    long = maps.map_to_rows(df.select(maps.struct_as_map(df, "s.in").alias("m")), "m", "k", "v").select("k", "v")
    assert rows(long) == [("a:b", 1), ("c.d", None)]
    for path in ("s.nothing", "plain"):
        with pytest.raises(ValueError):
            maps.struct_as_map(df, path)


def test_reshape_row_count_is_sum_of_map_sizes(spark):
    df = spark.range(20).select(F.map_from_arrays(F.transform(F.sequence(F.lit(0), "id"), lambda i: i), F.sequence(F.lit(0), "id")).alias("m"))
    assert maps.map_to_rows(df, "m", "k", "v").count() == df.agg(F.sum(F.size("m"))).first()[0]
