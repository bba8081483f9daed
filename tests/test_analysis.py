import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from zonelake.functions import text
from zonelake.functions.scalars import number_or_zero, quarter_start, three_way, url_container, url_key
from zonelake.operators import filters, stats, windows
from zonelake.plans import analysis


def one(df, column):
    return df.select(column).first()[0]


def test_headline_terms(spark):
    titles = ["Apple beats Apple rumours and apple", "zeta alpha zeta alpha beta", "the and of", "", None, "Ünïcode ünïcode straße"]
    df = spark.createDataFrame([(t,) for t in titles], "title STRING")
    got = [r.topic_words for r in analysis.headline_terms(df, "title").collect()]
    assert got == [["apple", "beats"], ["alpha", "zeta"], [], [], [], ["straße", "ünïcode"]]


def test_term_counts_against_brute_force(spark):
    rng = random.Random(5)
    data = [[rng.choice("abcdefg") * 2 for _ in range(rng.randint(0, 60))] for _ in range(40)]
    df = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(data)], "i INT, t STRING")
    got = df.select("i", text.term_counts(text.words("t")).alias("c")).collect()
    for row in got:
        assert [(c.term, c.n) for c in row.c] == sorted((w, data[row.i].count(w)) for w in set(data[row.i]))


def test_terms_never_leave_their_row(spark):
    df = spark.createDataFrame([("x y",)], "title STRING")
    plan = plan_of(analysis.headline_terms(df, "title"))
    assert "Exchange" not in plan and "Python" not in plan


def test_lexicon_sentiment(spark, rows):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "term STRING, valence DOUBLE")
    titles = [(1, "Good good news"), (2, "bad day"), (3, "nothing"), (4, "")]
    df = analysis.lexicon_sentiment(spark.createDataFrame(titles, "id INT, t STRING"), "id", "t", lexicon)
    got = {r.id: (round(r.score, 6), r.sentiment) for r in df.collect()}
    squash = lambda s: round(s / math.sqrt(s * s + 15), 6)
    assert got == {1: (squash(3.8), "positive"), 2: (squash(-2.5), "negative"), 3: (0.0, "neutral"), 4: (0.0, "neutral")}


@pytest.mark.parametrize("score, label", [(0.21, "positive"), (0.2, "neutral"), (-0.2, "neutral"), (-0.3, "negative"), (0.0, "neutral")])
def test_three_way(spark, score, label):
    assert one(spark.range(1), three_way(F.lit(score))) == label


def test_scalars(spark):
    row = spark.sql("SELECT 's3a://bucket/dir/x.pdf' AS u, 'plain' AS p, 2024 AS y, 3 AS q, 5 AS bad, '7x' AS t")
    assert (one(row, url_container("u")), one(row, url_key("u")), one(row, url_key("p"))) == ("bucket", "dir/x.pdf", None)
    assert str(one(row, quarter_start("y", "q"))) == "2024-07-01" and one(row, quarter_start("y", "bad")) is None
    assert one(row, number_or_zero("t", "bigint")) == 0


def test_dominant_value_on_a_tie(spark, rows):
    df = spark.createDataFrame([("u", "Debit"), ("u", "Credit"), ("v", "Debit"), ("v", None), ("v", None)], "k STRING, t STRING")
    assert rows(stats.dominant_value(df, "k", "t")) == [("u", "Credit"), ("v", "Debit")]


def test_user_features(spark, rows):
    profiles = spark.createDataFrame([("u", 30, "clerk"), ("v", 40, None), ("w", 50, "cook")], "user_id STRING, age INT, occupation STRING")
    tx = spark.createDataFrame([("u", "Debit", 1.0), ("u", "Credit", 4.0), ("u", None, None), ("v", "Debit", 1.0)], "user_id STRING, type STRING, amount DOUBLE")
    assert rows(analysis.user_features(profiles, tx)) == [("u", 30, "clerk", 2.5, "Credit")]


def test_indicator_and_asset_series(spark, rows):
    indicators = spark.createDataFrame([("A", 1990, 1.0), ("A", 2010, 2.0), ("B", 2015, 3.0)], "indicator STRING, year INT, value DOUBLE")
    assert rows(analysis.indicator_series(indicators, ["A"])) == [("A", 1990, 1.0), ("A", 2010, 2.0)]
    assert rows(analysis.indicator_series(indicators, ["A"], years=5)) == [("A", 2010, 2.0)]
    report = spark.createDataFrame(
        [("AAPL", 2024, 2, "bs", "TOTAL ASSETS", 5.0), ("AAPL", 2024, 2, "ic", "Total assets", 6.0), ("IBM", 2024, 1, "bs", "Total assets", 7.0)],
        "symbol STRING, year INT, quarter INT, statement STRING, label STRING, value DOUBLE")
    assert [(r.symbol, str(r.date), r.value) for r in analysis.asset_series(report, ["AAPL"]).collect()] == [("AAPL", "2024-04-01", 5.0)]


def test_newer_than(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "y INT")
    assert rows(filters.newer_than(df, df.filter("y < 3"), "y")) == [(3,)]
    assert rows(filters.newer_than(df, df.limit(0), "y")) == [(1,), (2,), (3,)]
    assert filters.first_entries(df, ["y"], 2).count() == 2 and filters.first_entries(df, ["y"]).count() == 3


def test_months_back_includes_both_days(spark, rows):
    df = spark.sql("SELECT explode(array(timestamp_ntz'2024-01-14 23:59:59', timestamp_ntz'2024-01-15 00:00:00', timestamp_ntz'2024-07-15 22:00:00', timestamp_ntz'2024-07-16 00:00:00')) AS t")
    assert [str(t) for (t,) in rows(filters.months_back(df, "t", "2024-07-15"))] == ["2024-01-15 00:00:00", "2024-07-15 22:00:00"]


def test_change_over_previous(spark, rows):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 9.0), ("b", 2, 1.0)], "k STRING, y INT, v DOUBLE")
    assert rows(windows.change_over_previous(df, ["k"], "y", "v"), "k", "y", "change") == [("a", 1, None), ("a", 3, 4.0), ("b", 2, None)]


def blobs(spark, n=400):
    rng = random.Random(1)
    data = []
    for i in range(n):
        kind = rng.choice(["Debit", "Credit"])
        shift = 0.0 if kind == "Debit" else 6.0
        data.append((i, rng.gauss(shift, 1), rng.gauss(-shift, 2), kind))
    return spark.createDataFrame(data, "id INT, a DOUBLE, b DOUBLE, type STRING")


def test_gaussian_nb_against_brute_force(spark):
    df = blobs(spark)
    frame = analysis.classification_frame(df, ["a", "b"], keep=["id"])
    assert frame.filter("(type = 'Credit') != (label = 0)").isEmpty()
    model = {r.label: r for r in analysis.fit_gaussian_nb(frame, ["a", "b"]).collect()}
    data = [tuple(r) for r in frame.select("a", "b", "label").collect()]

    def moments(values):
        mean = sum(values) / len(values)
        return mean, sum((v - mean) ** 2 for v in values) / len(values)

    extra = 1e-9 * max(moments([d[i] for d in data])[1] for i in (0, 1))
    for label, row in model.items():
        mine = [d for d in data if d[2] == label]
        assert row.prior == pytest.approx(len(mine) / len(data))
        for i in (0, 1):
            mean, variance = moments([d[i] for d in mine])
            assert row.means[i] == pytest.approx(mean) and row.variances[i] == pytest.approx(variance + extra)
    predicted = analysis.classify(df, "id", ["a", "b"])
    report, matrix = analysis.evaluation(predicted)
    assert all(r.f1 > 0.95 for r in report.collect())
    assert matrix.agg(F.sum("n")).first()[0] == predicted.count() < 0.35 * df.count()


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    train = lambda d: {r.id for r in d.filter(analysis.split_column("id")).collect()}
    assert train(df.repartition(7)) == train(df.coalesce(1)) and 700 < len(train(df)) < 900


def test_class_report_of_a_class_never_predicted(spark, rows):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "label INT, prediction INT")
    assert rows(stats.class_report(df, "label", "prediction")) == [(0, 1, 0.5, 1.0, 2 / 3), (1, 1, 0.0, 0.0, 0.0), (2, 1, 1.0, 1.0, 1.0)]


def test_standardise(spark):
    df = analysis.standardise(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, b DOUBLE"), ["a", "b"])
    assert sorted(map(tuple, df.collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_clusters_find_separate_groups(spark):
    rng = random.Random(2)
    centres = [(0, 0, "x"), (50, 0, "y"), (0, 50, "z")]
    data = [(i, *(c + rng.random() for c in centres[i % 3][:2]), centres[i % 3][2]) for i in range(150)]
    df = spark.createDataFrame(data, "id INT, a DOUBLE, b DOUBLE, kind STRING")
    rows = analysis.cluster_users(df, ["a", "b"], ["kind"]).rows
    groups = rows.groupBy("kind").agg(F.collect_set("cluster").alias("c")).collect()
    assert sorted(c for g in groups for c in g.c) == [0, 1, 2]
    pc = rows.select(F.get("pc", F.lit(0)).alias("x"), F.get("pc", F.lit(1)).alias("y"))
    spread = pc.agg(F.var_samp("x"), F.var_samp("y"), F.corr("x", "y")).first()
    assert spread[0] >= spread[1] > 0 and abs(spread[2]) < 1e-6


def test_one_hot(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id INT, k STRING")
    assert rows(analysis.one_hot(df, "k", ["a", "b"])) == [(1, 1, 0), (2, 0, 0)]
