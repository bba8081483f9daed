"""Rule-based sentiment: a table of cases with the sums that the rules give."""

import math

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from zonelake.functions import sentiment
from zonelake.plans import analysis

LEXICON = [("good", 1.9), ("great", 3.1), ("bad", -2.5), ("loss", -1.3), (":)", 2.0), ("doubt", -1.5), ("least", 0.0)]
B, C, N = sentiment.BOOST, sentiment.CAPITALS, sentiment.TURN
#: Text and the sum before it is squashed.
CASES = [
    (None, 0.0), ("", 0.0), ("nothing here", 0.0), ("good", 1.9), ("Good, great!", 5.0 + 0.292), ("a good day :)", 3.9),
    ("bad!!!!!!", -2.5 - 4 * 0.292), ("good??", 1.9 + 2 * 0.18), ("good?????", 1.9 + 0.96),
    ("very good", 1.9 + B), ("very bad", -2.5 - B), ("slightly good", 1.9 - B), ("very big good", 1.9 + 0.95 * B),
    ("very big fine good", 1.9 + 0.9 * B), ("very a b c good", 1.9),
    ("not good", 1.9 * N), ("isn't good", 1.9 * N), ("not very good", (1.9 + B) * N), ("no x y bad", -2.5 * N), ("not a b c good", 1.9),
    ("never so good", 1.9 * 1.25 + B * 1.25), ("never a good", 1.9 * N), ("without doubt good", -1.5 * N + 1.9),
    ("a GOOD day", 1.9 + C), ("GOOD DAY", 1.9), ("a VERY bad day", -2.5 - (B + C)),
    ("good but bad", 0.5 * 1.9 + 1.5 * -2.5), ("bad but not good", 0.5 * -2.5 + 1.5 * 1.9 * N), ("good\n\tbad", 1.9 - 2.5),
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON[:-1], "term STRING, valence DOUBLE")


def test_cases(spark, lexicon):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i INT, t STRING")
    found = {r.i: r.score for r in analysis.headline_sentiment(df, "t", lexicon).collect()}
    for i, (text, total) in enumerate(CASES):
        assert found[i] == pytest.approx(total / math.sqrt(total * total + 15), abs=6e-5), text


def test_labels_and_other_words(spark, lexicon):
    df = spark.createDataFrame([("gar nicht good",), ("good",), ("x",)], "t STRING")
    rules = sentiment.Rules(stronger=("sehr",), weaker=("kaum",), negations=("nicht",), contrast=("aber",))
    assert [r.sentiment for r in analysis.headline_sentiment(df, "t", lexicon, rules).collect()] == ["negative", "positive", "neutral"]


def test_a_word_before_it_that_the_lexicon_has_turns_nothing(spark):
    lexicon = spark.createDataFrame([*LEXICON, ("no", -1.2)], "term STRING, valence DOUBLE")
    df = spark.createDataFrame([("no good",), ("at least good",), ("the least good",)], "t STRING")
    scores = [r.score for r in analysis.headline_sentiment(df, "t", lexicon).collect()]
    squashed = [x / math.sqrt(x * x + 15) for x in (1.9 - 1.2, 1.9, 1.9)]
    assert scores == pytest.approx(squashed, abs=6e-5)


def test_nothing_is_shuffled_but_the_lexicon(spark, lexicon):
    df = spark.range(10).select(F.concat(F.lit("good "), "id").alias("t"))
    plan = plan_of(analysis.headline_sentiment(df, "t", lexicon))
    main = plan.split("Subquery")[0]
    assert "Python" not in plan and "Join" not in plan and "Exchange" not in main
    with pytest.raises(Exception, match="over 3 terms"):
        spark.range(1).select(sentiment.lexicon_lists(lexicon, 16, 3)).collect()
    empty = analysis.headline_sentiment(df, "t", lexicon.limit(0))
    assert {r.score for r in empty.collect()} == {0.0}
