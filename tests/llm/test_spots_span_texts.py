"""Fingerprints cover the whole text, with or without common words."""

import pytest
from pyspark.sql import functions as F

from test_llm import frame, words
from zonelake.llm import spotsigs


def spots(spark, texts):
    rows = spotsigs.with_spots(frame(spark, texts), "text", "s").orderBy("doc_id").select("s").collect()
    return [set(r[0]) for r in rows]


@pytest.mark.parametrize("head", ["", "the cat of and dog in a house ", "the cat "])
def test_every_word_counts_where_anchors_are_missing(spark, head):
    body = words(5, 40).split()
    texts = [head + " ".join(body)]
    for i in range(2 if head else 0, 40):
        texts.append(head + " ".join([*body[:i], "zzz", *body[i + 1 :]]))
    whole, *edits = spots(spark, texts)
    assert all(0.85 <= len(whole & e) / len(whole | e) < 1 for e in edits)


def test_texts_with_one_beginning_differ(spark):
    a, b, c = spots(spark, ["alpha beta " + words(1, 30), "alpha beta " + words(2, 30), "alpha beta 1 2 3"])
    assert len({frozenset(x) for x in (a, b, c)}) == 3 and len(a & b) / len(a | b) < 0.1


def test_near_anchors_add_nothing(spark):
    text = "the red cat of old men and the dog in green houses for two"
    made = spotsigs.with_spots(frame(spark, [text]), "text", "s").select(F.size("s")).first()[0]
    assert made == 5
