"""Components that share their smallest id are told apart."""

from test_llm import frame, words
from zonelake.llm import metric_join


def test_one_of_each_component_when_ids_are_null_or_repeated(spark):
    texts = [words(80, 30), words(81, 30), words(82, 30), words(83, 30), words(82, 30), words(84, 30), words(84, 30)]
    docs = frame(spark, texts, [None, None, 5, 5, 7, None, 3])
    kept = [(r.doc_id, r.text) for r in metric_join.one_of_each(docs).collect()]
    want = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (3, texts[5])]
    assert sorted(kept, key=str) == sorted(want, key=str)
