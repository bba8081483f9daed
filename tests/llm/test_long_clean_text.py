"""A text is not toxic by its length."""

from pyspark.sql import functions as F

from test_llm import frame, words
from zonelake.llm import toxicity


def test_length_alone_is_not_toxic(spark):
    clean = ". ".join(words(k, 6) for k in range(1000)) + ". "
    model = toxicity.Model({"scumbag": 8.0}, -5.0)
    texts = [clean * 100, clean, words(1, 6), clean * 100 + "you scumbag go", clean + "scumbag", "scumbag"]
    found = {r.doc_id: r for r in toxicity.score_documents(frame(spark, texts), model).collect()}
    assert found[0].sentences == 100_000 and found[0].score == found[1].score == found[2].score < 0.01
    assert [found[i].predicted for i in range(6)] == [0, 0, 0, 1, 1, 1]
    assert abs(found[3].score - found[5].score) < 1e-9 and abs(found[5].score - found[5].worst_score) < 1e-9
    assert toxicity.drop_toxic(frame(spark, texts), model).count() == 3


def test_long_clean_texts_are_learned_as_clean(spark):
    texts = [". ".join(words(100 * i + k, 5) for k in range(400 if i % 8 == 1 else 5)) + (". you scumbag go" if i % 4 == 0 else "") for i in range(200)]
    docs = frame(spark, texts)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    long = frame(spark, [". ".join(words(7 + k % 50, 5) for k in range(100_000)), "you scumbag go"])
    assert [r.predicted for r in toxicity.score_documents(long, model).orderBy("doc_id").collect()] == [0, 1]
