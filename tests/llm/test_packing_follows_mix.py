"""The sequences of the pipeline follow the order of the mix."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonelake.llm import packing, pfair
from zonelake.llm.common import stage
from zonelake.llm.queries import OTHER, WEIGHTS

SCHEMA = "doc_id long, text string, source string"


def documents(spark, n=400):
    rows = [(i, " ".join(f"w{i * k % 97}" for k in range(i * 7 % 50 + 1)), f"src{i % 4}") for i in range(n)]
    return spark.createDataFrame([*rows, (None, None, None), (7, "", "src1"), (n, "word " * 9000, "src3")], SCHEMA)


def places(df):
    return {(r.doc_id, r.start, r.ids_crc32): (r.sequence_id, r.offset, r.length) for r in df.collect()}


@pytest.mark.parametrize("written", [True, False])
def test_stretches_of_the_mix_follow_each_other(spark, written):
    docs = documents(spark)
    order = [r.doc_id for r in pfair.mix_sources(docs, "source", "doc_id", WEIGHTS, OTHER).orderBy("slot", "place").collect()]
    mixed = corpus_pipeline.mix_by_weight(spark, docs.repartition(5), "")
    if written:
        mixed = stage(mixed.select("*"), "mixed")
    found = packing.pack_documents_in_order(mixed, window=256, stretch=100).collect()
    whole = packing.pack_documents(docs, window=256).collect()
    pieces = lambda rows: sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert pieces(found) == pieces(whole)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    place = {i: k // 100 for k, i in enumerate(order) if i != 7}  # 7 stands there twice
    last = -1
    for s in sorted(sequences):
        met = {place[r.doc_id] for r in sequences[s] if r.doc_id != 7}
        assert len(met) <= 1 and min(met, default=last) >= last
        last = min(met, default=last)
    assert last == (len(order) - 1) // 100


def test_another_mix_gives_another_packing(spark, monkeypatch):
    docs = stage(documents(spark), "documents")
    pack = corpus_pipeline.STAGES[-1][1]
    assert corpus_pipeline.STAGES[-1][0] == "packing"
    one = places(pack(spark, stage(corpus_pipeline.mix_by_weight(spark, docs, "").select("*"), "mixed"), ""))
    docs = stage(documents(spark), "documents")
    monkeypatch.setattr(corpus_pipeline, "WEIGHTS", {"src3": 50.0})
    two = places(pack(spark, stage(corpus_pipeline.mix_by_weight(spark, docs, "").select("*"), "mixed"), ""))
    assert one.keys() == two.keys() and one != two


def test_an_empty_mix_has_no_sequences(spark):
    docs = stage(documents(spark).filter(F.lit(False)), "documents")
    assert packing.pack_documents_in_order(docs).collect() == []
