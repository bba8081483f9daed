"""The mix follows the weights themselves, over many periods."""

from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from zonelake.llm import pfair, queries
from zonelake.llm.common import stage


def deviation(mixed, weights):
    """Largest deviation in blocks from the exact weights, up to the slot at which the first source ends."""
    slots = [r[0] for r in mixed.select("stream", "slot").distinct().orderBy("slot").select("stream").collect()]
    left, total = Counter(slots), sum(map(Fraction, map(str, weights.values())))
    got, most = Counter(), Fraction(0)
    for t, s in enumerate(slots, 1):
        got[s] += 1
        most = max(most, *(abs(got[x] - Fraction(str(w)) / total * t) for x, w in weights.items()))
        if got[s] == left[s]:
            return t, float(most)


@pytest.mark.parametrize("weights", [queries.WEIGHTS, {"a": 0.1234567891, "b": 0.7, "c": 1 / 3}])
def test_less_than_a_block_from_the_weights(spark, weights):
    rows = 25 if len(weights) > 3 else 400
    sizes = {s: int(w * 8 * rows) for s, w in weights.items()}
    parts = [spark.range(n).select(F.lit(s).alias("source"), F.concat(F.lit(s), F.col("id").cast("string")).alias("k")) for s, n in sizes.items()]
    docs = parts[0]
    for p in parts[1:]:
        docs = docs.unionByName(p)
    docs = stage(docs, "rows")
    mixed = stage(pfair.mix_sources(docs, "source", "k", weights, 0.5, block_rows=1, run_rows=500), "mixed")
    slots = sorted(r[0] for r in mixed.select("slot").collect())
    assert slots == list(range(sum(sizes.values())))
    assert mixed.filter("slot < release OR slot >= deadline").count() == 0
    length, most = deviation(mixed, weights)
    assert length > 3000 and most < 1


def test_shares_are_the_weights():
    live = {s: w for s, w in queries.WEIGHTS.items()}
    shares = pfair.exact_shares(live)
    assert (shares["src0"], shares["src1"], shares["src19"], sum(shares.values())) == (6, 2, 1, 39)


def test_maps_anywhere_in_a_column(spark):
    docs = spark.range(40).select(
        F.when(F.col("id") > 9, F.col("id")).alias("doc_id"), F.lit("a").alias("source"), F.create_map(F.lit("k"), "id").alias("plain"),
        F.array(F.create_map(F.lit("k"), "id")).alias("nested"), F.struct(F.create_map(F.lit("k"), F.lit(1)).alias("m"), "id").alias("inner"),
        F.parse_json(F.lit('{"a": 1}')).alias("loose"),
    )
    mixed = pfair.mix_sources(docs, "source", "doc_id", {"a": 1.0}, block_rows=8)
    found = mixed.select("slot", "place", "inner.id").collect()
    assert sorted(r.id for r in found) == list(range(40))
    assert sorted((r.slot, r.place) for r in found) == [(i // 8, i % 8) for i in range(40)]


def test_rows_without_a_key_are_ranked_in_many_runs(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.col("id").cast("string").alias("text"))
    mixed = stage(pfair.mix_sources(docs, "source", "doc_id", {"a": 1.0}, block_rows=10, run_rows=100), "mixed")
    assert mixed.select("slot", "place").distinct().count() == 4000 and mixed.agg(F.max("slot")).first()[0] == 399
    # Runs are stretches of the hash, so the hashes of the rows have to differ.
    again = pfair.mix_sources(docs.repartition(7), "source", "doc_id", {"a": 1.0}, block_rows=10, run_rows=100)
    key = ["text", "slot", "place"]
    assert mixed.select(key).exceptAll(again.select(key)).count() == 0
