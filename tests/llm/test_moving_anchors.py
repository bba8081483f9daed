"""Texts that repeat themselves, very long texts and strings that stand in many contexts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonelake.llm import suffixes

LENGTH = 200


def letters(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choice("abcdefgh ") for _ in range(n))


def brute(raw):
    places = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - LENGTH + 1):
            places.setdefault(b[i : i + LENGTH], []).append((d, i))
    return {p for v in places.values() if len(v) > 1 for p in v}


def starts_of(found):
    out = {}
    for document, low, high, anchor, *_ in zip(*(x.tolist() for x in found)):
        for i in range(low, high + 1):
            assert (document, i) not in out
            out[document, i] = anchor
    return out


def test_blocks_give_the_same_anchors():
    texts = [letters(1, 3000), "", "x" * 199, "x" * 200, letters(2, 700), "ab" * 900]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    want = starts_of(suffixes.anchors(raw, offsets))
    assert set(want) == {(d, i) for d, t in enumerate(texts) for i in range(len(t) - LENGTH + 1)}
    for block in (1, 64, 333, 4096):
        assert starts_of(suffixes.anchors(raw, offsets, block=block)) == want


def test_equal_bytes_make_few_rows():
    raw = np.zeros(100_000, np.uint8) + 45
    found = suffixes.anchors(raw, np.array([0, len(raw)]))
    assert len(found[0]) == -(-(100_000 - LENGTH + 1) // suffixes.MOST_STARTS) and all(found[5][:-1])


@pytest.mark.parametrize("most", [4096, 1, 0])
def test_periodic_texts_equal_brute_force(spark, most):
    part = letters(3, 90)
    texts = [
        "-" * 700, "-" * 200, "=" * 200, "+" * 201, part * 9, letters(4, 50) + part * 3 + letters(5, 240), part * 2 + part[:19], part * 2 + part[:20],
        part * 2 + part[:21] + "!", ("é" * 7 + "\n") * 40, letters(6, 300) + "~" * 230 + letters(7, 100), letters(8, 1200),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", F.xxhash64("text").alias("tk"), "text")
    want = brute([t.encode() for t in texts])
    found = suffixes.repeated_ranges(docs, LENGTH, most).collect()
    assert {(r.id, i) for r in found for i in range(r.low, r.high + 1)} == want


def test_one_anchor_in_many_contexts(spark):
    """A passage of 230 bytes in 5,000 different surroundings, over the number that one shard takes."""
    shared = letters(9, 230)
    rows = [(k, letters(100 + k, 60) + shared + letters(90_000 + k, 60)) for k in range(5000)]
    docs = spark.createDataFrame(rows, "id long, text string").select("id", F.xxhash64("text").alias("tk"), "text")
    want = brute([t.encode() for _, t in rows])
    found = suffixes.repeated_ranges(docs, LENGTH).collect()
    assert {(r.id, i) for r in found for i in range(r.low, r.high + 1)} == want and len(want) >= 5000 * 31
