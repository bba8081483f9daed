"""Rounds of the shingle join: long unrelated documents need no texts, blocks of large regions give all links, components."""

import random

import numpy as np
import pytest

from test_llm import brute_components, frame, near_copies, words
from zonelake.llm import metric_join
from zonelake.llm.graph import components
from zonelake.llm.metric_join import PARITIES, parities, profile, profiles_apart


def sets(n, likeness, seed):
    """Two sets of n shingles with about that likeness."""
    every = np.random.default_rng(seed).integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
    shared = round(2 * n * likeness / (1 + likeness))
    return np.sort(every[:n]), np.sort(np.concatenate([every[:shared], every[n : 2 * n - shared]]))


def kept(spark, pairs):
    rows, known = [], []
    for k, pair in enumerate(pairs):
        rows += [(2 * k + i, len(s), bytearray(profile(s))) for i, s in enumerate(pair)]
        known.append((2 * k, 2 * k + 1))
    profiles = spark.createDataFrame(rows, "sig long, n long, profile binary")
    return sorted(r.a // 2 for r in metric_join.plausible(spark.createDataFrame(known, "a long, b long"), profiles, 80).collect())


def test_long_unrelated_sets_need_no_texts(spark):
    assert kept(spark, [sets(n, 0.0, n) for n in (300, 3000, 20000)]) == []
    assert kept(spark, [sets(n, 0.5, n) for n in (300, 3000, 20000)]) == []
    assert kept(spark, [sets(n, 0.81, n) for n in (1, 2, 300, 511, 3000, 20000)]) == list(range(6))


def test_profiles_of_unlike_lengths_bound_the_difference():
    rnd = np.random.default_rng(7)
    for n, m in ((500, 600), (513, 511), (129, 257), (4000, 5000), (100, 4000), (1, 2)):
        x = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[: min(n, m) * 9 // 10], rnd.integers(0, 1 << 63, m, dtype=np.uint64) * np.uint64(2)])[:m])
        bound = profiles_apart([profile(x), profile(y)], np.array([0, 1]), np.array([1, 0]))
        apart = len(np.setxor1d(x, y))
        assert bound[0] == bound[1] <= apart
        odd = sum(int(np.bitwise_count((p ^ q).view(np.uint64))) for p, q in zip(parities(x), parities(y)))
        assert odd <= apart


def test_small_regions_keep_pairs_of_any_parities(spark):
    one, two = sets(400, 0.9, 3)
    rows = [(k, len(s), *map(int, parities(s))) for k, s in enumerate((one, two))]
    profiles = spark.createDataFrame(rows, "sig long, n long, " + ", ".join(f"{c} long" for c in PARITIES))
    regions = spark.createDataFrame([(r, 0, k, 400, r, k) for r in range(3) for k in range(2)], "region long, home long, sig long, n long, place long, c long")
    assert [tuple(r) for r in metric_join._small_pairs(regions, profiles, 80).collect()] == [(0, 1)]


@pytest.mark.parametrize("leaf,levels,block", [(2, 1, 8), (2, 2, 8), (2, 0, 16), (128, 2, 128)])
def test_blocks_of_large_regions_give_all_links(spark, monkeypatch, leaf, levels, block):
    monkeypatch.setattr(metric_join.similar_sets, "__defaults__", (leaf, levels))
    monkeypatch.setattr(metric_join, "BLOCK", block)
    texts = near_copies() + [words(3, 40) + " " + words(k, 200) for k in range(50, 60)] + ["", None, "one", "ONE"]
    found = metric_join.near_duplicates(frame(spark, texts)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == brute_components(texts)


def test_components_of_random_graphs(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(5000 - i, 5001 - i) for i in range(40)]
    edges += [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(7000, i) for i in range(6990, 7010)] + [(3, 3), (9000, 9000)]
    group = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in group:
        for a, b in edges:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.v: r.c for r in found.collect()} == group
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
