"""Hard negatives against a comparison of all rows."""

import math
import random

import pytest

from zonelake.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, shard int"


def plain(rows):
    part = []
    for n, (i, v, label, *_) in enumerate(rows):
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        part.append((i, [math.floor(256 * x) for x in v], label, n))
    out = []
    for i, v, label, n in part:
        if i is None or i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, other) for j, w, other, m in part if m != n)
        own = [(-s, None if none else j) for s, none, j, other in scored if other == label][:5]
        for score, positive in own:
            fit = [(-s, None if none else j) for s, none, j, other in scored if other != label and 80 * score <= -100 * s <= 100 * score]
            out += [(i, positive, rank + 1, j, score, s) for rank, (s, j) in enumerate(fit[:5])]
    return sorted(out, key=str)


def float32(x):
    import numpy as np

    return float(np.float32(x))


def made(n, dims, labels, seed, step=1):
    rnd = random.Random(seed)
    return [(i * step, [float32(rnd.gauss(0.1, 0.3)) for _ in range(dims)], rnd.randrange(labels), "x", 0) for i in range(n)]


ODD = [
    (100, None, 1, "x", 0), (200, [0.5, None], 1, "x", 0), (300, [float("nan")], 1, "x", 0), (400, [float("inf"), 1.0], 2, "x", 0),
    (500, [1.0, 1.0, 0.5], None, "x", 0), (600, [], 1, "x", 0), (700, [0.0, 0.0], 3, "x", 0), (None, [0.5] * 8, 1, "x", 0), (None, [0.5] * 8, 2, "x", 0),
]
TIES = [(i, [0.5, 0.25, 0.25], i % 3, "x", 0) for i in range(0, 400, 10)]


@pytest.mark.parametrize("rows", [
    made(300, 12, 4, 1), made(400, 6, 2, 2, 25), TIES, ODD + made(250, 8, 3, 3), ODD,
    [r for r in made(60, 5, 2, 4, 50) for _ in range(2)], [(0, [1.0], 1, "x", 0)],
])
@pytest.mark.parametrize("shard_rows", [16384, 20])
def test_equals_all_comparisons(spark, rows, shard_rows):
    found = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), shard_rows=shard_rows)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


def test_empty_table_and_large_components(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(0, [1e20], 1, "x", 0)], SCHEMA))


def test_bounds_shrink_the_candidates():
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    x = np.floor(256 * rnd.normal(0, 0.1, (500, 32)) * np.geomspace(8, 0.01, 32))
    shard = negatives.Shard(pa.table({"vec_id": np.arange(500), "rid": np.arange(500), "x": list(x)}), 32)
    seen = []
    prune = negatives.best(5)

    def watch(lower, upper):
        seen.append(len(lower))
        return prune(lower, upper)

    alive, score = shard.scan(x[0].astype(np.int64), 0, watch)
    assert seen[-1] < 50 and sorted(score)[-5:] == sorted((x @ x[0])[1:])[-5:]
