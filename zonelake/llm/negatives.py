"""Hard negatives by scanning vectors dimension by dimension (BOND).

Vectors lie in shards of one label and bounded size, column by column.  An anchor reads the columns of a shard in falling
order of its own components.  What the columns that it hasn't read can still add lies between the sums of their smallest
and largest products, so every candidate has a lower and an upper bound, and each block of columns shrinks the set of
candidates: first those that can't be among the best of the same label, then, for other labels, those that can't be among
the first of any of the anchor's score windows.  The scores of what is left are exact whole numbers.

A shard is built once in its task and the anchors stream past it, so memory holds one shard and one batch of anchors,
however many there are.  Anchors meet the shards of their own label in the first pass and all others in the second.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonelake.llm.common import free_name, stage

#: Rows of a shard, columns that are read at once, positives of an anchor, negatives of a positive.
SHARD_ROWS, STEP, POSITIVES, NEGATIVES = 16384, 8, 5, 5
SCALE = 256
#: Sums of products below this are exact in 64 bits with room for the bounds.
LARGEST = 1 << 61


def whole_vectors(table: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """rid, vec_id, label, x (doubles, floor(256 * component)) of all rows that take part; must be staged."""
    slim = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(label).cast("int").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    slim = slim.filter(F.col("v").isNotNull() & F.col("label").isNotNull() & finite)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A double holds the floor of 256 times a component exactly or beyond all sums that are allowed.
    x = F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("double"))
    return slim.select(F.monotonically_increasing_id().alias("rid"), "vec_id", shifted.alias("label"), x.alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors go on with zeros."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy().astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class Shard:
    """Columns of the vectors of one shard, in order of ids, with the range of each column."""

    def __init__(self, rows: pa.Table, width: int):
        rows = rows.sort_by([("vec_id", "ascending"), ("rid", "ascending")])
        self.vec_id, self.rid = rows.column("vec_id"), rows.column("rid").to_numpy()
        vectors = matrix(rows.column("x").combine_chunks(), width)
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, own: int, prune: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the candidates that ``prune(lower, upper)`` keeps; not the row ``own``.

        Columns with a zero in the anchor add nothing and are not read.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[: np.count_nonzero(anchor)]
        ends = np.stack([anchor[order] * self.low[order], anchor[order] * self.high[order]])
        # What the columns from each place on can add at least and at most.
        rest_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        alive = np.flatnonzero(self.rid != own)
        score = np.zeros(len(alive), np.int64)
        for at in range(0, len(order), STEP):
            dims = order[at : at + STEP]
            block = self.columns[dims] if len(alive) == len(self.rid) else self.columns[np.ix_(dims, alive)]
            score += anchor[dims] @ block
            end = min(at + STEP, len(order))
            kept = prune(score + rest_low[end], score + rest_high[end])
            if not kept.all():
                alive, score = alive[kept], score[kept]
            if not len(alive):
                break
        return alive, score


def best(least: int) -> Callable:
    """Keeps what can be among the ``least`` highest scores."""

    def prune(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= least:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, len(lower) - least)[len(lower) - least]

    return prune


def windows(low: np.ndarray, high: np.ndarray, least: int) -> Callable:
    """Keeps what can be among the ``least`` highest scores from low to high of any window."""

    def prune(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(lower), bool)
        for a, b in zip(low.tolist(), high.tolist()):
            may = (upper >= a) & (lower <= b)
            sure = lower[(lower >= a) & (upper <= b)]
            if len(sure) > least:
                may &= upper >= np.partition(sure, len(sure) - least)[len(sure) - least]
            keep |= may
        return keep

    return prune


def bounds(positive: int) -> tuple[int, int]:
    """The whole scores s with 80 * positive <= 100 * s <= 100 * positive; none if the first is larger."""
    return -(-80 * positive // 100), positive


def first_of(shard: Shard, alive: np.ndarray, score: np.ndarray, least: int) -> np.ndarray:
    """Indexes of the ``least`` highest scores; ties to smaller ids, which come first in the shard."""
    return np.lexsort((alive, -score))[:least]


def past_shards(batches: Iterator[pa.RecordBatch], width: int, visit: Callable, empty: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, vectors before anchors.  Each shard is built once; its anchors stream past it."""
    rows: list[pa.RecordBatch] = []
    at, shard = None, None
    for batch in batches:
        marks = batch.column("shard").to_numpy()
        kinds = batch.column("anchor").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(marks) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if marks[start] != at:
                at, shard, rows = marks[start], None, []
            if not kinds[start]:
                rows.append(part)
                continue
            if shard is None:
                shard = Shard(pa.Table.from_batches(rows), width)
                rows = []
            found = visit(shard, part)
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=empty)


def met(vectors: DataFrame, anchors: DataFrame, visit: Callable, width: int, shards: int, out: str, empty: pa.Schema) -> DataFrame:
    """Bring every shard and the anchors that visit it into one task, in streaming order."""
    columns = ["shard", "anchor", "rid", "vec_id", "x", "scores"]
    rows = vectors.withColumn("anchor", F.lit(False)).withColumn("scores", F.lit(None).cast("array<long>")).select(*columns)
    rows = rows.unionByName(anchors.withColumn("anchor", F.lit(True)).select(*columns))
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "anchor")
    return rows.mapInArrow(lambda batches: past_shards(batches, width, visit, empty), out)


def hard_negatives(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100,
    positives: int = POSITIVES, negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without label or vector or with a component that is null or not finite take no part; rows without an id take
    part as candidates (ids that tie with one come before it), not as anchors.  Rows that repeat an id are rows of their
    own, also as anchors and positives.  Vectors of unequal length are filled up with zeros.  Fewer rows, or no table at
    all, give fewer results.  Components so large that an inner product would not fit in 64 bits are an error.
    """
    spark = table.sparkSession
    vectors = stage(whole_vectors(table, key, vector, label), "vectors")
    facts = vectors.agg(
        F.max(F.size("x")).alias("width"), F.max(F.array_max(F.transform("x", F.abs))).alias("largest")
    ).first()
    width, largest = facts.width or 0, facts.largest or 0.0
    if largest * largest * max(1, width) >= LARGEST:
        raise ValueError(f"components up to {largest / SCALE:g} in {width} dimensions: an inner product exceeds 64 bits")
    # Labels are dealt into as many shards as their rows need, so that a label with most of the rows is spread.
    sizes = vectors.groupBy("label").count().withColumn("parts", F.ceil(F.col("count") / shard_rows))
    before = W.orderBy("label").rowsBetween(W.unboundedPreceding, -1)
    sizes = stage(sizes.select("label", "parts", F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first")), "shards")
    shards = sizes.agg(F.sum("parts").alias("n")).first().n or 1
    own = F.col("first") + F.pmod(F.xxhash64("rid"), F.col("parts"))
    dealt = stage(vectors.join(sizes, "label").withColumn("shard", own.cast("long")).drop("parts", "first"), "dealt")
    anchors = dealt.filter(F.col("vec_id") % every == 0).select("rid", "vec_id", "label", "x")
    width = max(1, width)

    ids = pa.int64()
    near = pa.schema([("rid", ids), ("anchor_id", ids), ("other_rid", ids), ("positive_id", ids), ("positive_score", ids)])
    far = pa.schema([("rid", ids), ("place", pa.int32()), ("negative_id", ids), ("negative_rid", ids), ("negative_score", ids)])

    def find_positives(shard: Shard, part: pa.RecordBatch) -> list[dict]:
        found = []
        for rid, vec_id, x in zip(part.column("rid").to_pylist(), part.column("vec_id").to_pylist(), matrix(part.column("x"), width)):
            alive, score = shard.scan(x, rid, best(positives))
            for i in first_of(shard, alive, score, positives).tolist():
                found.append({"rid": rid, "anchor_id": vec_id, "other_rid": int(shard.rid[alive[i]]),
                              "positive_id": shard.vec_id[int(alive[i])].as_py(), "positive_score": int(score[i])})
        return found

    def find_negatives(shard: Shard, part: pa.RecordBatch) -> list[dict]:
        found = []
        for rid, scores, x in zip(part.column("rid").to_pylist(), part.column("scores").to_pylist(), matrix(part.column("x"), width)):
            edges = np.array([bounds(s) for s in scores], np.int64)
            alive, score = shard.scan(x, -1, windows(edges[:, 0], edges[:, 1], negatives))
            for place, (low, high) in enumerate(edges.tolist()):
                inside = np.flatnonzero((score >= low) & (score <= high))
                for i in inside[first_of(shard, alive[inside], score[inside], negatives)].tolist():
                    found.append({"rid": rid, "place": place, "negative_id": shard.vec_id[int(alive[i])].as_py(),
                                  "negative_rid": int(shard.rid[alive[i]]), "negative_score": int(score[i])})
        return found

    # First pass: the shards of the anchor's own label.
    mine = anchors.join(sizes, "label").withColumn("shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)))
    mine = mine.withColumn("scores", F.lit(None).cast("array<long>"))
    schema = "rid long, anchor_id long, other_rid long, positive_id long, positive_score long"
    candidates = met(dealt, mine, find_positives, width, int(shards), schema, near)
    order = W.partitionBy("rid").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), "other_rid")
    first = stage(candidates.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < positives), "positives")
    # Second pass: the shards of all other labels, with the scores of the positives in their order.
    scores = first.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("s"))
    scored = anchors.join(scores.select("rid", F.col("s.positive_score").alias("scores")), "rid")
    spans = sizes.withColumn("all", F.sum("parts").over(W.partitionBy())).select("label", "parts", "first", "all")
    everywhere = F.array_except(F.sequence(F.lit(0).cast("long"), F.col("all") - 1), F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))
    scored = scored.join(spans, "label").withColumn("shard", F.explode(everywhere))
    schema = "rid long, place int, negative_id long, negative_rid long, negative_score long"
    others = met(dealt, scored, find_negatives, width, int(shards), schema, far)
    order = W.partitionBy("rid", "place").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), "negative_rid")
    others = others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return others.join(first, ["rid", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def negatives_sql(every: int = 100) -> str:
    """The same rows by comparing all, for DuckDB."""
    return f"""
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM part a JOIN part b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= {NEGATIVES}"""
