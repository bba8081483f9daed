"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's chance is logistic in its features (words and their beginnings); a document's is the noisy-or of one base
chance for the whole text and of what the weighted words of its sentences add to the base.  A sentence without weighted
words adds nothing, so a text is not toxic by its length.  Weights are fitted on the labels of documents alone, and then tell which sentences offend.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import slices, stage

#: Labelled rows of each class that are fitted on, chosen by a hash of the id; and features of the model.
CLASS_ROWS, FEATURES = 4000, 8192
#: Documents of class 1 that must have a feature.
LEAST_ROWS = 4
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
#: Words whose weights a task remembers.
MEMORY = 200_000


def features(word: str) -> list[str]:
    """The word and its beginnings (marked by a star)."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


@dataclass
class Model:
    weights: dict[str, float]
    base: float

    def word_weight(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))


def fit(rows: list[tuple[int, int, list[list[int]]]], width: int, class_weights: tuple[float, float], steps: int = 400):
    """Weights (not negative) and intercept that make noisy-or fit the labels.  rows: (label, sentences, features of those that have any).

    A document with sentences has the base chance once; each marked sentence counts relative to the base.
    """
    doc, sent, feat, sentences = [], [], [], 0
    labels, others = np.array([r[0] for r in rows], float), np.zeros(len(rows))
    for d, (_, n, marked) in enumerate(rows):
        others[d] = min(n, 1) - len(marked)
        for s in marked:
            doc.append(d)
            feat += s
            sent += [sentences] * len(s)
            sentences += 1
    doc, sent, feat = np.array(doc, np.int64), np.array(sent, np.int64), np.array(feat, np.int64)
    cost = np.where(labels == 1, class_weights[1], class_weights[0])
    cost = cost / max(cost.sum(), 1e-9) * len(rows)
    theta, base = np.full(width, 0.5), -7.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = base + np.bincount(sent, theta[feat], sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-base))
        # none: log of the chance that no sentence offends; its slope by z of a sentence is -p.
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(rows)) + others * np.log1p(-p0)
        none = np.minimum(none, -1e-12)
        slope = cost * np.where(labels == 1, np.exp(none) / -np.expm1(none), -1.0)
        by_sentence = slope[doc] * -p
        grad = np.bincount(feat, by_sentence[sent], width) / len(rows) + 2e-4 * theta
        grad_base = (by_sentence.sum() - np.sum(slope * others * p0)) / len(rows) + 1e-3 * (base + 9.0)
        g = np.append(grad, grad_base)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        theta = np.maximum(theta - move[:-1], 0.0)
        base = float(min(base - move[-1], -5.0))
    return theta, base


def sentence_features(text: str, known: dict[str, int]) -> tuple[int, list[list[int]]]:
    total, marked = 0, []
    for s in SENTENCE.findall(text.lower()):
        words = set(WORD.findall(s))
        total += bool(words)
        found = {known[f] for w in words for f in features(w) if f in known}
        if found:
            marked.append(sorted(found))
    return total, marked


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          class_rows: int = CLASS_ROWS, width: int = FEATURES) -> Model:
    """Fit on at most ``class_rows`` labelled documents of each class outside the held-out fold.

    Counts of features are Spark's; the driver gets ``width`` features and the bounded sample's sparse sentences.
    Without documents of both classes the model has no weights and scores everything as clean.
    """
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
    marked = marked.groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("y"))
    size = dict(marked.groupBy("y").count().collect())
    if not size.get(0) or not size.get(1):
        return Model({}, -9.0)
    picked = [marked.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(class_rows) for y in (0, 1)]
    # At most 2 * class_rows ids.
    picked = F.broadcast(picked[0].unionByName(picked[1]))
    slim = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = stage(slim.join(picked, "k").select("y", "text"), "toxic-sample")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, ys = [], []
                for y, t in zip(part.column("y").to_pylist(), part.column("text").to_pylist()):
                    own = {f for w in set(WORD.findall(t.lower())) for f in features(w)}
                    names += own
                    ys += [y] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ys, pa.int32())], names=["f", "y"])

    seen = sample.mapInArrow(words, "f string, y int").groupBy("f").agg(
        F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")
    )
    taken = dict(sample.groupBy("y").count().collect())
    bad, good = max(taken.get(1, 0), 1), max(taken.get(0, 0), 1)
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    telling = seen.filter((F.col("bad") >= LEAST_ROWS) & (odds > 1.6)).withColumn("o", odds * F.sqrt("bad"))
    names = [r[0] for r in telling.orderBy(F.col("o").desc(), "f").limit(width).select("f").collect()]
    known = {f: i for i, f in enumerate(names)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [sentence_features(t, known) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.array([n for n, _ in found], pa.int64()), pa.array([m for _, m in found], pa.list_(pa.list_(pa.int32())))],
                    names=["y", "n", "m"],
                )

    rows = [(r[0], r[1], [list(s) for s in r[2]]) for r in sample.mapInArrow(sparse, "y int, n long, m array<array<int>>").collect()]
    if not names:
        return Model({}, -9.0)
    theta, base = fit(rows, len(names), (size[0] / good, size[1] / bad))
    return Model({f: float(t) for f, t in zip(names, theta) if t > 1e-3}, base)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4.  A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def score_texts(df: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns (under c0, c1, ...) with score, sentences, worst_start, worst_end, worst_score; one narrow pass."""
    slim = df.select(F.col(text).cast("string").alias("text"), *[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)])
    carried = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        none = float(np.log1p(-1 / (1 + np.exp(-model.base))))

        def weight(word: str) -> float:
            found = memory.get(word)
            if found is None:
                if len(memory) >= MEMORY:
                    memory.clear()
                found = memory[word] = model.word_weight(word)
            return found

        for batch in batches:
            for part in slices(batch, "text"):
                out: list[tuple] = []
                for t in part.column("text").to_pylist():
                    low = (t or "").lower()
                    telling = {w for w in set(WORD.findall(low)) if weight(w)}
                    logs, n, worst = none, 0, (-1.0, 0, 0)
                    if not telling:
                        n = sum(1 for s in SENTENCE.findall(low) if not s.isspace())
                    else:
                        for s in SENTENCE.finditer(low):
                            if s.group().isspace():
                                continue
                            n += 1
                            found = telling.intersection(WORD.findall(s.group()))
                            if not found:
                                continue
                            z = model.base + sum(map(weight, found))
                            p = 1 / (1 + np.exp(-z))
                            logs += np.log1p(-min(p, 1 - 1e-12)) - none
                            if p > worst[0]:
                                worst = (p, s.start(), s.end())
                    out.append((float(-np.expm1(logs)) if n else 0.0, n, worst[1], worst[2], float(max(worst[0], 0.0))))
                cols = list(zip(*out)) or [()] * 5
                types = [pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carried] + [pa.array(c, ty) for c, ty in zip(cols, types)],
                    names=carried + ["score", "sentences", "worst_start", "worst_end", "worst_score"],
                )

    kinds = "".join(f"{c} {slim.schema[c].dataType.simpleString()}, " for c in carried)
    return slim.mapInArrow(run, kinds + "score double, sentences long, worst_start long, worst_end long, worst_score double")


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and the worst sentence (character range of the lower-cased text).

    Null and empty texts have no sentence and score 0.  Repeated rows are scored each; an empty table gives no rows.
    """
    scored = score_texts(docs, model, "text", ["doc_id"]).withColumnRenamed("c0", "doc_id")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "sentences", "worst_start", "worst_end", "worst_score",
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores under the threshold.  Null texts stay."""
    scored = score_texts(docs, model, "text", docs.columns)
    kept = scored.filter(F.col("score") < THRESHOLD)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
