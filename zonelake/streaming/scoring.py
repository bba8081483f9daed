"""Stateless scoring of events by rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RiskRule:
    """A condition as SQL text and the points it adds; a NULL condition adds nothing."""

    name: str
    condition: str
    points: float


def score_events(df: DataFrame, rules: list[RiskRule], threshold: float) -> DataFrame:
    """Add ``risk_score`` and ``is_fraud``.  Pure column expressions: the same message always gets the same answer."""
    points = [F.when(F.expr(rule.condition), F.lit(float(rule.points))).otherwise(F.lit(0.0)) for rule in rules]
    score: Column = reduce(lambda a, b: a + b, points, F.lit(0.0))
    return df.withColumn("risk_score", score).withColumn("is_fraud", F.col("risk_score") >= F.lit(float(threshold)))


def flag_at_random(df: DataFrame, share: float = 0.5, seed: int | None = None) -> DataFrame:
    """Add ``is_fraud`` by chance: a stand-in for a model when only the plumbing is tried out."""
    return df.withColumn("is_fraud", (F.rand(seed) if seed is not None else F.rand()) < share)


# Rules for the KYC form of the fraud topic.
KYC_RULES = [
    RiskRule("no user", "user_id IS NULL", 0.6),
    RiskRule("missing picture", "doc_s3_path IS NULL OR face_s3_path IS NULL", 0.5),
    RiskRule("same picture twice", "doc_s3_path = face_s3_path", 0.5),
    RiskRule("rejected before", "status = 'rejected'", 0.4),
]
KYC_THRESHOLD = 0.5
