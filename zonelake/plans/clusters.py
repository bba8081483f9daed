"""Components and clusters that every engine finds alike.

Covariances come from one aggregation, whose result has the size of the columns, not of the rows.  Eigenvectors have a
fixed sign.  K-means starts from the point nearest to the mean and then always takes the point farthest from all centres;
each step is one aggregation by the nearest centre, combined before its shuffle; clusters are numbered by their centres.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decimals of the centres; points are rounded by the caller.
DECIMALS = 9


@dataclass(frozen=True)
class Components:
    """Means of the columns, and unit vectors with the variance along each, in falling order."""

    columns: list[str]
    means: list[float]
    vectors: list[list[float]]
    variances: list[float]


def fixed_sign(vector: np.ndarray) -> np.ndarray:
    """The vector or its opposite: the first component of at least half the largest size is positive."""
    size = np.abs(vector)
    return vector if vector[np.argmax(size >= size.max() / 2)] >= 0 else -vector


def principal_components(df: DataFrame, columns: list[str], k: int) -> Components:
    """The ``k`` directions of the largest population variance, from one pass.  No rows, or NULLs only, are an error."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double")).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if any(value is None for value in row):
        raise ValueError("a column has no values")
    matrix = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = row[f"c{i}_{j}"]
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:k]
    return Components(
        list(columns), [float(row[f"m{i}"]) for i in range(len(columns))],
        [fixed_sign(vectors[:, n]).tolist() for n in order], [float(values[n]) for n in order],
    )


def project(df: DataFrame, model: Components, names: list[str]) -> DataFrame:
    """Add the coordinates along the components."""
    def along(vector: list[float]) -> Column:
        out = F.lit(0.0)
        for c, mean, weight in zip(model.columns, model.means, vector):
            out = out + (F.col(c) - F.lit(mean)) * F.lit(weight)
        return out

    return df.withColumns({name: along(vector) for name, vector in zip(names, model.vectors)})


def _distance(columns: list[str], centre: list[float]) -> Column:
    out = F.lit(0.0)
    for c, x in zip(columns, centre):
        out = out + (F.col(c) - F.lit(x)) * (F.col(c) - F.lit(x))
    return out


def _distances(columns: list[str], centres: list[list[float]]) -> Column:
    return F.array(*[_distance(columns, centre) for centre in centres])


def nearest(columns: list[str], centres: list[list[float]]) -> Column:
    """Number of the nearest centre, the smaller one on a tie."""
    found = _distances(columns, centres)
    return (F.array_position(found, F.array_min(found)) - 1).cast("int")


def farthest_first(points: DataFrame, columns: list[str], k: int) -> list[list[float]]:
    """Start centres.  Ties go to the point with the larger coordinates, so equal points don't matter."""
    point = F.struct(*columns)
    ends = F.struct(-_distance(columns, [0.0] * len(columns)), *columns)
    centres: list[list[float]] = []
    while len(centres) < k:
        if centres:
            ends = F.struct(F.array_min(_distances(columns, centres)), *columns)
        found = points.agg(F.max_by(point, ends)).first()[0]
        if found is None:
            raise ValueError("no points")
        centres.append([float(x) for x in found])
    return centres


def lloyd(points: DataFrame, columns: list[str], centres: list[list[float]], steps: int = 30) -> list[list[float]]:
    """Move the centres to the means of their points until they stay, at most ``steps`` times.  A centre without points
    stays where it is.  ``points`` should be staged: it is read once a step."""
    for _ in range(steps):
        means = points.groupBy(nearest(columns, centres).alias("_c")).agg(*[F.round(F.avg(c), DECIMALS).alias(c) for c in columns])
        moved = list(centres)
        for row in means.collect():  # one row a centre
            moved[row["_c"]] = [float(row[c]) for c in columns]
        if moved == centres:
            break
        centres = moved
    return centres


def k_means(points: DataFrame, columns: list[str], k: int, steps: int = 30) -> list[list[float]]:
    """Centres in the order of their coordinates."""
    return sorted(lloyd(points, columns, farthest_first(points, columns, k), steps))
