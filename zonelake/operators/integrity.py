"""Do the files that rows refer to exist, are they not empty, and are they a PDF or an image?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.functions.scalars import media_kind


def referenced_paths(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-NULL paths over several columns.  Copies are removed before the shuffle."""
    paths = df.select(F.explode(F.array(*columns)).alias("path"))
    return paths.filter(F.col("path").isNotNull()).distinct()


def bad_paths(paths: DataFrame, headers: DataFrame) -> DataFrame:
    """Paths without a usable object.  ``headers`` has one row (path, size, head) per object that exists."""
    usable = headers.filter((F.col("size") > 0) & media_kind("head").isNotNull()).select("path")
    return paths.join(usable, "path", "left_anti")


def flag_files(df: DataFrame, columns: list[str], headers: DataFrame, name: str = "file_ok") -> DataFrame:
    """Add a boolean, never NULL: every referenced file of the row is usable.  A NULL path is not usable.

    Rows are joined with the *bad* paths only: usually few, so that Spark can broadcast them; when they are many the
    join shuffles by path and adaptive execution splits a path that many rows share.  NULL paths take no part.
    """
    bad = bad_paths(referenced_paths(df, columns), headers)
    flagged, hits = df, []
    for i, column in enumerate(columns):
        hit = f"_bad{i}"
        listed = bad.select(F.col("path").alias(f"_path{i}"), F.lit(True).alias(hit))
        flagged = flagged.join(listed, F.col(column) == F.col(f"_path{i}"), "left").drop(f"_path{i}")
        hits += [F.coalesce(F.col(hit), F.lit(False)) | F.col(column).isNull()]
    any_bad = reduce(lambda a, b: a | b, hits)
    return flagged.withColumn(name, ~any_bad).drop(*[f"_bad{i}" for i in range(len(columns))])


def split_by_files(df: DataFrame, columns: list[str], headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose files are all usable, other rows)."""
    flagged = flag_files(df, columns, headers)
    return flagged.filter("file_ok").drop("file_ok"), flagged.filter("NOT file_ok").drop("file_ok")
