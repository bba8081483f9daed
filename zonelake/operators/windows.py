"""Differences to the previous row, and order checks that do not put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def change_over_previous(
    df: DataFrame, keys: list[str], order_by: str, value: str, name: str = "change"
) -> DataFrame:
    """``value`` minus the previous value of the group.

    Meant for series with one row per key and period (the trusted key), so a group is no longer than its calendar.
    """
    spec = Window.partitionBy(*keys).orderBy(order_by)
    return df.withColumn(name, F.col(value) - F.lag(value).over(spec))


def order_violations(
    df: DataFrame,
    column: str,
    order_by: list[str],
    partition_by: list[str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """One row per group: ``n`` rows and the number of rows that do not increase over the row before them.

    NULL values are skipped.  Rows are range-partitioned by (group, order), so one long group spreads over many tasks.
    Each task compares neighbours inside its range; the ends of the ranges, a few rows per task, are compared after.
    """
    groups = partition_by or []
    group_cols = [F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)]
    order_cols = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    group_names = [f"_g{i}" for i in range(len(groups))]
    order_names = [f"_o{i}" for i in range(len(order_by))]

    ranged = (
        df.filter(F.col(column).isNotNull())
        .select(*group_cols, *order_cols, F.col(column).alias("_v"))
        .repartitionByRange(*group_names, *order_names)
        .withColumn("_range", F.spark_partition_id())
    )
    falls = (lambda now, before: now <= before) if strict else (lambda now, before: now < before)

    inside = Window.partitionBy("_range", *group_names).orderBy(*order_names)
    ends = (
        ranged.withColumn("_fall", falls(F.col("_v"), F.lag("_v").over(inside)))
        .groupBy("_range", *group_names)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if("_fall").alias("_falls"),
            F.min_by("_v", F.struct(*order_names)).alias("_first"),
            F.max_by("_v", F.struct(*order_names)).alias("_last"),
        )
    )
    across = Window.partitionBy(*group_names) if groups else Window.partitionBy(F.lit(0))
    stitched = ends.withColumn("_edge", falls(F.col("_first"), F.lag("_last").over(across.orderBy("_range"))))
    return stitched.groupBy(*[F.col(g).alias(c) for g, c in zip(group_names, groups)]).agg(
        F.sum("_n").alias("n"), (F.sum("_falls") + F.count_if("_edge")).alias("violations")
    )
