"""Row filters.  Bounds that come from data are scalar subqueries, so they stay lazy and on the executors."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newer_than(df: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """High-water mark: rows above the largest loaded value; all rows when nothing is loaded yet.

    The condition is a plain comparison with one scalar, so it reaches the scan.  With nothing loaded it is not there.
    """
    mark = loaded.agg(F.max(column).alias("mark"))
    if mark.filter(F.col("mark").isNotNull()).isEmpty():
        return df
    return df.filter(F.col(column) > mark.scalar())


def last_years(df: DataFrame, column: str = "year", years: int = 25) -> DataFrame:
    """Rows with ``column >= max(column) - years``."""
    # Subtracted inside the subquery, so that the scan gets one value to compare with.
    return df.filter(F.col(column) >= df.agg(F.max(column) - years).scalar())


def months_back(df: DataFrame, column: str, as_of: datetime.date | str, months: int = 6) -> DataFrame:
    """Rows from ``months`` before ``as_of`` up to ``as_of``, both days included.

    The bounds are plain literals of the column's kind, so they reach the parquet scan.
    """
    day = datetime.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    first = F.add_months(F.lit(day), -months)
    after = F.date_add(F.lit(day), 1)
    kind = df.schema[column].dataType.simpleString()
    return df.filter((F.col(column) >= first.cast(kind)) & (F.col(column) < after.cast(kind)))


def first_entries(df: DataFrame, order_by: list[str], n: int | None = None) -> DataFrame:
    """Big mode, the default, takes everything; small mode takes the first ``n`` source entries."""
    return df if n is None else df.orderBy(*order_by).limit(n)


def nested_series(df: DataFrame, values: str, indicator: Column, country: Column, name: str = "series") -> DataFrame:
    """Look up ``values[indicator][country]`` and skip rows where it is missing or empty."""
    found = F.try_element_at(F.try_element_at(F.col(values), indicator), country)
    return df.withColumn(name, found).filter(F.col(name).isNotNull() & (F.size(name) > 0))


def equals_ignoring_case(column: Column | str, text: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(column) == text.lower()


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a NULL in ``columns`` (default: in any column)."""
    return df.dropna(subset=columns)


def flag_membership(df: DataFrame, members: DataFrame, column: str, name: str = "listed") -> DataFrame:
    """Add a boolean, never NULL: the value is in ``members``.  One join for both answers."""
    listed = members.select(F.col(members.columns[0]).alias("_member")).dropna().distinct().withColumn("_hit", F.lit(True))
    flagged = df.join(listed, F.col(column) == F.col("_member"), "left")
    return flagged.withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_member", "_hit")


def split_by_membership(df: DataFrame, members: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose value is in ``members``, all other rows).  NULL values are in the second part.

    Members are made distinct, which combines a frequent one before the shuffle.  Each part has its own join, which suits
    users of one of them; :func:`flag_membership` answers for all rows at once.
    """
    listed = members.select(F.col(members.columns[0]).alias(column)).dropna().distinct()
    return df.join(listed, column, "left_semi"), df.join(listed, column, "left_anti")
