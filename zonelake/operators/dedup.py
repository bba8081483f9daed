"""Duplicates within a batch and against history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

_KEY = "_dedup_key"


def _ordering(columns: list[str], keep: str) -> list[Column]:
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    return [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in columns]


def _first_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None, keep: str) -> DataFrame:
    if not order_by:
        return df.dropDuplicates(keys)
    # Spark turns "row_number = 1" into a group limit that also runs before the shuffle, so each map task sends at
    # most one row per key and a hot key costs no more than any other.
    spec = Window.partitionBy(*keys).orderBy(*_ordering(order_by, keep))
    return df.withColumn("_rank", F.row_number().over(spec)).filter("_rank = 1").drop("_rank")


def keep_one(df: DataFrame, keys: list[str], order_by: list[str] | None = None, keep: str = "first") -> DataFrame:
    """One row per key: the first or last by ``order_by``, or any row when no order is given.  NULL keys are equal."""
    return _first_per_key(df, keys, order_by, keep)


def within_key_range(history: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Rows of ``history`` inside the batch's range of one non-NULL key column.

    The range is a scalar subquery, so it prunes partitions and row groups of a large history before the join.
    """
    low = batch.agg(F.min(column)).scalar()
    high = batch.agg(F.max(column)).scalar()
    return history.filter(F.col(column).between(low, high))


def exclude_existing(
    df: DataFrame,
    history: DataFrame,
    keys: list[str],
    null_safe: bool = True,
    range_column: str | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``history``.

    ``null_safe`` makes NULL keys match each other; without it a row with a NULL in its key always stays.
    ``range_column`` names a key column without NULLs to prune the history by (see :func:`within_key_range`).
    """
    if range_column:
        history = within_key_range(history, df, range_column)
    if not null_safe:
        return df.join(history.select(*keys).distinct(), keys, "left_anti")
    # Struct equality compares NULL fields as equal, so one ordinary equi-join is null-safe.
    return _anti_on_struct(df.withColumn(_KEY, F.struct(*keys)), history, keys).drop(_KEY)


def _anti_on_struct(df: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    # Distinct, so that a key with many rows of history is combined before the shuffle.
    return df.join(history.select(F.struct(*keys).alias(_KEY)).distinct(), _KEY, "left_anti")


def deduplicate(
    df: DataFrame,
    keys: list[str],
    history: DataFrame | None = None,
    order_by: list[str] | None = None,
    keep: str = "first",
    null_safe: bool = True,
    range_column: str | None = None,
    counts: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """:func:`keep_one`, then :func:`exclude_existing`; the batch is shuffled by its key once for both steps.

    ``counts`` are two observations that receive ``rows`` before and after while the result is computed.  They are
    meant for monitoring: a stage that is run again after a lost executor may count twice.
    """
    if counts:
        df = df.observe(counts[0], F.count(F.lit(1)).alias("rows"))
    if history is not None and range_column:
        history = within_key_range(history, df, range_column)
    if history is None:
        result = _first_per_key(df, keys, order_by, keep)
    elif not null_safe:
        result = exclude_existing(_first_per_key(df, keys, order_by, keep), history, keys, null_safe=False)
    else:
        keyed = _first_per_key(df.withColumn(_KEY, F.struct(*keys)), [_KEY], order_by, keep)
        result = _anti_on_struct(keyed, history, keys).drop(_KEY)
    return result.observe(counts[1], F.count(F.lit(1)).alias("rows")) if counts else result


def rows_to_insert(
    batch: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """Insert-if-absent: the rows of ``batch`` to append so that existing keys stay untouched."""
    return deduplicate(batch, keys, history=target, order_by=order_by)


def with_exists_flag(df: DataFrame, probe: DataFrame | None, keys: list[str], name: str = "exists") -> DataFrame:
    """Add a boolean: does the key occur in ``probe``?  A missing probe table gives false."""
    if probe is None:
        return df.withColumn(name, F.lit(False))
    known = probe.select(*keys).dropna().distinct().withColumn(name, F.lit(True))
    return df.join(known, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
