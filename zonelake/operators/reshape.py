"""Nested and wide snapshots to long tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas of the landed documents (fixed values: field names and types of the source APIs).
RATES_SCHEMA = (
    "dataSets ARRAY<STRUCT<series: MAP<STRING, STRUCT<observations: MAP<STRING, ARRAY<DOUBLE>>>>>>, "
    "structure STRUCT<dimensions: STRUCT<"
    "series: ARRAY<STRUCT<values: ARRAY<STRUCT<id: STRING>>>>, "
    "observation: ARRAY<STRUCT<values: ARRAY<STRUCT<id: STRING>>>>>>"
)
_LINE_ITEM = "STRUCT<concept: STRING, label: STRING, unit: STRING, value: DOUBLE>"
STATEMENTS_SCHEMA = (
    "symbol STRING, year INT, quarter INT, "
    f"report STRUCT<bs: ARRAY<{_LINE_ITEM}>, cf: ARRAY<{_LINE_ITEM}>, ic: ARRAY<{_LINE_ITEM}>>"
)
NEWS_SCHEMA = (
    "date STRING, title STRING, link STRING, content STRING, "
    "sentiment STRUCT<neg: DOUBLE, neu: DOUBLE, pos: DOUBLE, polarity: DOUBLE>, "
    "symbols ARRAY<STRING>, tags ARRAY<STRING>"
)


def year_columns(columns: list[str]) -> list[str]:
    """Column names that are four digits; none is an error."""
    years = [name for name in columns if re.fullmatch(r"[0-9]{4}", name)]
    if not years:
        raise ValueError("the table has no year columns")
    return years


def columns_to_rows(
    df: DataFrame, columns: list[str], key: str, value: str, keep: list[str] | None = None, value_type: str = "double"
) -> DataFrame:
    """Unpivot: one row per listed column, values cast to one type, NULL values kept."""
    keep = keep or []
    casted = df.select(*keep, *[F.col(f"`{c}`").cast(value_type).alias(c) for c in columns])
    return casted.unpivot(keep, [F.col(f"`{c}`") for c in columns], key, value)


def wide_years_to_long(df: DataFrame, indicator: Column | str) -> DataFrame:
    """One column per year to rows (year, indicator, value).  ``indicator`` is a name or a column of ``df``."""
    named = df.withColumn("_indicator", F.lit(indicator) if isinstance(indicator, str) else indicator)
    long = columns_to_rows(named, year_columns(df.columns), "year", "value", keep=["_indicator"])
    return long.select(F.col("year").cast("int").alias("year"), F.col("_indicator").alias("indicator"), "value")


def year_documents_to_long(df: DataFrame, indicator: Column, keep: list[str] | None = None) -> DataFrame:
    """JSON objects ``{"1980": 1.5, ...}`` in a text column ``value`` to rows (year, indicator, value).

    Read as a map, so that many documents with different years share one scan: a year that a document lacks gives no
    row, an explicit null gives a NULL value.  Keys that are not four digits are left out.
    """
    years = df.select(
        *(keep or []), indicator.alias("indicator"), F.explode(F.from_json("value", "MAP<STRING, DOUBLE>")).alias("year", "value")
    )
    return years.filter(F.col("year").rlike("^[0-9]{4}$")).select(
        *(keep or []), F.col("year").cast("int").alias("year"), "indicator", "value"
    )


def indicator_of_path(path: Column | str) -> Column:
    """Indicator name from a landing table path ``<indicator>/<snapshot>``."""
    return F.split_part(F.col(path) if isinstance(path, str) else path, F.lit("/"), F.lit(1))


def rates_to_long(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Exchange-rate documents to (time, currency, rate), read with :data:`RATES_SCHEMA`.

    A document names its time axis and its currencies once and refers to them by position: observation keys are
    positions on the time axis, the second part of a series key is a position among the currencies.  Both are looked
    up inside the row, so documents never mix and nothing is shuffled.  An observation off the time axis is dropped;
    an explicit NULL observation stays as a NULL rate; an unknown currency position gives a NULL currency.
    """
    keep = keep or []
    ids = lambda values: F.transform(values, lambda v: v["id"])
    documents = df.select(
        *keep,
        F.explode("dataSets").alias("data_set"),
        ids(F.get("structure.dimensions.observation", F.lit(0))["values"]).alias("times"),
        ids(F.get("structure.dimensions.series", F.lit(1))["values"]).alias("currencies"),
    )
    series = documents.select(*keep, "times", "currencies", F.explode("data_set.series").alias("series_key", "series"))
    # Name the currency before the observations multiply the rows, then carry only what they need.
    position = F.split_part("series_key", F.lit(":"), F.lit(2)).try_cast("int")
    observations = series.select(
        *keep,
        F.get("currencies", position).alias("currency"),
        F.explode(
            F.filter(
                F.transform(
                    F.map_entries("series.observations"),
                    lambda entry: F.struct(
                        entry["key"].try_cast("int").alias("at"),
                        F.get(F.col("times"), entry["key"].try_cast("int")).alias("time"),
                        F.get(entry["value"], F.lit(0)).alias("rate"),
                    ),
                ),
                lambda o: (o["at"] >= 0) & (o["at"] < F.size("times")),
            )
        ).alias("observation"),
    )
    return observations.select(
        *keep, F.try_to_timestamp("observation.time").alias("time"), "currency", "observation.rate"
    )


def statements_to_long(df: DataFrame, keep: list[str] | None = None, names: tuple[str, ...] = ("bs", "cf", "ic")) -> DataFrame:
    """Filings with one array per statement to line items; one scan serves all statements.

    A filing without lines for a statement gives one row with NULL in the line columns.
    """
    keep = keep or []
    filing = [*keep, "symbol", "year", "quarter"]
    statements = F.array(*[F.struct(F.lit(n).alias("statement"), F.col(f"report.{n}").alias("lines")) for n in names])
    return (
        df.select(*filing, F.explode(statements).alias("part"))
        .select(*filing, "part.statement", F.explode_outer("part.lines").alias("line"))
        .select(*filing, "statement", "line.concept", "line.label", "line.unit", "line.value")
    )


def flatten_news(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Articles with nested sentiment to flat rows; symbols and tags stay arrays.  Order with :func:`newest_first`."""
    scores = [F.col(f"sentiment.{part}").alias(f"sent_{part}") for part in ("neg", "neu", "pos", "polarity")]
    return df.select(
        *(keep or []),
        F.try_to_timestamp("date").alias("ts"),
        "date",
        "title",
        "link",
        "content",
        *scores,
        "symbols",
        "tags",
    )


def newest_first(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last())


def same_rows(df: DataFrame) -> DataFrame:
    """The transform of relational tables, which land in their final shape."""
    return df


def array_messages_to_rows(df: DataFrame, array: str = "data") -> DataFrame:
    """Messages that carry an array: one outgoing record per element (batch or stream)."""
    return df.select(F.explode(array).alias("_element")).select("_element.*")
