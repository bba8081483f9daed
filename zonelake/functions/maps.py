"""Maps from columns and structs, and maps to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def columns_as_map(names: list[str], value_type: str | T.DataType = "double") -> Column:
    """Map of column name to the column's value, all cast to one type."""
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in names]),
        F.array(*[F.col(f"`{name}`").cast(value_type) for name in names]),
    )


def struct_as_map(df: DataFrame, path: str) -> Column:
    """Map of field name to value for the struct at a dotted path.

    Raises ValueError when the path is missing or is not a struct.  All fields need one common type.
    """
    try:
        data_type = df.select(F.col(path)).schema[0].dataType
    except AnalysisException as missing:
        raise ValueError(f"column path '{path}' is not in the schema") from missing
    if not isinstance(data_type, T.StructType):
        raise ValueError(f"column path '{path}' is {data_type.simpleString()}, not a struct")
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in data_type.names]),
        F.array(*[F.col(path).getField(name) for name in data_type.names]),
    )


def map_to_rows(df: DataFrame, entries: Column | str, key: str, value: str, outer: bool = False) -> DataFrame:
    """One row per map entry; the other columns stay.  ``outer`` keeps rows with an empty or NULL map."""
    entries = F.col(entries) if isinstance(entries, str) else entries
    generate = F.explode_outer if outer else F.explode
    return df.select("*", generate(entries).alias(key, value))


def array_to_rows(df: DataFrame, array: str, name: str, outer: bool = True) -> DataFrame:
    """One row per array element; ``outer`` keeps rows with an empty or NULL array."""
    return df.withColumn(name, (F.explode_outer if outer else F.explode)(F.col(array)))


def array_to_indexed_rows(df: DataFrame, array: str, index: str = "idx", value: str = "val") -> DataFrame:
    """One row per array element with its 0-based position."""
    return df.select("*", F.posexplode(F.col(array)).alias(index, value))
