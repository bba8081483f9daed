"""Cleaning steps for use with ``DataFrame.transform``.  Each is one projection or filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Replace several columns in one projection."""
    return df.withColumns(new) if new else df


def computed_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep costly column expressions from being repeated in the filters that follow.

    The optimizer moves a filter below the projection that computes its column, and so computes it twice.  It does not
    move a filter below the generator used here, which yields one row per row.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.inline(F.array(F.struct(*columns)))
    return df.select(*kept, made).select(*df.columns)


def lookup(df: DataFrame, key: str, mapping: DataFrame | dict, name: str) -> DataFrame:
    """Add ``name``: the value of ``key`` in a mapping; NULL when absent.

    A dict becomes a literal map and suits small mappings.  A DataFrame (two columns: key, value; one row per key) is
    left-joined, so Spark decides by its size how to join.
    """
    if isinstance(mapping, dict):
        pairs = [F.lit(part) for pair in mapping.items() for part in pair]
        return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(key)))
    map_key, map_value = mapping.columns
    side = mapping.select(F.col(map_key).alias("_map_key"), F.col(map_value).alias(name))
    return df.join(side, F.col(key) == F.col("_map_key"), "left").drop("_map_key")


def unwrap(df: DataFrame, wrappers: tuple[str, ...] = ("data", "result", "response")) -> DataFrame:
    """Open wrapper structs: while a top-level wrapper column is a struct, its fields become the columns."""
    wrapper = next(
        (w for w in wrappers if w in df.columns and isinstance(df.schema[w].dataType, T.StructType)), None
    )
    return unwrap(df.select(f"`{wrapper}`.*"), wrappers) if wrapper else df


def _leaves(schema: T.StructType, parents: tuple[str, ...] = ()):
    for field in schema.fields:
        path = (*parents, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, path)
        else:
            yield path


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """All struct levels to top-level columns named by their path."""
    return df.select(
        *[F.col(".".join(f"`{part}`" for part in path)).alias(separator.join(path)) for path in _leaves(df.schema)]
    )


def flatten_one_level(df: DataFrame) -> DataFrame:
    """Struct columns to ``parent_child`` columns after the plain ones; deeper structs stay."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.StructType)]
    nested = [
        F.col(f"`{f.name}`.`{child}`").alias(f"{f.name}_{child}")
        for f in df.schema.fields
        if isinstance(f.dataType, T.StructType)
        for child in f.dataType.names
    ]
    return df.select(*plain, *nested)


def normalise_times(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """String columns with ``time`` or ``date`` in their name to ISO text; unreadable values stay as they are."""
    if columns is None:
        columns = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and any(mark in f.name.lower() for mark in ("time", "date"))
        ]
    iso = lambda c: F.date_format(F.try_to_timestamp(F.col(c)), "yyyy-MM-dd'T'HH:mm:ss")
    return _replace(df, {c: F.coalesce(iso(c), F.col(c)) for c in columns})


def null_empty(df: DataFrame) -> DataFrame:
    """Empty strings, arrays and maps to NULL."""
    new = {}
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            new[field.name] = F.nullif(column, F.lit(""))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            new[field.name] = F.when(F.size(column) > 0, column)
    return _replace(df, new)


def enforce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes NULL."""
    return _replace(df, {c: F.col(c).try_cast(t) for c, t in types.items()})


def drop_duplicate_rows(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.dropDuplicates(subset)


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with no NULL in the given columns."""
    return df.dropna(subset=columns)


def valid_age(df: DataFrame, column: str = "age") -> DataFrame:
    return df.filter((F.col(column) >= 0) & (F.col(column) < 120))


def valid_time(df: DataFrame, column: str) -> DataFrame:
    """Parse a string column to timestamp and keep the rows where that works."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column))).filter(F.col(column).isNotNull())


def normalise_text(df: DataFrame, columns: list[str], keep_pattern: str = r"[\w\s]+") -> DataFrame:
    """Lower case without punctuation: only the parts that match ``keep_pattern`` stay.

    The default keeps ASCII word characters and spaces; ``(?U)[\\w\\s]+`` keeps the letters of all scripts.  Joining the
    parts to keep is several times faster than replacing every other character.
    """
    kept = lambda c: F.array_join(F.regexp_extract_all(F.col(c), F.lit(keep_pattern), F.lit(0)), "")
    return _replace(df, {c: F.lower(kept(c)) for c in columns})


def trim_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return _replace(df, {c: F.trim(F.col(c)) for c in columns})


def min_length(df: DataFrame, column: str, length: int = 3) -> DataFrame:
    return df.filter(F.length(F.col(column)) >= length)


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """NULL to a default per column."""
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) >= 0)
