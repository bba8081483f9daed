"""Dates, numbers, labels, URLs and file signatures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---------------------------------------------------------------- dates


def month_key(ts: Column | str) -> Column:
    """``2024-03`` for any moment of March 2024."""
    return F.date_format(to_col(ts), "yyyy-MM")


def quarter_start(year: Column | str, quarter: Column | str) -> Column:
    """First day of a quarter; NULL when the quarter is not 1 to 4."""
    y, q = to_col(year).cast("int"), to_col(quarter).cast("int")
    return F.when(q.between(1, 4), F.make_date(y, q * 3 - 2, F.lit(1)))


def parse_time(text: Column | str) -> Column:
    """String to timestamp, ISO offsets included; text that is no time gives NULL."""
    return F.try_to_timestamp(to_col(text))


def epoch_millis(value: Column | str) -> Column:
    return F.timestamp_millis(to_col(value))


# ---------------------------------------------------------------- numbers and labels


def number_or_zero(value: Column | str, data_type: str = "double") -> Column:
    """Numeric cast with 0 for missing or unreadable input."""
    return F.coalesce(to_col(value).try_cast(data_type), F.lit(0).cast(data_type))


def three_way(score: Column, low: float = -0.2, high: float = 0.2) -> Column:
    """``positive`` above ``high``, ``negative`` below ``low``, otherwise ``neutral``."""
    return F.when(score > high, "positive").when(score < low, "negative").otherwise("neutral")


def squash(total: Column, alpha: float = 15.0) -> Column:
    """Map an unbounded score to (-1, 1): s / sqrt(s*s + alpha)."""
    return total / F.sqrt(total * total + F.lit(alpha))


def item(array: Column, position: Column) -> Column:
    """0-based element, NULL outside the array (also under ANSI mode)."""
    return F.get(array, position)


# ---------------------------------------------------------------- URLs


def url_container(url: Column | str) -> Column:
    """Bucket or host of ``scheme://container/key``; NULL when the text has no such form."""
    return F.nullif(F.regexp_extract(to_col(url), r"^[^:/]+://([^/]+)/", 1), F.lit(""))


def url_key(url: Column | str) -> Column:
    """Object key of ``scheme://container/key``; NULL when the text has no such form."""
    return F.nullif(F.regexp_extract(to_col(url), r"^[^:/]+://[^/]+/(.+)$", 1), F.lit(""))


# ---------------------------------------------------------------- file signatures

# Fixed values: (kind, first byte position counted from 1, hex bytes).  Public file signatures.
SIGNATURES = (
    ("pdf", 1, "255044462D"),
    ("jpeg", 7, "4A464946"),
    ("jpeg", 7, "45786966"),
    ("jpeg", 1, "FFD8FFDB"),
    ("png", 1, "89504E470D0A1A0A"),
    ("gif", 1, "474946383761"),
    ("gif", 1, "474946383961"),
    ("tiff", 1, "4D4D"),
    ("tiff", 1, "4949"),
    ("rgb", 1, "01DA"),
    ("rast", 1, "59A66A95"),
    ("xbm", 1, "23646566696E6520"),
    ("bmp", 1, "424D"),
    ("exr", 1, "762F3101"),
)
# Portable bitmap families, second byte of ``P1`` to ``P6``.
PORTABLE_BITMAPS = (("pbm", "14"), ("pgm", "25"), ("ppm", "36"))


def media_kind(head: Column | str) -> Column:
    """Kind of a PDF or image from its first bytes; NULL for anything else."""
    text = F.hex(to_col(head))
    tests = [
        (kind, F.substring(text, 2 * position - 1, len(signature)) == signature)
        for kind, position, signature in SIGNATURES
    ]
    tests += [(kind, text.rlike(f"^503[{digits}](20|09|0A|0D)")) for kind, digits in PORTABLE_BITMAPS]
    tests.append(("webp", text.rlike("^52494646.{8}57454250")))
    first_match = reduce(lambda chain, test: chain.when(test[1], test[0]), tests[1:], F.when(tests[0][1], tests[0][0]))
    return first_match


def png_size(head: Column | str) -> Column:
    """Struct (width, height) from a PNG header; NULL for other kinds."""
    text = F.hex(to_col(head))
    number = lambda start: F.conv(F.substring(text, start, 8), 16, 10).cast("bigint")
    return F.when(
        media_kind(head) == "png", F.struct(number(33).alias("width"), number(41).alias("height"))
    )
