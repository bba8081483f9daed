"""Tokens and term counts inside one row: no explode, no shuffle."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of two or more word characters, in any script.
WORD_PATTERN = r"(?U)\b\w\w+\b"


def words(text: Column | str, pattern: str = WORD_PATTERN) -> Column:
    """Lower-case words of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def default_stop_words(language: str = "english") -> list[str]:
    """Spark's own stop-word list."""
    return StopWordsRemover.loadDefaultStopWords(language)


def drop_words(tokens: Column, stop_words: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(stop_words)) if stop_words else tokens


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time per row.

    A plain column reference would not do: when a filter is pushed down, the optimizer puts the defining expression in
    place of the reference, and inside a lambda that would mean once per array element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """Array of (term, n) for an array of tokens, in term order; no tokens give an empty array.

    The sorted tokens form runs; a run ends where the next one starts.  The cost per row is that of the sort, and
    nothing leaves the row, so neither long texts nor frequent words meet in one task.
    """

    empty = F.array().cast("array<struct<term:string,n:int>>")

    def runs(words: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(words)), lambda i: (i == 1) | (F.get(words, i - 1) != F.get(words, i - 2))
        )
        counted = _once(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(words, start - 1).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(words) + 1) - start).alias("n"),
                ),
            ),
        )
        return F.when(F.size(words) > 0, counted).otherwise(empty)

    return _once(F.sort_array(F.coalesce(tokens, F.array().cast("array<string>"))), runs)


def most_frequent(terms: Column | str, k: int = 2) -> Column:
    """The ``k`` terms with the highest counts (ties: smaller term), in alphabetical order."""
    terms = F.col(terms) if isinstance(terms, str) else terms
    ranked = F.sort_array(F.transform(terms, lambda t: F.struct((-t["n"]).alias("rank"), t["term"].alias("term"))))
    return F.sort_array(F.transform(F.slice(ranked, 1, k), lambda t: t["term"]))
