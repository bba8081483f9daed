"""Every operator bound to the given tables, each with the SQL that gives the same rows.

A binding names its columns as the operator's own input does (users, transactions, articles, ...), applies the
operator, and casts the result to types that both engines share.
"""

from bindings.registry import ORACLES, QUERIES
from bindings import marts, reshape, dedup, quality, filters, text, streams, learn, clean, storage  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
