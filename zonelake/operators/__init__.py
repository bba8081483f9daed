"""DataFrame operators: dedup, reshape, filters, quality, integrity, windows, statistics."""
