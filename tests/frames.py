"""Reading small results in tests."""

from __future__ import annotations


def rows(df, *columns):
    """The rows of ``df`` as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()),
                  key=lambda r: [(v is not None, v) for v in r])
