"""Rows of a frame for comparison."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
