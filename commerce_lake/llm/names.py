"""Names for internal columns beside those of an input table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_prefix(df: DataFrame, start: str = "__") -> str:
    """A prefix that no column of ``df`` begins with, in any spelling of its letters."""
    p = start
    while any(c.lower().startswith(p) for c in df.columns):
        p += "_"
    return p
