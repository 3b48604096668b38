"""Column names beside those of a caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
