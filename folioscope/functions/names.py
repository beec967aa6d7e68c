"""Column names that no table has yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, with as many underscores behind it as it takes to differ from all columns."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name
