"""Column names that operators may use inside without touching a caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until ``df`` has no column of it in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(df: DataFrame) -> list[str]:
    """The columns of ``df`` as names that may hold dots."""
    return [f"`{c}`" for c in df.columns]
