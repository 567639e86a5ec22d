"""Column names that don't clash with those of the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_columns(df: DataFrame) -> list[Column]:
    return [column(c) for c in df.columns]
