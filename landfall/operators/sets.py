"""Unions and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.sources.literals import literal_table


def union_sources(*dfs: DataFrame) -> DataFrame:
    """All rows of all sources, matched by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def append_members(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Add constant rows, such as the "unknown" members of a dimension."""
    return df.unionByName(literal_table(df.sparkSession, rows, df.schema))


def project(df: DataFrame, columns: Mapping[str, str] | Sequence[str], casts: Mapping[str, str] | None = None) -> DataFrame:
    """Select by name, optionally renaming (old -> new) and casting (new -> type).

    Casts give NULL for text that does not convert.
    """
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    casts = casts or {}
    out = []
    for old, new in names.items():
        col = F.col(f"`{old}`")
        out.append((col.try_cast(casts[new]) if new in casts else col).alias(new))
    return df.select(*out)
