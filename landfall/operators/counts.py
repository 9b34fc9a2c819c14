"""Counting and top-k. Counts combine on the map side, so a hot key costs little."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n", at_least: int | None = None) -> DataFrame:
    """Rows per key, optionally only keys with ``at_least`` that many."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts if at_least is None else counts.filter(F.col(name) >= at_least)


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Frequency of each value, most frequent first."""
    return count_by(df, [col], name).orderBy(F.desc(name), col)


def global_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, cols: Sequence[str], name: str = "n", approximate: bool = False) -> DataFrame:
    """Number of different rows over ``cols``, NULL being a value too.

    ``approximate`` estimates it in one pass, without a shuffle of the values.
    """
    if approximate:
        return df.agg(F.approx_count_distinct(F.xxhash64(*cols)).alias(name))
    return global_count(df.select(*cols).distinct(), name)


def top_k(df: DataFrame, k: int, by: str, tiebreak: Sequence[str], ascending: bool = False) -> DataFrame:
    """The k rows with the largest ``by``, or the smallest, NULL last. The tie-break columns make the order total."""
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.orderBy(order, *tiebreak).limit(k)


def last_k(df: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """The last k rows in the order of ``by``, in that order.

    Sorts the other way round, so each task keeps k rows only.
    """
    return df.orderBy(*[F.desc(c) for c in by]).limit(k).orderBy(*by)
