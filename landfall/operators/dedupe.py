"""Duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.operators.counts import count_by


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key under ``order``, which should be a total order.

    Filtering on the row number lets Spark keep one row per key in every map
    task before the shuffle, so a key with very many rows is never gathered.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", rank).filter("_nth = 1").drop("_nth")


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return count_by(df, keys, name, at_least=2)
