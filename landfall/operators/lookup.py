"""Joins to dimensions.

No join is hinted to broadcast except tables stated in code: Spark broadcasts
whatever is below its size threshold, at planning time or after measuring a
shuffle, and otherwise runs a sort-merge join whose hot keys are split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import as_column


def add_label(
    df: DataFrame,
    key,
    table: DataFrame,
    table_key: str,
    label: str,
    name: str | None = None,
    default=None,
    unique: bool = False,
) -> DataFrame:
    """Left lookup of ``label`` by ``key``; every row of ``df`` appears exactly once.

    ``default`` (a value, or a column such as the key itself) replaces the
    label of unknown keys. A column of that name in ``df`` is replaced. Of
    several labels for a key the smallest is taken (see
    :func:`landfall.operators.check_unique`); ``unique`` states that the table is
    known to have one row per key, as literal tables do, and saves that step. As
    a key has one label, a lookup whose label is not used costs nothing.
    """
    name = name or label
    lookup = table.select(F.col(table_key).alias("_key"), F.col(label).alias("_label"))
    if not unique:
        lookup = lookup.groupBy("_key").agg(F.min("_label").alias("_label"))
    found = F.col("_label")
    if default is not None:
        found = F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
    joined = df.join(lookup, as_column(key) == lookup["_key"], "left")
    return joined.withColumn(name, found).drop("_key", "_label")


def keep_valid_codes(df: DataFrame, key: str, codes: DataFrame, code: str = "code") -> DataFrame:
    """Rows whose code is in the list. Unlike an inner join, repeated codes do no harm."""
    listed = codes.select(F.col(code).alias("_code"))
    return df.join(listed, df[key] == listed["_code"], "left_semi")


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without a NULL in ``cols``, as predicates that reach the file scan."""
    for col in cols:
        df = df.filter(F.col(col).isNotNull())
    return df


def conform(df: DataFrame, dim: DataFrame, pairs: Mapping[str, str], null_safe: bool = False) -> DataFrame:
    """Inner join on (column of ``df`` -> column of ``dim``) pairs, keeping all columns.

    Equality is exact in case and spelling. One row of ``df`` that meets
    several rows of ``dim`` fans out, so aggregate measures before this join.
    """
    condition = None
    for left, right in pairs.items():
        equal = df[left].eqNullSafe(dim[right]) if null_safe else df[left] == dim[right]
        condition = equal if condition is None else condition & equal
    return df.join(dim, condition, "inner")
