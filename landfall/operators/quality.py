"""Data-quality checks.

Checks are lazy and share one layout (``check``, ``target``, ``measured``,
``expected``, ``passed``), so they can be united and enforced together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.sets import union_sources


class QualityError(Exception):
    """Raised when a check fails."""


def _result(check: str, target: str, measured: Column, expected: Column, passed: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        measured.cast("bigint").alias("measured"),
        expected.cast("bigint").alias("expected"),
        passed.alias("passed"),
    ]


def check_non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its number of rows, which must not be 0."""
    results = []
    for name, df in tables.items():
        rows = df.agg(F.count(F.lit(1)).alias("_rows"))
        results.append(rows.select(*_result("non_empty", name, F.col("_rows"), F.lit(1), F.col("_rows") > 0)))
    return union_sources(*results)


def check_counts(spark: SparkSession, counts: Sequence[tuple[str, str, int, int, bool]]) -> DataFrame:
    """Checks of counts that are known already, such as those a write has taken: check, target, measured, expected, passed."""
    layout = "check string, target string, measured bigint, expected bigint, passed boolean"
    return spark.createDataFrame(list(counts), layout)


def check_unique(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Number of different keys against number of rows, NULL being a key too."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    totals = per_key.agg(F.count(F.lit(1)).alias("_keys"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"))
    return totals.select(
        *_result("unique", target, F.col("_keys"), F.col("_rows"), F.col("_keys") == F.col("_rows"))
    )


def reconcile(parts: Sequence[DataFrame], total: DataFrame, target: str) -> DataFrame:
    """Rows of the parts together against rows of the total."""
    counts = [p.agg(F.count(F.lit(1)).alias("_parts"), F.lit(0).cast("bigint").alias("_total")) for p in parts]
    counts.append(total.agg(F.lit(0).cast("bigint").alias("_parts"), F.count(F.lit(1)).alias("_total")))
    sums = union_sources(*counts).agg(F.sum("_parts").alias("_parts"), F.sum("_total").alias("_total"))
    return sums.select(
        *_result("reconcile", target, F.col("_total"), F.col("_parts"), F.col("_total") == F.col("_parts"))
    )


def reconcile_filters(df: DataFrame, parts: Sequence[Column], target: str) -> DataFrame:
    """Like :func:`reconcile` for parts that are filters of one table: a single pass over it.

    A row that meets several filters counts for each.
    """
    taken = [F.count_if(part) for part in parts]
    sums = df.agg(F.count(F.lit(1)).alias("_total"), reduce(lambda a, b: a + b, taken).alias("_parts"))
    return sums.select(
        *_result("reconcile", target, F.col("_total"), F.col("_parts"), F.col("_total") == F.col("_parts"))
    )


def check_no_rejects(df: DataFrame, rejects: str, target: str) -> DataFrame:
    """Number of lines that a reader has kept in ``rejects``, which must be 0. Land raw files first."""
    rows = df.agg(F.count(F.col(rejects)).alias("_rejects"))
    return rows.select(*_result("no_rejects", target, F.col("_rejects"), F.lit(0), F.col("_rejects") == 0))


def match_rate(df: DataFrame, dim: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """How many rows of ``df`` have a partner in ``dim``: ``rows``, ``matched``, ``percent``.

    Both sides are reduced to their different keys before they meet.
    """
    per_key = df.groupBy(*pairs).agg(F.count(F.lit(1)).alias("_rows"))
    known = dim.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(pairs.values())]).distinct()
    known = known.withColumn("_known", F.lit(True))
    condition = reduce(lambda a, b: a & b, [per_key[c] == known[f"_{i}"] for i, c in enumerate(pairs)])
    return (
        per_key.join(known, condition, "left")
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_known"), F.col("_rows"))), F.lit(0)).alias("matched"),
        )
        .withColumn("percent", F.try_divide(F.col("matched") * 100, F.col("rows")))
    )


def profile(df: DataFrame, distincts: str | None = None) -> DataFrame:
    """One row per column: position, name, type, rows, nulls and maybe distinct values.

    ``distincts`` is ``"approximate"`` (a sketch, in the same pass) or
    ``"exact"`` (NULL not counted). An exact count goes column by column, each
    with a scan and a shuffle of that column's different values, so no row is
    copied for every column.
    """
    if distincts == "exact":
        return union_sources(*[_exact_column(df, i, *pair) for i, pair in enumerate(df.dtypes)])
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(df.columns):
        aggregates.append(F.count_if(F.col(f"`{name}`").isNull()).alias(f"_nulls{i}"))
        if distincts is not None:
            aggregates.append(F.approx_count_distinct(F.col(f"`{name}`")).alias(f"_distinct{i}"))
    entries = []
    for i, (name, dtype) in enumerate(df.dtypes):
        entry = [*_column_name(i, name, dtype), F.col("_rows").alias("rows"), F.col(f"_nulls{i}").alias("nulls")]
        if distincts is not None:
            entry.append(F.col(f"_distinct{i}").alias("distinct_values"))
        entries.append(F.struct(*entry))
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def _column_name(i: int, name: str, dtype: str) -> list[Column]:
    return [F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(dtype).alias("type")]


def _exact_column(df: DataFrame, i: int, name: str, dtype: str) -> DataFrame:
    values = df.groupBy(F.col(f"`{name}`").alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    totals = values.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_rows"))), F.lit(0)).alias("nulls"),
        F.count("_value").alias("distinct_values"),
    )
    return totals.select(*_column_name(i, name, dtype), "rows", "nulls", "distinct_values")


def enforce(checks: DataFrame) -> None:
    """Run checks, one row each, and raise on the ones that fail."""
    failures = checks.filter(~F.coalesce("passed", F.lit(False))).collect()
    if failures:
        raise QualityError("; ".join(f"{r.check} {r.target}: {r.measured}, expected {r.expected}" for r in failures))
