"""Frequent values of all columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values tracked for each that can be frequent: a sketch's error then is far below the share asked for.
TRACKED = 20


def _keyed(name: str, dtype: str) -> Column:
    """A column's values as the sketch tracks them: texts, of any length, by their hash."""
    column = F.col(f"`{name}`")
    return F.when(column.isNotNull(), F.xxhash64(column)) if dtype == "string" else column


def frequent_values(df: DataFrame, share: float = 0.05) -> DataFrame:
    """Every value that makes up at least ``share`` of a column: ``column``, ``value``, ``rows``.

    Two scans whatever the number of columns. A heavy-hitter sketch per column names
    the candidates, 1 / ``share`` at most and surely all that are frequent; a second
    scan counts exactly those. NULL is a value; ``value`` is its text. Texts are told
    apart by a 64-bit hash. Columns that cannot be compared, such as maps, are left out.
    """
    spark = df.sparkSession
    columns = [(name, dtype) for name, dtype in df.dtypes if not dtype.startswith(("map", "array", "struct", "variant", "binary"))]
    most = math.ceil(1 / share)
    sketched = [
        F.expr(f"approx_top_k(_{i}, {most}, {TRACKED * most})").alias(f"_{i}") for i in range(len(columns))
    ]
    keyed = df.select(*[_keyed(name, dtype).alias(f"_{i}") for i, (name, dtype) in enumerate(columns)])
    found = keyed.agg(*sketched).first()  # the candidates: 1 / share for each column
    counts, entries = [F.count(F.lit(1)).alias("_all")], []
    for i, (name, dtype) in enumerate(columns):
        for j, candidate in enumerate(found[i]):
            held = _keyed(name, dtype).eqNullSafe(F.lit(candidate.item).cast("bigint" if dtype == "string" else dtype))
            counts.append(F.count_if(held).alias(f"_n{i}_{j}"))
            counts.append(F.min(F.when(held, F.col(f"`{name}`"))).cast("string").alias(f"_v{i}_{j}"))
            entries.append(
                F.struct(F.lit(name).alias("column"), F.col(f"_v{i}_{j}").alias("value"), F.col(f"_n{i}_{j}").alias("rows"))
            )
    if not entries:
        return spark.createDataFrame([], "column string, value string, rows bigint")
    exact = df.agg(*counts).select("_all", F.explode(F.array(*entries)).alias("_e")).select("_all", "_e.*")
    return exact.filter((F.col("rows") > 0) & (F.col("rows") >= F.col("_all") * share)).drop("_all")
