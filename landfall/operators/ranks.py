"""Dense ranks and shares within groups.

Groups such as "all cities, by ethnic group" are few and large. Neither
operator gathers such a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions.ratios import percent_of
from landfall.session import materialize


def attach(df: DataFrame, keyed: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Left join of one new column on equal (or both NULL) ``cols``."""
    keyed = keyed.select(*[F.col(c).alias(f"_{c}") for c in cols], F.col(name).alias("_new"))
    condition = reduce(lambda a, b: a & b, [df[c].eqNullSafe(keyed[f"_{c}"]) for c in cols])
    joined = df.drop(name).join(keyed, condition, "left")
    return joined.withColumn(name, F.col("_new")).drop("_new", *[f"_{c}" for c in cols])


def dense_rank_by(df: DataFrame, group: Sequence[str], by: str, name: str) -> DataFrame:
    """Dense rank within ``group`` by descending ``by``, NULL last, as ``bigint``.

    Equal values share a rank, so the different values are ranked by
    :func:`dense_ranks` and the rank is joined back. Reads ``df`` twice.
    """
    return attach(df, dense_ranks(df, group, by, name), [*group, by], name)


def dense_ranks(df: DataFrame, group: Sequence[str], by: str, name: str) -> DataFrame:
    """The different values of each group with their dense rank.

    The values are sorted across the cluster. Within a sort slice a rank counts
    from the first position of the group there, and the group's values in earlier
    slices are added. Writes the sorted values to the shared folder, so their
    places stay the same even if a lost executor is replaced; this starts while
    the plan is made.
    """
    group = list(group)
    values = df.select(*group, by).distinct()
    ordered = values.orderBy(*group, F.desc_nulls_last(by)).withColumn("_id", F.monotonically_increasing_id())
    # The ids hold the sort slice in the upper bits.
    ordered = materialize(ordered).select(
        *group,
        by,
        F.shiftright("_id", 33).alias("_slice"),
        F.col("_id").bitwiseAND((1 << 33) - 1).alias("_offset"),
    )
    pieces = ordered.groupBy("_slice", *group).agg(F.count(F.lit(1)).alias("_size"), F.min("_offset").alias("_first"))
    # A group has one row per sort slice here.
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first"))
    return attach(ordered, pieces, ["_slice", *group], "_before").select(
        *group, by, (F.col("_before") + F.col("_offset") + 1).alias(name)
    )


def share_of_total(
    df: DataFrame,
    part: Sequence[str],
    whole: Sequence[str],
    value: str,
    name: str,
) -> DataFrame:
    """Sum of ``value`` over ``part`` as a percentage of its sum over ``whole``.

    ``whole`` is a subset of ``part``. The sums are aggregates joined back, not
    windows: rows of a large whole stay spread over the cluster. The input and
    the sums are written to the shared folder, since each is used twice.
    """
    df = materialize(df)
    parts = materialize(df.groupBy(*part).agg(F.sum(value).alias("_sum")))
    wholes = parts.groupBy(*whole).agg(F.sum("_sum").alias("_total"))
    shares = attach(parts, wholes, list(whole), "_total").withColumn(name, percent_of("_sum", "_total"))
    return attach(df, shares, list(part), name)
