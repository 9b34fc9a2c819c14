"""Ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.columns import as_column


def percent_of(col, total) -> Column:
    """``col`` as a percentage of ``total``; NULL where the total is zero or unknown."""
    return F.try_divide(as_column(col) * F.lit(100).cast("bigint"), as_column(total))
