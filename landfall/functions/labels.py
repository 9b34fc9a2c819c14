"""Labels of fixed codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.columns import as_column


def label_of(code, entries: Sequence[tuple]) -> Column:
    """The label of a code in a short fixed list; NULL for other codes.

    It equals a left join to that list. Being an expression it is dropped where
    the label is not used, and a filter on it moves down to the scan.
    """
    (first, text), *others = entries
    label = F.when(as_column(code) == first, text)
    for value, text in others:
        label = label.when(as_column(code) == value, text)
    return label
