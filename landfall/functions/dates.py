"""Decoding of the two date encodings in arrival records."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.columns import as_column

# The day count starts here, and dates run from year 1 to 9999.
DAY_ZERO = datetime.date(1960, 1, 1)
FIRST_DAY = (datetime.date.min - DAY_ZERO).days
LAST_DAY = (datetime.date.max - DAY_ZERO).days

EIGHT_DIGITS = r"\A[0-9]{8}\z"


def sas_day_to_date(col, zero_is_null: bool = False) -> Column:
    """Days since 1960-01-01, possibly fractional, as a date.

    Fractions floor. NULL, NaN and days outside the years 1 to 9999 give NULL;
    with ``zero_is_null`` so does day 0.
    """
    day = F.floor(as_column(col))
    valid = as_column(col).between(FIRST_DAY, LAST_DAY + 1) & (day <= LAST_DAY)
    if zero_is_null:
        valid = valid & (as_column(col) != 0)
    return F.when(valid, F.date_add(F.lit(DAY_ZERO), day.cast("int")))


def sas_day_to_iso(col, zero_is_null: bool = False) -> Column:
    """Days since 1960-01-01 as ``YYYY-MM-DD`` text."""
    return sas_day_to_date(col, zero_is_null).cast("string")


def _reordered(text: Column) -> Column:
    return F.concat(F.substr(text, F.lit(5)), F.lit("-"), text.substr(1, 2), F.lit("-"), text.substr(3, 2))


def mdy_to_date(col) -> Column:
    """``MMDDYYYY`` text as a date; NULL for other text such as ``D/S``."""
    text = as_column(col)
    return F.when(text.rlike(EIGHT_DIGITS), _reordered(text).try_cast("date"))


def mdy_to_iso(col, lenient: bool = False) -> Column:
    """``MMDDYYYY`` text as ``YYYY-MM-DD`` text.

    By default anything that is no calendar date gives NULL. ``lenient``
    reorders the characters of any text and keeps empty text.
    """
    text = as_column(col)
    if lenient:
        return F.when(text == "", text).otherwise(_reordered(text))
    # Reordered digits are the text of the date, if they are one.
    return F.when(mdy_to_date(text).isNotNull(), _reordered(text))
