"""Column expressions. All of them stay in the JVM."""

from landfall.functions.dates import mdy_to_date, mdy_to_iso, sas_day_to_date, sas_day_to_iso
from landfall.functions.labels import label_of
from landfall.functions.ratios import percent_of
from landfall.functions.text import (
    contains_token,
    expand_abbreviations,
    part_from_end,
    repair_latin1,
    split_compound,
    strip_blanks,
    title_case,
    to_ascii,
    unquote,
)

__all__ = [
    "contains_token",
    "expand_abbreviations",
    "label_of",
    "mdy_to_date",
    "mdy_to_iso",
    "part_from_end",
    "percent_of",
    "repair_latin1",
    "sas_day_to_date",
    "sas_day_to_iso",
    "split_compound",
    "strip_blanks",
    "title_case",
    "to_ascii",
    "unquote",
]
