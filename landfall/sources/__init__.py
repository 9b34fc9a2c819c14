"""Readers, writers and literal tables."""

from landfall.sources.compaction import compact, file_sizes, small_partitions
from landfall.sources.literals import MODE_LABELS, VISA_LABELS, literal_table, modes, states, visas
from landfall.sources.readers import (
    land,
    locate,
    read_arrivals,
    read_csv,
    read_labels,
    read_table,
)
from landfall.sources.sections import read_label_sections
from landfall.sources.writers import MONTH_KEYS, Written, replace_month, write_csv, write_months, write_sorted, write_table

__all__ = [
    "MODE_LABELS",
    "MONTH_KEYS",
    "VISA_LABELS",
    "Written",
    "compact",
    "file_sizes",
    "land",
    "literal_table",
    "locate",
    "modes",
    "read_arrivals",
    "read_csv",
    "read_label_sections",
    "read_labels",
    "read_table",
    "replace_month",
    "small_partitions",
    "states",
    "visas",
    "write_csv",
    "write_months",
    "write_sorted",
    "write_table",
]
