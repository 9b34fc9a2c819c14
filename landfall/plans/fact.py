"""The fact table of arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.functions import label_of, mdy_to_iso, sas_day_to_iso
from landfall.operators import add_label, keep_valid_codes, project, require_not_null
from landfall.sources import MODE_LABELS, VISA_LABELS

# Column order of the fact table.
FACT_COLUMNS = [
    "cicid", "i94cit", "i94res", "iso_arrdate", "iso_depdate", "iso_duedate",
    "i94_visa", "i94_mode", "admnum", "insnum", "i94addr_US_state", "airline",
    "fltno", "visatype", "i94bir", "gender", "i94yr", "i94mon", "i94port",
]

CASTS = {
    "cicid": "bigint",
    "i94cit": "int",
    "i94res": "int",
    "admnum": "bigint",
    "i94bir": "int",
    "i94yr": "int",
    "i94mon": "int",
}


def build_fact(
    raw: DataFrame,
    addresses: DataFrame,
    valid_ports: DataFrame | None = None,
    as_recorded: bool = False,
) -> DataFrame:
    """Decode a raw extract: dates, mode, visa and address labels.

    Rows without a port are dropped first; with ``valid_ports`` so are rows
    with a port that is not listed. Unknown modes, visas and addresses keep
    their row with a NULL label. No step shuffles the extract.

    ``as_recorded`` treats day 0 as missing and reorders any due date, valid or
    not.
    """
    rows = require_not_null(raw, ["i94port"])
    if valid_ports is not None:
        rows = keep_valid_codes(rows, "i94port", valid_ports)
    rows = rows.withColumns(
        {
            "iso_arrdate": sas_day_to_iso("arrdate", zero_is_null=as_recorded),
            "iso_depdate": sas_day_to_iso("depdate", zero_is_null=as_recorded),
            "iso_duedate": mdy_to_iso("dtaddto", lenient=as_recorded),
            "i94_mode": label_of("i94mode", MODE_LABELS),
            "i94_visa": label_of("i94visa", VISA_LABELS),
        }
    )
    rows = add_label(rows, "i94addr", addresses, "i94addr", "i94addr_US_state")
    return project(rows, FACT_COLUMNS, CASTS)
