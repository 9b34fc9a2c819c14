"""Small tables stated in code. Their size is fixed, so broadcasting them is safe."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from landfall import schemas

# Modes of entry.
MODE_LABELS = [
    (1, "Air"),
    (2, "Sea"),
    (3, "Land"),
    (9, "Not Reported"),
]

# Visa categories.
VISA_LABELS = [
    (1, "Business"),
    (2, "Pleasure"),
    (3, "Student"),
]

# Postal abbreviations of US states, the district and territories.
STATE_NAMES = [
    ("AL", "Alabama"),
    ("AK", "Alaska"),
    ("AZ", "Arizona"),
    ("AR", "Arkansas"),
    ("CA", "California"),
    ("CO", "Colorado"),
    ("CT", "Connecticut"),
    ("DE", "Delaware"),
    ("DC", "District of Columbia"),
    ("FL", "Florida"),
    ("GA", "Georgia"),
    ("HI", "Hawaii"),
    ("ID", "Idaho"),
    ("IL", "Illinois"),
    ("IN", "Indiana"),
    ("IA", "Iowa"),
    ("KS", "Kansas"),
    ("KY", "Kentucky"),
    ("LA", "Louisiana"),
    ("ME", "Maine"),
    ("MD", "Maryland"),
    ("MA", "Massachusetts"),
    ("MI", "Michigan"),
    ("MN", "Minnesota"),
    ("MS", "Mississippi"),
    ("MO", "Missouri"),
    ("MT", "Montana"),
    ("NE", "Nebraska"),
    ("NV", "Nevada"),
    ("NH", "New Hampshire"),
    ("NJ", "New Jersey"),
    ("NM", "New Mexico"),
    ("NY", "New York"),
    ("NC", "North Carolina"),
    ("ND", "North Dakota"),
    ("OH", "Ohio"),
    ("OK", "Oklahoma"),
    ("OR", "Oregon"),
    ("PA", "Pennsylvania"),
    ("RI", "Rhode Island"),
    ("SC", "South Carolina"),
    ("SD", "South Dakota"),
    ("TN", "Tennessee"),
    ("TX", "Texas"),
    ("UT", "Utah"),
    ("VT", "Vermont"),
    ("VA", "Virginia"),
    ("WA", "Washington"),
    ("WV", "West Virginia"),
    ("WI", "Wisconsin"),
    ("WY", "Wyoming"),
    ("AS", "American Samoa"),
    ("GU", "Guam"),
    ("MP", "Northern Mariana Islands"),
    ("PR", "Puerto Rico"),
    ("VI", "Virgin Islands"),
]


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """A table of given rows. Arrow makes it a local relation, whose size Catalyst knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    records = [dict(zip(names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)


def modes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MODE_LABELS, schemas.MODES)


def visas(spark: SparkSession) -> DataFrame:
    return literal_table(spark, VISA_LABELS, schemas.VISAS)


def states(spark: SparkSession) -> DataFrame:
    return literal_table(spark, STATE_NAMES, schemas.STATES)
