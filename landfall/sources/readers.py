"""Batch readers. Paths are any URI or glob that Spark can open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landfall import schemas


def locate(base_path: str, name: str) -> str:
    """A source below a base path, which may be a local, HDFS or object-store URI."""
    return f"{base_path.rstrip('/')}/{name.lstrip('/')}"


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet", **options) -> DataFrame:
    """Scan files of any built-in format.

    A schema keeps text formats from sampling their input, and gives partition
    columns their stated types (an all-digit port code stays a string).
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema=None,
    sep: str = ",",
    encoding: str = "UTF-8",
    infer: bool = False,
    multi_line: bool = False,
    rejects: str | None = None,
    **options,
) -> DataFrame:
    """Scan delimited files with a header line; a quote within quotes is doubled.

    With a schema the header is checked against it. Without one all columns
    are strings, or of inferred type with ``infer``, at the price of an extra
    pass over the input.

    A line that does not fit the columns or their types is an error. With a
    schema and ``rejects``, such a line is kept instead: what can be read in its
    columns, and the whole line in a column of that name, which is NULL on good
    lines. ``multi_line`` reads text with line breaks, each file in one task.
    """
    settings = {"sep": sep, "header": True, "encoding": encoding, "escape": '"', "multiLine": multi_line}
    # An empty cell is given as this, which no text equals, so that quoted empty text stays text.
    settings |= {"mode": "FAILFAST", "maxCharsPerColumn": -1, "nullValue": "\0NULL"}
    if schema is not None:
        settings["enforceSchema"] = False
        if rejects is not None:
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
            schema = schema.add(rejects, T.StringType())
            settings |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rejects, "enforceSchema": True}
    elif infer:
        settings["inferSchema"] = True
    return read_table(spark, path, schema, "csv", **{**settings, **options})


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a code dictionary, one ``'code' = 'label'`` each, in column ``value``."""
    return spark.read.text(path)


def read_arrivals(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """One or more landed monthly extracts under the fixed 27-column contract."""
    if fmt == "csv":
        return read_csv(spark, path, schemas.RAW_ARRIVALS, **options)
    return read_table(spark, path, schemas.RAW_ARRIVALS, fmt, **options)


def land(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Convert a source to Parquet once and continue from the columnar copy."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
