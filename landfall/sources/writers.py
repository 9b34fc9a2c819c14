"""Batch writers.

Partitioned writes ask for a rebalance on the partition keys: rows of one key
meet in few files, while a key that holds a large share of the rows is split
over several tasks and small keys share one. Where the rows already arrive
clustered by key, ``clustered=True`` saves that shuffle. The writer option
``maxRecordsPerFile`` bounds the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MONTH_KEYS = ("i94yr", "i94mon", "i94port")


class Written:
    """Counts that the writing tasks take of what they write, so that nothing is read again for them.

    ``rows`` is always counted; further conditions by name. Each task that writes
    counts once, even if it had to be repeated elsewhere, since counts are taken
    after the last shuffle.
    """

    def __init__(self, **conditions: Column):
        self._observation = Observation()
        self._counts = [F.count_if(condition).alias(name) for name, condition in conditions.items()]

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *self._counts)

    def __getitem__(self, name: str) -> int:
        """A count, once the rows have been written."""
        return self._observation.get[name]


def _partitioned(df: DataFrame, keys: Sequence[str], clustered: bool, counts: Written | None = None):
    rows = df if clustered or not keys else df.hint("rebalance", *keys)
    if counts is not None:
        rows = counts.watch(rows)
    return rows.write.partitionBy(*keys) if keys else rows.write


def write_table(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = (),
    mode: str = "errorifexists",
    fmt: str = "parquet",
    clustered: bool = False,
    counts: Written | None = None,
    **options,
) -> None:
    """Write a table, by default failing if it exists. ``counts`` are taken on the way."""
    _partitioned(df, keys, clustered, counts).mode(mode).format(fmt).options(**options).save(path)


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    mode: str = "errorifexists",
    multi_line: bool = False,
    empty_as_null: bool = False,
    lossy: bool = False,
    **options,
) -> None:
    """Write delimited files with a header, from which :func:`read_csv` gets equal rows.

    NULL is an empty cell and empty text a quoted one; ``empty_as_null`` makes
    both an empty cell. Text with line breaks needs ``multi_line``, here and when
    it is read, since such files cannot be split. Text with a line break
    otherwise, or with a character that ``encoding`` lacks, is an error;
    ``lossy`` writes blanks and ``?`` instead.
    """
    settings = {
        "sep": sep,
        "header": True,
        "encoding": encoding,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    if empty_as_null:
        settings["emptyValue"] = ""
    texts = {
        name: _writable(F.col(f"`{name}`"), name, encoding, multi_line, lossy)
        for name, dtype in df.dtypes
        if dtype == "string"
    }
    write_table(df.withColumns(texts), path, mode=mode, fmt="csv", **{**settings, **options})


def _writable(text, name: str, encoding: str, multi_line: bool, lossy: bool):
    """The text, or an error if a delimited file cannot hold it."""
    if not multi_line and lossy:
        text = F.regexp_replace(text, r"[\r\n]", " ")
    elif not multi_line:
        broken = F.raise_error(F.lit(f"column {name} holds a line break; write and read it with multi_line"))
        text = F.when(text.rlike(r"[\r\n]"), broken.cast("string")).otherwise(text)
    if lossy or encoding.upper().startswith("UTF"):
        return text
    # Encoding fails on a character the encoding lacks.
    return F.decode(F.encode(text, encoding), encoding)


def write_months(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = MONTH_KEYS,
    clustered: bool = False,
    **options,
) -> None:
    """Write a partitioned fact table, replacing only the partitions in ``df``.

    Other months stay. A partition the new rows no longer touch stays too, so
    use :func:`replace_month` to reload a month as a whole.
    """
    (
        _partitioned(df, keys, clustered)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .parquet(path)
    )


def replace_month(
    df: DataFrame,
    path: str,
    year: int,
    month: int,
    keys: Sequence[str] = MONTH_KEYS,
    clustered: bool = False,
    **options,
) -> None:
    """Make one month of the table equal to that month's rows in ``df``.

    Only this month's directory is overwritten, hence running it again changes
    nothing, and ports that have disappeared from the month are removed.
    """
    year_key, month_key, *rest = keys
    rows = df.filter((F.col(year_key) == year) & (F.col(month_key) == month)).drop(year_key, month_key)
    (
        _partitioned(rows, rest, clustered)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**options)
        .parquet(f"{path.rstrip('/')}/{year_key}={year}/{month_key}={month}")
    )


def write_sorted(
    df: DataFrame,
    path: str,
    key: str,
    keys: Sequence[str] = (),
    mode: str = "errorifexists",
    different: int = 1 << 20,
    row_group_bytes: int = 16 << 20,
    **options,
) -> None:
    """Write Parquet in which rows of one ``key`` are found by reading few row groups.

    Files are sorted by ``key``, within the partitions of ``keys`` if given, else
    across all files. So most row groups are ruled out by their least and greatest
    key, and others by a Bloom filter, made for ``different`` keys a row group.
    """
    rows = df.hint("rebalance", *keys) if keys else df.repartitionByRange(key)
    settings = {
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.expected.ndv#{key}": str(different),
        "parquet.block.size": str(row_group_bytes),
    }
    rows.sortWithinPartitions(*keys, key).write.partitionBy(*keys).mode(mode).options(**{**settings, **options}).parquet(path)
