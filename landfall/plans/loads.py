"""Monthly loads that are checked before they are published.

A load is written to a staging folder next to the table, checked there, and only
then takes the place of its months, each by one overwrite of that month's folder.
A load that fails a check leaves the table as it was. Every step is an entry in a
ledger, a Parquet table that only grows:

``rejected``   a check has failed; ``reason`` tells which
``checked``    all checks have passed, the months are about to be replaced
``published``  all months have been replaced

A load that is ``published`` is not loaded again. One that stopped while it was
``checked`` still has its staged rows: :func:`finish_loads`, or loading it again,
replaces its months from them, any number of times with the same result. One load
of a table runs at a time.

Rows are counted by the tasks that stage them. The only thing read again are the
columns of the key, for the months' different keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.operators import check_counts, enforce
from landfall.operators.quality import QualityError
from landfall.session import delete_path, path_exists
from landfall.sources import MONTH_KEYS, Written, read_table, replace_month, write_table

# Jobs that replace months at the same time.
MONTHS_AT_ONCE = 8

LEDGER = """
    load string, step int, year int, month int, rows bigint, different bigint, status string, reason string
"""


def _folder(path: str) -> str:
    """Where the loads of a table are kept: next to it, so that reading the table never meets them."""
    return f"{path.rstrip('/')}.loads"


def _staging(path: str, load: str) -> str:
    return f"{_folder(path)}/staging/{hashlib.sha256(load.encode()).hexdigest()[:32]}"


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of a table: one row per load, step and month (none if a load had no rows)."""
    ledger = f"{_folder(path)}/ledger"
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def last_steps(history: DataFrame) -> DataFrame:
    """The last entry of every load and month."""
    newest = Window.partitionBy("load").orderBy(F.desc("step"))
    return history.withColumn("_nth", F.rank().over(newest)).filter(F.col("_nth") == 1).drop("_nth")


def _enter(spark: SparkSession, path: str, load: str, entries: Sequence[tuple], status: str, reason: str | None) -> None:
    step = load_history(spark, path).filter(F.col("load") == load).agg(F.max("step")).first()[0] or 0
    rows = [(load, step + 1, *entry, status, reason) for entry in entries]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(f"{_folder(path)}/ledger")


def _months(staged: DataFrame, unique: Sequence[str], keys: Sequence[str]) -> list[tuple]:
    """Year, month, rows and different keys of each staged month: a few rows, from the key columns alone."""
    year, month = keys[:2]
    per_key = staged.groupBy(year, month, *unique).agg(F.count(F.lit(1)).alias("_rows"))
    totals = per_key.groupBy(year, month).agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("different"))
    return sorted(tuple(r) for r in totals.select(year, month, "rows", "different").collect())


def _publish(spark: SparkSession, path: str, load: str, entries: Sequence[tuple], schema, keys: Sequence[str]) -> None:
    staged = read_table(spark, _staging(path, load), schema)
    # Staged files hold few partitions each, so they are written on as they come. Months
    # are folders of their own, so some are replaced at the same time.
    with ThreadPoolExecutor(MONTHS_AT_ONCE) as pool:
        list(pool.map(lambda entry: replace_month(staged, path, *entry[:2], keys, clustered=True), entries))
    _enter(spark, path, load, entries, "published", None)
    delete_path(spark, _staging(path, load))


def _open_entries(spark: SparkSession, path: str, load: str | None = None) -> dict[str, list[tuple]]:
    """Loads that are checked but not published, with their months."""
    history = load_history(spark, path)
    if load is not None:
        history = history.filter(F.col("load") == load)
    found: dict[str, list[tuple]] = {}
    for r in last_steps(history).filter("status = 'checked'").collect():  # months of unfinished loads
        found.setdefault(r.load, []).append((r.year, r.month, r.rows, r.different))
    return {name: sorted(entries) for name, entries in found.items()}


def load_months(
    rows: DataFrame,
    path: str,
    load: str,
    unique: Sequence[str] = ("cicid",),
    keys: Sequence[str] = MONTH_KEYS,
    clustered: bool = False,
) -> DataFrame:
    """Replace the months that occur in ``rows``, if they pass their checks; returns the load's last ledger entries.

    A load must have rows, all of them staged, and ``unique`` must differ within each
    month (NULL being a value too). Otherwise the load is entered as rejected and
    :class:`QualityError` is raised: all months of a load are published, or none.
    ``load`` names the load; one that is published already changes nothing.
    """
    spark = rows.sparkSession
    mine = load_history(spark, path).filter(F.col("load") == load)
    if not last_steps(mine).filter("status = 'published'").isEmpty():
        return last_steps(mine)
    entries = _open_entries(spark, path, load).get(load)
    schema = rows.select(*[c for c in rows.columns if c not in keys], *keys).schema
    if entries is None:
        counts = Written()
        write_table(rows, _staging(path, load), keys, mode="overwrite", clustered=clustered, counts=counts)
        staged = read_table(spark, _staging(path, load), schema) if counts["rows"] else rows.limit(0)
        entries = _months(staged, unique, keys)
        name = path.rstrip("/").rsplit("/", 1)[-1]
        found = sum(entry[2] for entry in entries)
        checks = [
            ("non_empty", name, counts["rows"], 1, counts["rows"] > 0),
            ("reconcile", name, found, counts["rows"], found == counts["rows"]),
        ]
        checks += [("unique", f"{name} {y}-{m:02d}", different, n, different == n) for y, m, n, different in entries]
        try:
            enforce(check_counts(spark, checks))
        except QualityError as error:
            _enter(spark, path, load, entries or [(None, None, 0, 0)], "rejected", str(error))
            delete_path(spark, _staging(path, load))
            raise
        _enter(spark, path, load, entries, "checked", None)
    _publish(spark, path, load, entries, schema, keys)
    return last_steps(load_history(spark, path).filter(F.col("load") == load))


def finish_loads(spark: SparkSession, path: str, schema, keys: Sequence[str] = MONTH_KEYS) -> list[str]:
    """Publish loads that stopped after their checks; returns their names."""
    unfinished = _open_entries(spark, path)
    for load, entries in sorted(unfinished.items()):
        _publish(spark, path, load, entries, schema, keys)
    return sorted(unfinished)
