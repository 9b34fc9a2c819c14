"""Questions asked of the star schema.

Each narrows and counts the fact before it meets a dimension: the fact side of
every later join then holds one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators import (
    attach,
    conform,
    count_by,
    dense_ranks,
    first_per_key,
    require_not_null,
    top_k,
    union_sources,
)
from landfall.session import materialize


def _in_part(fact: DataFrame, year: int | None, month: int | None, port: str | None) -> DataFrame:
    """Restrict to a year, month or port of entry, which prunes the fact's partitions."""
    for name, value in (("i94yr", year), ("i94mon", month), ("i94port", port)):
        if value is not None:
            fact = fact.filter(F.col(name) == value)
    return fact


def arrivals_with_country(fact: DataFrame, countries: DataFrame, continent: str | None = None) -> DataFrame:
    """Arrivals with the country and continent of citizenship; unknown codes drop out."""
    if continent is not None:
        countries = countries.filter(F.col("continent") == continent)
    return conform(fact, countries, {"i94cit": "cit_res_code"})


def visitor_ports(
    fact: DataFrame,
    countries: DataFrame,
    continent: str = "Asia",
    visa: str = "Student",
    year: int | None = None,
    month: int | None = None,
    port: str | None = None,
    name: str = "students_count",
) -> DataFrame:
    """Different visitors of one visa category and continent, per port of entry.

    A visitor with several records counts once, at the port of the first
    record (by record number, then port).
    """
    rows = _in_part(fact, year, month, port).filter(F.col("i94_visa") == visa)
    rows = rows.select("cicid", "admnum", "i94port", "i94cit")
    rows = arrivals_with_country(rows, countries, continent)
    visitors = first_per_key(rows, ["admnum"], ["cicid", "i94port"])
    return count_by(visitors, ["i94port"], name)


def top_ports(counts: DataFrame, ports: DataFrame | None = None, k: int = 5, name: str = "students_count") -> DataFrame:
    """The k busiest ports of a count per port, with their place if ``ports`` is given."""
    placed = counts if ports is None else conform(counts, ports, {"i94port": "code"})
    return top_k(placed, k, name, ["i94port"])


def port_preference(
    fact: DataFrame,
    countries: DataFrame,
    ports: DataFrame,
    city_demo: DataFrame,
    continent: str = "Asia",
    visa: str = "Student",
    race: str = "Asian",
    k: int = 10,
    year: int | None = None,
    month: int | None = None,
    port: str | None = None,
) -> DataFrame:
    """Where visitors of a continent enter, next to that city's population of a group.

    The rank is over the ports in ``city_demo``, by number of people. Ranks are
    within a group, so only the group asked for is ranked.
    """
    counts = visitor_ports(fact, countries, continent, visa, year, month, port)
    people = city_demo.filter(F.col("Race") == race).select("code", "Race", "Count", "Race_percent_by_city")
    ranks = dense_ranks(people, ["Race"], "Count", "Race_rank_by_city")
    people = people.withColumnRenamed("code", "demo_code")
    placed = conform(counts, ports, {"i94port": "code"})
    described = conform(placed, people, {"i94port": "demo_code"})
    # The result's columns.
    chosen = described.select(
        "i94port",
        "students_count",
        "locality",
        "province",
        "territory",
        "Race",
        "Count",
        "Race_percent_by_city",
    )
    tiebreak = ["i94port", "locality", "province"]
    # Only the k rows need their rank.
    top = attach(top_k(chosen, k, "students_count", tiebreak), ranks, ["Race", "Count"], "Race_rank_by_city")
    return top_k(top, k, "students_count", tiebreak)


def traffic(
    fact: DataFrame,
    ports: DataFrame,
    level: Sequence[str] = ("code", "port"),
    k: int | None = None,
    year: int | None = None,
    month: int | None = None,
    port: str | None = None,
) -> DataFrame:
    """Arrivals per airport, city (``locality``) or state (``province``) of the ports table."""
    per_port = count_by(_in_part(fact, year, month, port), ["i94port"], "_arrivals")
    placed = conform(per_port, ports, {"i94port": "code"})
    totals = placed.groupBy(*level).agg(F.sum("_arrivals").alias("arrivals"))
    return totals if k is None else top_k(totals, k, "arrivals", level)


def traffic_levels(
    fact: DataFrame, ports: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Arrivals per port, city, state and in total, in one table: ``level`` tells which.

    The fact is read once and counted per port; all levels are summed from those
    counts. Columns that a level does not have are NULL.
    """
    per_port = count_by(_in_part(fact, year, month, None), ["i94port"], "_arrivals")
    placed = conform(per_port, ports, {"i94port": "code"})
    sums = placed.rollup("province", "locality", "code").agg(
        F.sum("_arrivals").alias("arrivals"), F.grouping_id().alias("_id")
    )
    # One bit for each column that is summed over, the last column's first.
    level = F.when(F.col("_id") == 0, "port").when(F.col("_id") == 1, "city").when(F.col("_id") == 3, "state")
    return sums.select(level.otherwise("total").alias("level"), "province", "locality", "code", "arrivals")


def first_records(fact: DataFrame, months: Sequence[str] = ("i94yr", "i94mon")) -> DataFrame:
    """Each visitor's first record of a month, per visa category and citizenship: a table to be stored.

    It merges over any months: :func:`visitor_ports_from` gives from it what
    :func:`visitor_ports` gives from the fact, without reading records again.
    """
    return fact.groupBy(*months, "i94_visa", "i94cit", "admnum").agg(
        F.min(F.struct("cicid", "i94port")).alias("first")
    )


def visitor_ports_from(
    firsts: DataFrame,
    countries: DataFrame,
    continent: str = "Asia",
    visa: str = "Student",
    year: int | None = None,
    month: int | None = None,
    name: str = "students_count",
) -> DataFrame:
    """Like :func:`visitor_ports`, from the stored first records of months."""
    rows = _in_part(firsts, year, month, None).filter(F.col("i94_visa") == visa).select("admnum", "i94cit", "first")
    rows = arrivals_with_country(rows, countries, continent)
    visitors = rows.groupBy("admnum").agg(F.min("first").alias("first"))
    return count_by(visitors.select("first.i94port"), ["i94port"], name)


def carrier_preference(
    fact: DataFrame,
    by: Sequence[str] = ("airline",),
    k: int | None = None,
    year: int | None = None,
    month: int | None = None,
    port: str | None = None,
) -> DataFrame:
    """Arrivals per airline, or per airline within other columns."""
    counts = count_by(require_not_null(_in_part(fact, year, month, port), ["airline"]), by, "arrivals")
    return counts if k is None else top_k(counts, k, "arrivals", by)


def month_keys(months: Mapping[str, DataFrame], keys: Sequence[str] = ("cicid", "admnum")) -> DataFrame:
    """Rows and different keys per month and over all months together.

    One row per month and key, and one per key for ``all``; NULL is a key too.
    Each month is read once, whatever the number of keys; the counts per value,
    which both reports need, are written to the shared folder.
    """
    named = F.array(*[F.struct(F.lit(key).alias("key"), F.col(key).cast("string").alias("value")) for key in keys])
    tagged = union_sources(*[df.select(F.lit(name).alias("month"), F.inline(named)) for name, df in months.items()])
    counts = materialize(count_by(tagged, ["key", "value", "month"], "_rows"))
    anywhere = counts.groupBy("key", "value").agg(F.sum("_rows").alias("_rows")).withColumn("month", F.lit("all"))
    reports = [
        part.groupBy("month", "key").agg(
            F.sum("_rows").alias("rows"),
            F.count(F.lit(1)).alias("different"),
            F.count_if(F.col("_rows") > 1).alias("repeated"),
        )
        for part in (counts, anywhere)
    ]
    return union_sources(*reports)


def city_list(cities: DataFrame) -> DataFrame:
    """The different cities with their state."""
    return cities.select("City", "State").distinct()

