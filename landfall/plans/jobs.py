"""The batch jobs: read, build, write, check."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators import check_counts, check_non_empty, check_unique, enforce, union_sources
from landfall.plans.analytics import city_list
from landfall.plans.dictionaries import (
    build_addresses,
    build_countries,
    build_dictionaries,
    build_port_codes,
    build_ports,
)
from landfall.plans.dimensions import build_airports, build_city_demo, clean_airports
from landfall.plans.fact import build_fact
from landfall.plans.loads import load_months
from landfall.session import materialize
from landfall.sources import (
    Written,
    locate,
    read_arrivals,
    read_csv,
    read_label_sections,
    read_labels,
    read_table,
    states,
    write_csv,
    write_table,
)


def run_fact(
    spark: SparkSession,
    extract_path: str,
    addresses_path: str,
    lake_path: str,
    fmt: str = "parquet",
    load: str | None = None,
) -> None:
    """Build the months of an extract, check them, and store them if they pass.

    The months are those of the extract, so an extract without rows fails even
    if earlier months are stored. Record numbers must differ within a month. A
    load that fails leaves the stored months as they were; see
    :mod:`landfall.plans.loads`. With a name, ``load``, it is stored once only.
    """
    raw = read_arrivals(spark, extract_path, fmt)
    addresses = read_csv(spark, addresses_path, schemas.ADDRESSES)
    load_months(build_fact(raw, addresses), locate(lake_path, "I94_data"), load or uuid.uuid4().hex)


def fact_checks(fact: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows and different record numbers of each month of a load; a load without months fails."""
    if not months:
        return check_non_empty({"I94_data": fact.limit(0)})
    checks = []
    for year, month in sorted(months):
        rows = fact.filter((F.col("i94yr") == year) & (F.col("i94mon") == month))
        name = f"I94_data {year}-{month:02d}"
        checks += [check_non_empty({name: rows}), check_unique(rows, ["cicid"], name)]
    return union_sources(*checks)


def run_dimensions(
    spark: SparkSession,
    ports_path: str,
    airports_path: str,
    cities_path: str,
    lake_path: str,
) -> None:
    """Build and store the airport and city dimensions, then check them."""
    ports = read_csv(spark, ports_path, schemas.PORTS)
    airports = read_table(spark, airports_path, schemas.CLEAN_AIRPORTS)
    cities = read_csv(spark, cities_path, schemas.RAW_CITIES, sep=";")
    targets = {name: locate(lake_path, name) for name in ("airports", "cities_demo")}
    counts = {name: Written() for name in targets}
    write_table(build_airports(airports, ports), targets["airports"], counts=counts["airports"])
    write_table(build_city_demo(cities, ports), targets["cities_demo"], counts=counts["cities_demo"])
    stored = {name: read_table(spark, path) for name, path in targets.items()}
    enforce(
        union_sources(
            check_counts(spark, [("non_empty", n, c["rows"], 1, c["rows"] > 0) for n, c in counts.items()]),
            check_unique(stored["airports"], ["ident", "code"], "airports"),
            check_unique(stored["cities_demo"], ["code", "Race"], "cities_demo"),
        )
    )


def run_ports(spark: SparkSession, us_path: str, abroad_path: str, clean_path: str) -> DataFrame:
    """Ports and their codes from label files, as CSV; returns the lines to look at."""
    ports, problems = build_ports(read_labels(spark, us_path), read_labels(spark, abroad_path), states(spark))
    ports = materialize(ports)  # written twice
    _store(spark, ports, clean_path, "ports", schemas.PORTS, "code")
    _store(spark, build_port_codes(ports), clean_path, "port_codes", schemas.PORT_CODES, "code")
    return problems


def run_dictionaries(
    spark: SparkSession, label_path: str, continents: DataFrame, clean_path: str, across_files: bool = False
) -> DataFrame:
    """All dictionaries from the one delivered label file, as CSV; returns the port lines to look at."""
    # The file is scanned once; each dictionary reads its section.
    sections = materialize(read_label_sections(spark, label_path, across_files))
    built = build_dictionaries(sections, states(spark), continents)
    ports = materialize(built["ports"])  # written twice
    _store(spark, ports, clean_path, "ports", schemas.PORTS, "code")
    _store(spark, build_port_codes(ports), clean_path, "port_codes", schemas.PORT_CODES, "code")
    _store(spark, built["countries"], clean_path, "countries", schemas.COUNTRIES, "cit_res_code")
    _store(spark, built["addresses"], clean_path, "addresses", schemas.ADDRESSES, "i94addr")
    return built["problems"]


def run_countries(spark: SparkSession, lines_path: str, clean_path: str) -> None:
    """The countries dictionary from a label file, as CSV."""
    _store(spark, build_countries(read_labels(spark, lines_path)), clean_path, "countries", schemas.COUNTRIES, "cit_res_code")


def run_addresses(spark: SparkSession, lines_path: str, clean_path: str) -> None:
    """The addresses dictionary from a label file, as CSV."""
    _store(spark, build_addresses(read_labels(spark, lines_path)), clean_path, "addresses", schemas.ADDRESSES, "i94addr")


def _store(spark: SparkSession, df: DataFrame, clean_path: str, name: str, schema: str, key: str) -> None:
    path = locate(clean_path, name)
    counts = Written()
    write_csv(df, path, counts=counts)
    non_empty = check_counts(spark, [("non_empty", name, counts["rows"], 1, counts["rows"] > 0)])
    enforce(union_sources(non_empty, check_unique(read_csv(spark, path, schema), [key], name)))


def run_airport_source(
    spark: SparkSession, raw_path: str, countries: DataFrame, subdivisions: DataFrame, clean_path: str
) -> None:
    """The cleaned airports from the raw CSV, as Parquet and as CSV separated by bars."""
    cleaned = clean_airports(read_csv(spark, raw_path, schemas.RAW_AIRPORTS), countries, subdivisions)
    target = locate(clean_path, "airports")
    write_table(cleaned, target)
    stored = read_table(spark, target, schemas.CLEAN_AIRPORTS)
    write_csv(stored, locate(clean_path, "airports_csv"), sep="|")
    enforce(check_non_empty({"airports": stored}))


def run_city_list(spark: SparkSession, cities_path: str, clean_path: str) -> None:
    """The different cities of the demographics file, as CSV."""
    cities = city_list(read_csv(spark, cities_path, schemas.RAW_CITIES, sep=";"))
    path = locate(clean_path, "cities")
    write_csv(cities, path)
    enforce(check_non_empty({"cities": read_csv(spark, path, "City string, State string")}))
