"""The airport and city dimensions, keyed by port code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import percent_of, repair_latin1, to_ascii
from landfall.operators import add_label, conform, dense_rank_by, project

# Column order of the airport dimension.
AIRPORT_COLUMNS = [
    "ident", "type", "elevation_ft", "continent", "gps_code", "iata_code",
    "local_code", "coordinates", "iso_region", "nameL", "municipalityL", "code",
]

# Source and target names of the city dimension.
CITY_COLUMNS = {
    "Median Age": "Median_Age",
    "Male Population": "Male_Population",
    "Female Population": "Female_Population",
    "Total Population": "Total_Population",
    "Number of Veterans": "Number_of_Veterans",
    "Foreign-born": "Foreign-born",
    "Average Household Size": "Avg_Household_Size",
    "Race": "Race",
    "Count": "Count",
    "Race_percent_by_city": "Race_percent_by_city",
    "Race_rank_by_city": "Race_rank_by_city",
    "code": "code",
}


def clean_airports(
    raw: DataFrame,
    countries: DataFrame,
    subdivisions: DataFrame,
    as_recorded: bool = False,
) -> DataFrame:
    """Repair names, spell them in ASCII and decode country and region codes.

    An unknown country keeps its code, an unknown region becomes empty text.
    ``as_recorded`` decodes every name, even one that was right, and turns
    missing names into empty text.
    """
    repaired = raw.withColumns(
        {
            "nameL": repair_latin1("name", lossy=as_recorded, null_as_empty=as_recorded),
            "municipalityL": repair_latin1("municipality", lossy=as_recorded, null_as_empty=as_recorded),
        }
    )
    spelled = repaired.withColumns({"nameE": to_ascii("nameL"), "municipalityE": to_ascii("municipalityL")})
    named = add_label(
        spelled, "iso_country", countries, "alpha_2", "name", name="country", default=F.col("iso_country")
    )
    placed = add_label(named, "iso_region", subdivisions, "code", "name", name="state", default="")
    return placed.drop("name", "municipality")


def build_airports(airports: DataFrame, ports: DataFrame, null_safe: bool = False) -> DataFrame:
    """Airports in the city, province and country of a port, with the port's code.

    ``null_safe`` lets a port without a province meet an airport whose region
    is unknown.
    """
    if null_safe:
        airports = airports.withColumn("state", F.nullif("state", F.lit("")))
    place = {"municipalityE": "locality", "state": "province", "country": "territory"}
    return project(conform(airports, ports, place, null_safe), AIRPORT_COLUMNS)


def city_shares(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Cities with a port, with the share of each group but without ranks."""
    shares = cities.withColumn("Race_percent_by_city", percent_of("Count", "Total Population"))
    columns = {old: new for old, new in CITY_COLUMNS.items() if new != "Race_rank_by_city"}
    return project(conform(shares, ports, {"City": "locality", "State": "province"}), columns)


def build_city_demo(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Cities with a port: demographics, share of each group and its rank over all cities.

    The rank counts cities without a port too. A city with several ports
    appears once per port and group, hence the key is (``code``, ``Race``).
    """
    shares = cities.withColumn("Race_percent_by_city", percent_of("Count", "Total Population"))
    ranked = dense_rank_by(shares, ["Race"], "Race_percent_by_city", "Race_rank_by_city")
    return project(conform(ranked, ports, {"City": "locality", "State": "province"}), CITY_COLUMNS)
