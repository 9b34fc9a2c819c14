"""Code dictionaries parsed from label lines (column ``value``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import title_case
from landfall.operators import (
    accepted,
    add_label,
    append_members,
    flag_withdrawn,
    follow_successors,
    place_parts,
    project,
    rejected,
    split_dictionary,
    successor,
    union_sources,
)

# Members for ports that are not reported or not identified.
UNKNOWN_PORTS = [
    ("XXX", "NOT REPORTED/UNKNOWN", "NOT REPORTED/UNKNOWN", "NOT REPORTED/UNKNOWN", "NOT REPORTED/UNKNOWN"),
    (
        "888",
        "UNIDENTIFED AIR / SEAPORT",
        "UNIDENTIFED AIR / SEAPORT",
        "UNIDENTIFED AIR / SEAPORT",
        "UNIDENTIFED AIR / SEAPORT",
    ),
    ("UNK", "UNKNOWN POE", "UNKNOWN POE", "UNKNOWN POE", "UNKNOWN POE"),
]

# The sections of the delivered label file that hold the dictionaries.
SECTIONS = {"ports": "i94prtl", "countries": "i94cntyl", "addresses": "i94addrl"}

# Remarks behind a state, in brackets or after a number sign.
REMARKS = r"\s*(?:\([^)]*\)|#\s*\w+)"

PORT_COLUMNS = ["code", "port", "locality", "province", "territory"]


def parse_us_ports(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``[facility, ]city, state abbreviation``, with a ``problem`` column."""
    entries = place_parts(split_dictionary(lines, ["code", "label"]), "label", ["locality", "province"], "port")
    named = add_label(entries, "province", states, "abbreviation", "state", name="_state")
    unknown = F.col("problem").isNull() & F.col("_state").isNull()
    return named.withColumns(
        {
            "problem": F.when(unknown, "unknown state").otherwise(F.col("problem")),
            "province": F.col("_state"),
            "locality": title_case("locality"),
            "territory": F.lit("United States"),
        }
    ).drop("_state")


def parse_abroad_ports(lines: DataFrame) -> DataFrame:
    """``[facility, ]city, province, country``, with a ``problem`` column."""
    entries = split_dictionary(lines, ["code", "label"])
    return place_parts(entries, "label", ["locality", "province", "territory"], "port")


def split_ports(lines: DataFrame, states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of one section with all ports, as lines for :func:`parse_us_ports` and :func:`parse_abroad_ports`.

    A label that ends in a state, abbreviated or in full, maybe with a remark, is a
    port in that state, and so is one that ends in any two letters, which will be
    reported as unknown. What is no entry, or withdrawn, goes with the former too. All
    others are abroad, with an empty province if they have but two parts.
    """
    entries = flag_withdrawn(split_dictionary(lines, ["code", "label"]), "label")
    parts = F.split("label", ",")
    last = F.upper(F.trim(F.regexp_replace(F.element_at(parts, -1), REMARKS, "")))
    names = states.select(F.upper("state").alias("name"), "abbreviation").union(states.select("abbreviation", "abbreviation"))
    entries = entries.withColumns({"_parts": F.size(parts), "_last": last})
    named = add_label(entries, "_last", names, "name", "abbreviation", name="_state", default=F.col("_last"))
    odd = F.col("problem").isNotNull() | (F.col("_parts") < 2)
    within = F.coalesce(F.col("_state").rlike("^[A-Z]{2}$"), F.lit(False))
    front = F.regexp_extract("label", r"^(.*),[^,]*$", 1)
    quoted = F.lit("'")
    us = named.filter(odd | within).select(
        F.when(odd, F.col("value"))
        .otherwise(F.concat(quoted, "code", F.lit("' = '"), front, F.lit(", "), "_state", quoted))
        .alias("value")
    )
    padded = F.when(F.col("_parts") == 2, F.concat(front, F.lit(", , "), F.element_at(parts, -1))).otherwise(F.col("label"))
    abroad = named.filter(~odd & ~within).select(
        F.concat(quoted, "code", F.lit("' = '"), padded, quoted).alias("value")
    )
    return us, abroad


def build_dictionaries(
    sections: DataFrame, states: DataFrame, continents: DataFrame, names: Mapping[str, str] = SECTIONS
) -> dict[str, DataFrame]:
    """``ports``, ``countries``, ``addresses`` and port ``problems`` from the sections of one label file.

    ``sections`` is what :func:`~landfall.sources.read_label_sections` gives, ``names``
    tells which section holds which dictionary.
    """
    lines = {name: sections.filter(F.col("section") == key).select("value") for name, key in names.items()}
    ports, problems = build_ports(*split_ports(lines["ports"], states), states)
    return {
        "ports": ports,
        "countries": build_countries(lines["countries"], continents),
        "addresses": build_addresses(lines["addresses"], states),
        "problems": problems,
    }


def build_ports(
    us_lines: DataFrame,
    abroad_lines: DataFrame,
    states: DataFrame,
    unknown: Sequence[tuple] = UNKNOWN_PORTS,
) -> tuple[DataFrame, DataFrame]:
    """The ports dimension, and the lines to look at with the reason.

    A code collapsed into another one, directly or over others, gets the place of
    the last. Codes withdrawn without a successor are left to look at, and so are
    those whose successor is unknown or leads back to itself.
    """
    us = parse_us_ports(us_lines, states)
    abroad = parse_abroad_ports(abroad_lines)
    ports = union_sources(*[project(accepted(part), PORT_COLUMNS) for part in (abroad, us)])
    problems = union_sources(*[rejected(part).select("value", "code", "label", "problem") for part in (abroad, us)])
    problems = problems.withColumn("_next", F.when(F.col("problem") == "withdrawn", successor("label")))
    moved = problems.filter("_next is not null")
    # The same pairs, from the lines alone: they are read for every step of a chain.
    pairs = [_collapsed(part) for part in (abroad_lines, us_lines)]
    last = follow_successors(union_sources(*pairs))
    place = ports.withColumnRenamed("code", "_target").dropDuplicates(["_target"])
    placed = last.join(place, last["target"] == place["_target"], "left")
    collapsed = placed.filter("_target is not null").select(*PORT_COLUMNS)
    lost = placed.filter("_target is null").select(F.col("code").alias("_lost"), "circular")
    reason = F.when(F.col("circular"), "successors in a circle").otherwise("unknown successor")
    unplaced = moved.join(lost, moved["code"] == lost["_lost"]).select("value", reason.alias("problem"))
    others = problems.filter("_next is null").select("value", "problem")
    return append_members(union_sources(ports, collapsed), unknown), union_sources(others, unplaced)


def _collapsed(lines: DataFrame) -> DataFrame:
    """Codes that are collapsed, each with the one named in its place."""
    entries = split_dictionary(lines, ["code", "label"]).filter("problem is null")
    pairs = entries.select("code", successor("label").alias("target"))
    return pairs.filter("target is not null")


def build_port_codes(ports: DataFrame) -> DataFrame:
    """The list of valid codes."""
    return ports.select("code")


def build_countries(lines: DataFrame, continents: DataFrame | None = None) -> DataFrame:
    """``code = 'NAME' = 'CONTINENT'`` lines; names in lower case.

    With a ``continents`` table (``cit_res_code``, ``continent``) the lines are
    ``code = 'NAME'``. Entries that say the code is withdrawn are left out.
    """
    fields = ["cit_res_code", "country"] + ([] if continents is not None else ["continent"])
    entries = accepted(flag_withdrawn(split_dictionary(lines, fields), "country"))
    named = project(
        entries.withColumns({"country": F.lower("country")}), fields, {"cit_res_code": "int"}
    )
    if continents is None:
        return named
    return add_label(named, "cit_res_code", continents, "cit_res_code", "continent")


def build_addresses(lines: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """``'code' = 'STATE'`` lines; names in title case.

    With a ``states`` table the names are spelled as there, and so equal the
    provinces of the ports dimension; codes it lacks keep their label.
    """
    entries = accepted(split_dictionary(lines, ["i94addr", "i94addr_US_state"]))
    titled = entries.withColumn("i94addr_US_state", title_case("i94addr_US_state"))
    if states is not None:
        titled = add_label(
            titled, "i94addr", states, "abbreviation", "state",
            name="i94addr_US_state", default=F.col("i94addr_US_state"),
        )
    return project(titled, ["i94addr", "i94addr_US_state"])
