"""Composite jobs: the star schema and the questions asked of it."""

from landfall.plans.analytics import (
    arrivals_with_country,
    carrier_preference,
    city_list,
    first_records,
    month_keys,
    port_preference,
    top_ports,
    traffic,
    traffic_levels,
    visitor_ports,
    visitor_ports_from,
)
from landfall.plans.dictionaries import (
    SECTIONS,
    UNKNOWN_PORTS,
    build_addresses,
    build_countries,
    build_dictionaries,
    build_port_codes,
    build_ports,
    parse_abroad_ports,
    parse_us_ports,
    split_ports,
)
from landfall.plans.dimensions import build_airports, build_city_demo, city_shares, clean_airports
from landfall.plans.fact import build_fact
from landfall.plans.jobs import (
    fact_checks,
    run_addresses,
    run_airport_source,
    run_city_list,
    run_countries,
    run_dictionaries,
    run_dimensions,
    run_fact,
    run_ports,
)
from landfall.plans.loads import finish_loads, last_steps, load_history, load_months

__all__ = [
    "SECTIONS",
    "UNKNOWN_PORTS",
    "arrivals_with_country",
    "build_addresses",
    "build_airports",
    "build_city_demo",
    "build_countries",
    "build_dictionaries",
    "build_fact",
    "build_port_codes",
    "build_ports",
    "carrier_preference",
    "city_list",
    "city_shares",
    "clean_airports",
    "fact_checks",
    "finish_loads",
    "first_records",
    "last_steps",
    "load_history",
    "load_months",
    "month_keys",
    "parse_abroad_ports",
    "parse_us_ports",
    "port_preference",
    "run_addresses",
    "run_airport_source",
    "run_city_list",
    "run_countries",
    "run_dictionaries",
    "run_dimensions",
    "run_fact",
    "run_ports",
    "split_ports",
    "top_ports",
    "traffic",
    "traffic_levels",
    "visitor_ports",
    "visitor_ports_from",
]
