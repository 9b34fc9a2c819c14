"""Explicit DDL schemas of every table, so that no read has to sample its input."""

# Monthly arrivals extract. Numerics land as double, the way they are exported.
RAW_ARRIVALS = """
    cicid double, i94yr double, i94mon double, i94cit double, i94res double,
    i94port string, arrdate double, i94mode double, i94addr string,
    depdate double, i94bir double, i94visa double, dtadfile string,
    visapost string, occup string, entdepa string, entdepd string,
    entdepu string, matflag string, biryear double, dtaddto string,
    gender string, insnum string, airline string, admnum double,
    fltno string, visatype string
"""

# The fact table as stored; the last three columns are its partition keys.
FACT = """
    cicid bigint, i94cit int, i94res int, iso_arrdate string,
    iso_depdate string, iso_duedate string, i94_visa string, i94_mode string,
    admnum bigint, insnum string, i94addr_US_state string, airline string,
    fltno string, visatype string, i94bir int, gender string,
    i94yr int, i94mon int, i94port string
"""

PORTS = "code string, port string, locality string, province string, territory string"
PORT_CODES = "code string"
COUNTRIES = "cit_res_code int, country string, continent string"
ADDRESSES = "i94addr string, i94addr_US_state string"
STATES = "abbreviation string, state string"
MODES = "i94mode int, i94_mode string"
VISAS = "i94visa int, i94_visa string"

# Caller-supplied code tables for countries and their subdivisions.
COUNTRY_CODES = "alpha_2 string, name string"
SUBDIVISION_CODES = "code string, name string"

RAW_AIRPORTS = """
    ident string, type string, name string, elevation_ft int,
    continent string, iso_country string, iso_region string,
    municipality string, gps_code string, iata_code string,
    local_code string, coordinates string
"""

CLEAN_AIRPORTS = """
    ident string, type string, elevation_ft int, continent string,
    iso_country string, iso_region string, gps_code string, iata_code string,
    local_code string, coordinates string, nameL string,
    municipalityL string, nameE string, municipalityE string,
    country string, state string
"""

RAW_CITIES = """
    City string, State string, `Median Age` double, `Male Population` int,
    `Female Population` int, `Total Population` int,
    `Number of Veterans` int, `Foreign-born` int,
    `Average Household Size` double, `State Code` string, Race string,
    Count int
"""
