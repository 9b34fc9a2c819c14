from pathlib import Path

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from landfall import plans, schemas
from landfall.bindings import QUERIES
from landfall.operators import QualityError, first_per_key
from landfall.schemas import FACT, PORTS, RAW_AIRPORTS, RAW_ARRIVALS, RAW_CITIES
from landfall.sources import literal_table, read_csv, write_csv, write_months, write_table


def fill(spark, schema, *records):
    """Rows given as dictionaries; columns left out are NULL."""
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in records], empty.schema)


@pytest.fixture(scope="module")
def ports(spark):
    return fill(
        spark,
        PORTS,
        {"code": "NYC", "locality": "New York", "province": "New York", "territory": "United States"},
        {"code": "JFK", "port": "Kennedy", "locality": "New York", "province": "New York", "territory": "United States"},
        {"code": "LAR", "locality": "Laredo", "province": "Texas", "territory": "United States"},
        {"code": "HAM", "locality": "Hamilton", "territory": "Bermuda"},
        {"code": "888", "locality": "UNKNOWN", "province": "UNKNOWN", "territory": "UNKNOWN"},
    )


@pytest.fixture(scope="module")
def addresses(spark):
    return literal_table(spark, [("NY", "New York"), ("99", "All Other Codes")], schemas.ADDRESSES)


RAW = [
    {"cicid": 1.0, "i94yr": 2016.0, "i94mon": 4.0, "i94cit": 245.0, "i94port": "NYC", "arrdate": 20573.0,
     "depdate": 20580.5, "i94mode": 1.0, "i94addr": "NY", "i94visa": 3.0, "dtaddto": "10282016", "admnum": 55442526433.0},
    {"cicid": 2.0, "i94yr": 2016.0, "i94mon": 4.0, "i94cit": 245.0, "i94port": "LAR", "arrdate": 0.0,
     "i94mode": 7.0, "i94addr": "??", "i94visa": 9.0, "dtaddto": "D/S", "admnum": 55442526433.0},
    {"cicid": 1.0, "i94yr": 2016.0, "i94mon": 5.0, "i94cit": 999.0, "i94port": "QQQ", "arrdate": None, "admnum": 3.0},
    {"cicid": 4.0, "i94yr": 2016.0, "i94mon": 5.0, "i94port": None, "i94visa": 3.0},
]


@pytest.fixture(scope="module")
def raw(spark):
    return fill(spark, RAW_ARRIVALS, *RAW)


def test_fact(spark, raw, addresses):
    fact = plans.build_fact(raw, addresses)
    assert fact.schema.simpleString() == spark.createDataFrame([], FACT).schema.simpleString()
    got = {(r.cicid, r.i94mon): r for r in fact.collect()}
    assert set(got) == {(1, 4), (2, 4), (1, 5)}
    first = got[1, 4]
    assert (first.iso_arrdate, first.iso_depdate, first.iso_duedate) == ("2016-04-29", "2016-05-06", "2016-10-28")
    assert (first.i94_mode, first.i94_visa, first.i94addr_US_state, first.admnum) == (
        "Air", "Student", "New York", 55442526433,
    )
    second = got[2, 4]
    assert (second.iso_arrdate, second.iso_duedate, second.i94_mode, second.i94_visa, second.i94addr_US_state) == (
        "1960-01-01", None, None, None, None,
    )


def test_fact_as_recorded(raw, addresses):
    second = plans.build_fact(raw, addresses, as_recorded=True).filter("cicid = 2").collect()[0]
    assert (second.iso_arrdate, second.iso_duedate) == (None, "-D/-S")


def test_fact_with_valid_ports_only(raw, addresses, ports):
    fact = plans.build_fact(raw, addresses, valid_ports=ports.select("code"))
    assert sorted(r.i94port for r in fact.collect()) == ["LAR", "NYC"]


AIRPORTS = [
    {"ident": "A", "name": "CorazÃ³n", "iso_country": "US", "iso_region": "US-NY", "municipality": "New York"},
    {"ident": "B", "name": None, "iso_country": "XK", "iso_region": "XK-1", "municipality": "CancÃºn"},
    {"ident": "C", "name": "Wade", "iso_country": "BM", "iso_region": "BM-U-A", "municipality": "Hamilton"},
    {"ident": "D", "name": "é", "iso_country": None, "iso_region": None, "municipality": None},
]


@pytest.fixture(scope="module")
def airports(spark):
    return fill(spark, RAW_AIRPORTS, *AIRPORTS)


@pytest.fixture(scope="module")
def codes(spark):
    countries = literal_table(spark, [("US", "United States"), ("BM", "Bermuda")], schemas.COUNTRY_CODES)
    return countries, literal_table(spark, [("US-NY", "New York")], schemas.SUBDIVISION_CODES)


def test_clean_airports(spark, airports, codes):
    cleaned = plans.clean_airports(airports, *codes)
    expected = spark.createDataFrame([], schemas.CLEAN_AIRPORTS).schema
    assert cleaned.schema.simpleString() == expected.simpleString()
    got = {r.ident: (r.nameL, r.nameE, r.municipalityE, r.country, r.state) for r in cleaned.collect()}
    assert got == {
        "A": ("Corazón", "Corazon", "New York", "United States", "New York"),
        "B": (None, None, "Cancun", "XK", ""),
        "C": ("Wade", "Wade", "Hamilton", "Bermuda", ""),
        "D": ("é", "e", None, None, ""),
    }
    recorded = {r.ident: (r.nameL, r.municipalityL) for r in plans.clean_airports(airports, *codes, as_recorded=True).collect()}
    assert recorded["B"] == ("", "Cancún") and recorded["D"] == ("\ufffd", "")


def test_airports_meet_ports(airports, codes, ports):
    cleaned = plans.clean_airports(airports, *codes)
    got = sorted((r.ident, r.code) for r in plans.build_airports(cleaned, ports).collect())
    assert got == [("A", "JFK"), ("A", "NYC")]
    # A port without a province meets an airport of unknown region only on request.
    got = sorted((r.ident, r.code) for r in plans.build_airports(cleaned, ports, null_safe=True).collect())
    assert got == [("A", "JFK"), ("A", "NYC"), ("C", "HAM")]


CITIES = [
    {"City": "New York", "State": "New York", "Total Population": 100, "Race": "Asian", "Count": 14},
    {"City": "Laredo", "State": "Texas", "Total Population": 50, "Race": "Asian", "Count": 7},
    {"City": "Austin", "State": "Texas", "Total Population": 10, "Race": "Asian", "Count": 9},
    {"City": "Laredo", "State": "Texas", "Total Population": 50, "Race": "White", "Count": None},
    {"City": "Ghost", "State": "Texas", "Total Population": 0, "Race": "White", "Count": 1},
]


@pytest.fixture(scope="module")
def cities(spark):
    return fill(spark, RAW_CITIES, *CITIES)


def test_city_demo(cities, ports):
    demo = plans.build_city_demo(cities, ports)
    got = sorted((r.code, r.Race, r.Race_percent_by_city, r.Race_rank_by_city) for r in demo.collect())
    # Austin has no port but holds rank 1; the other two tie.
    assert got == [
        ("JFK", "Asian", 14.0, 2), ("LAR", "Asian", 14.0, 2), ("LAR", "White", None, 1), ("NYC", "Asian", 14.0, 2),
    ]
    assert "Number_of_Veterans" in demo.columns and "Foreign-born" in demo.columns


def test_city_list(cities):
    assert plans.city_list(cities.union(cities)).count() == 4


@pytest.fixture(scope="module")
def fact(spark):
    def student(cicid, port, admnum, cit=245, visa="Student", mon=8, airline="AA"):
        return {"cicid": cicid, "i94cit": cit, "i94_visa": visa, "admnum": admnum, "airline": airline,
                "i94yr": 2016, "i94mon": mon, "i94port": port}

    return fill(
        spark,
        FACT,
        student(1, "NYC", 10),
        student(2, "LAR", 10),
        student(3, "NYC", 11),
        student(4, "LAR", 12, mon=4, airline=None),
        student(5, "NYC", 13, cit=582),
        student(6, "NYC", 14, visa="Business", airline="BB"),
        student(7, "HAM", 15),
    )


@pytest.fixture(scope="module")
def countries(spark):
    rows = [(245, "china, prc", "Asia"), (582, "mexico", "North America")]
    return literal_table(spark, rows, schemas.COUNTRIES)


def test_port_preference(fact, countries, ports, cities):
    demo = plans.build_city_demo(cities, ports)
    got = plans.port_preference(fact, countries, ports, demo)
    # Hamilton has no demographics. Ranks are by people among the ports.
    assert [(r.i94port, r.students_count, r.locality, r.Count, r.Race_rank_by_city) for r in got.collect()] == [
        ("NYC", 2, "New York", 14, 1), ("LAR", 1, "Laredo", 7, 2),
    ]
    august = plans.port_preference(fact, countries, ports, demo, month=8)
    assert [(r.i94port, r.students_count) for r in august.collect()] == [("NYC", 2)]


def test_top_ports(fact, countries, ports):
    counts = plans.visitor_ports(fact, countries)
    assert [tuple(r) for r in plans.top_ports(counts, k=2).collect()] == [("NYC", 2), ("HAM", 1)]
    assert [r.locality for r in plans.top_ports(counts, ports).collect()] == ["New York", "Hamilton", "Laredo"]


def test_traffic_and_carriers(fact, ports):
    assert [tuple(r) for r in plans.traffic(fact, ports, ["province"], k=2).collect()] == [("New York", 4), ("Texas", 2)]
    assert [tuple(r) for r in plans.carrier_preference(fact, k=5).collect()] == [("AA", 5), ("BB", 1)]
    by_port = plans.carrier_preference(fact, ["i94port", "airline"], month=8)
    assert by_port.filter("i94port = 'NYC' and airline = 'AA'").collect()[0].arrivals == 3


def test_month_keys(spark):
    april = spark.createDataFrame([(1, 7), (2, 7), (3, None)], "cicid int, admnum int")
    may = spark.createDataFrame([(1, 7), (4, 8)], "cicid int, admnum int")
    got = {(r.month, r.key): (r.rows, r.different, r.repeated) for r in plans.month_keys({"april": april, "may": may}).collect()}
    assert got == {
        ("april", "cicid"): (3, 3, 0),
        ("may", "cicid"): (2, 2, 0),
        ("all", "cicid"): (5, 4, 1),
        ("april", "admnum"): (3, 2, 1),
        ("may", "admnum"): (2, 2, 0),
        ("all", "admnum"): (5, 3, 1),
    }


def test_jobs_end_to_end(spark, raw, addresses, airports, codes, ports, cities, tmp_path):
    base = str(tmp_path)
    write_table(raw, f"{base}/extract")
    write_csv(addresses, f"{base}/addresses")
    plans.run_fact(spark, f"{base}/extract", f"{base}/addresses", f"{base}/lake")
    plans.run_fact(spark, f"{base}/extract", f"{base}/addresses", f"{base}/lake")
    assert spark.read.schema(FACT).parquet(f"{base}/lake/I94_data").count() == 3
    write_csv(ports, f"{base}/ports")
    write_table(plans.clean_airports(airports, *codes), f"{base}/airports")
    write_csv(cities, f"{base}/cities", sep=";")
    plans.run_dimensions(spark, f"{base}/ports", f"{base}/airports", f"{base}/cities", f"{base}/lake")
    assert spark.read.parquet(f"{base}/lake/airports").count() == 2
    assert spark.read.parquet(f"{base}/lake/cities_demo").count() == 4


def test_job_fails_on_an_empty_result(spark, raw, addresses, tmp_path):
    write_table(raw.filter("i94port is null"), f"{tmp_path}/extract")
    write_csv(addresses, f"{tmp_path}/addresses")
    with pytest.raises(QualityError):
        plans.run_fact(spark, f"{tmp_path}/extract", f"{tmp_path}/addresses", f"{tmp_path}/lake")


# Plans.


@pytest.fixture(scope="module")
def lake(spark, fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "fact")
    write_months(fact, path)
    return spark.read.schema(FACT).parquet(path)


def test_preference_plan(lake, countries, ports, cities):
    demo = plans.city_shares(cities, ports)
    text = plan_text(plans.port_preference(lake, countries, ports, demo, month=8, port="NYC"))
    assert "TakeOrderedAndProject" in text
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "EvalPython" not in text
    scan = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "i94mon" in scan and "i94port" in scan
    read = next(line for line in text.splitlines() if "ReadSchema" in line and "admnum" in line)
    assert "gender" not in read and "iso_arrdate" not in read


def test_fact_plan_has_no_shuffle(spark, raw, addresses, tmp_path):
    write_table(raw, f"{tmp_path}/raw")
    landed = spark.read.schema(RAW_ARRIVALS).parquet(f"{tmp_path}/raw")
    text = plan_text(plans.build_fact(landed, addresses))
    assert "hashpartitioning(i94addr" not in text and "SortMergeJoin" not in text and "EvalPython" not in text
    assert "IsNotNull(i94port)" in text
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "occup" not in read and "visapost" not in read


def test_unused_labels_vanish_and_visa_filter_reaches_the_scan(spark, raw, addresses, tmp_path):
    write_table(raw, f"{tmp_path}/raw")
    landed = spark.read.schema(RAW_ARRIVALS).parquet(f"{tmp_path}/raw")
    fact = plans.build_fact(landed, addresses).filter(F.col("i94_visa") == "Student").select("admnum")
    text = plan_text(fact)
    assert "i94mode" not in text and "dtaddto" not in text


def test_cleaning_stays_in_the_jvm(spark, airports, codes, tmp_path):
    write_table(airports, f"{tmp_path}/airports")
    stored = spark.read.schema(RAW_AIRPORTS).parquet(f"{tmp_path}/airports")
    text = plan_text(plans.clean_airports(stored, *codes))
    assert "EvalPython" not in text and "SortMergeJoin" not in text


def test_dedupe_limits_before_the_shuffle(lake):
    text = plan_text(first_per_key(lake.select("admnum", "cicid", "i94port"), ["admnum"], ["cicid"]))
    tree = text[: text.index("\n\n")]
    assert "WindowGroupLimit" in tree[tree.index("Exchange") :]


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")
def test_scans_and_shuffles_of_registered_queries(spark):
    """No question joins a lookup it does not use, and no table is read again and again."""

    def tree(name):
        text = plan_text(QUERIES[name](spark, SF_DIR))
        return text[: text.index("\n\n")]

    for name in ("carrier_preference", "flagship_port_preference", "traffic_by_port", "port_match_rate"):
        assert "i94addr" not in plan_text(QUERIES[name](spark, SF_DIR)), name
    assert tree("carrier_preference").count("Scan parquet") == 3
    assert tree("month_keys").count("Scan parquet") == 2  # counts that are stored, for months and for all
    assert tree("row_reconciliation").count("Scan parquet") == 1
    assert tree("row_reconciliation").count("Exchange") == 1
    assert tree("share_of_state").count("Scan parquet") <= 4
    assert tree("multi_key_join").count("SortMergeJoin") + tree("multi_key_join").count("BroadcastHashJoin") == 1
    assert "Expand" not in tree("column_profile")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20kb")
    try:
        assert "hashpartitioning(i94addr" not in plan_text(QUERIES["build_fact"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fact_job_checks_the_months_of_its_load(spark, raw, addresses, tmp_path):
    base = str(tmp_path)
    write_csv(addresses, f"{base}/addresses")
    write_table(raw, f"{base}/april")
    plans.run_fact(spark, f"{base}/april", f"{base}/addresses", f"{base}/lake")
    write_table(raw.limit(0), f"{base}/may")
    with pytest.raises(QualityError, match="non_empty"):
        plans.run_fact(spark, f"{base}/may", f"{base}/addresses", f"{base}/lake")
    write_table(raw.union(raw), f"{base}/twice")
    with pytest.raises(QualityError, match="unique"):
        plans.run_fact(spark, f"{base}/twice", f"{base}/addresses", f"{base}/lake")


def test_dictionary_and_airport_jobs(spark, airports, codes, cities, tmp_path):
    base = str(tmp_path)
    us = ["'FOK' = 'SUFFOLK COUNTY, NY'", "'FRG' = 'Collapsed (FOK) 06/15'", "'PHF' = 'No PORT Code (PHF)'"]
    for name, lines in {"us": us, "abroad": ["'YYZ' = 'Pearson, Toronto, Ontario, Canada'"], "countries": ["101 =  'ALBANIA'='Europe'"],
                        "addresses": ["'AL'='ALABAMA'"]}.items():
        write_table(spark.createDataFrame([(x,) for x in lines], "value string"), f"{base}/{name}", fmt="text")
    problems = plans.run_ports(spark, f"{base}/us", f"{base}/abroad", f"{base}/clean")
    assert [r.problem for r in problems.collect()] == ["withdrawn"]
    stored = {r.code: r.locality for r in read_csv(spark, f"{base}/clean/ports", PORTS).collect()}
    assert stored["FRG"] == stored["FOK"] == "Suffolk County" and len(stored) == 6
    assert read_csv(spark, f"{base}/clean/port_codes", "code string").count() == 6
    plans.run_countries(spark, f"{base}/countries", f"{base}/clean")
    plans.run_addresses(spark, f"{base}/addresses", f"{base}/clean")
    assert tuple(read_csv(spark, f"{base}/clean/addresses").collect()[0]) == ("AL", "Alabama")
    write_csv(airports, f"{base}/raw_airports")
    plans.run_airport_source(spark, f"{base}/raw_airports", *codes, f"{base}/clean")
    assert spark.read.parquet(f"{base}/clean/airports").count() == airports.count()
    write_csv(cities, f"{base}/raw_cities", sep=";")
    plans.run_city_list(spark, f"{base}/raw_cities", f"{base}/clean")
    assert read_csv(spark, f"{base}/clean/cities").count() == 4
