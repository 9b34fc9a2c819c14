from landfall import plans
from landfall.operators import accepted, follow_successors, place_parts, redirect_codes, rejected, split_dictionary
from landfall.plans import build_addresses, build_countries, build_port_codes, build_ports, split_ports
from landfall.plans.dictionaries import UNKNOWN_PORTS
from landfall.sources import read_csv, read_labels, states


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


US = [
    "'ALC'\t=\t'ALCAN, AK             '",
    "'HOM'\t=\t'HOMER, AK    '           ",
    "'MOS'\t=\t'Moses Point Airport, MOSES POINT, AK'",
    "'5KE'\t=\t'KETCHIKAN, AK'",
    "'GNV'\t=\t'J R Field - Gainesville Airport, GAINESVILLE,FL'",
    "'WAS'\t=\t'WASHINGTON, DC'",
    "'A4 '\t=\t'Hall, Wing, SALEM, OR'",
    "'BAD'\t=\t'NOWHERE'",
    "'ZZZ'\t=\t'SOMEWHERE, ZZ'",
    "'FRG'\t=\t'Collapsed (FOK) 06/15'",
    "'PHF'\t=\t'No PORT Code (PHF)'",
    "no separator here",
]
ABROAD = [
    "'CLG'\t=\t'Calgary, Alberta, Canada       '",
    "'HAM'\t=\t'Hamilton, , Bermuda'",
    "'LHR'\t=\t'Middlesex, London,England, United Kingdom'",
    "'MAA'\t=\t'Abu Dhabi, , United Arab Emirates'  ",
    "'ONE'\t=\t'Monaco'",
]


def test_ports(spark):
    ports, problems = build_ports(lines(spark, *US), lines(spark, *ABROAD), states(spark))
    got = {tuple(r) for r in ports.collect()}
    assert got == {
        ("ALC", "", "Alcan", "Alaska", "United States"),
        ("HOM", "", "Homer", "Alaska", "United States"),
        ("MOS", "Moses Point Airport", "Moses Point", "Alaska", "United States"),
        ("5KE", "", "Ketchikan", "Alaska", "United States"),
        ("GNV", "J R Field - Gainesville Airport", "Gainesville", "Florida", "United States"),
        ("WAS", "", "Washington", "District of Columbia", "United States"),
        ("A4", "", "Salem", "Oregon", "United States"),
        ("CLG", "", "Calgary", "Alberta", "Canada"),
        ("HAM", "", "Hamilton", "", "Bermuda"),
        ("LHR", "Middlesex", "London", "England", "United Kingdom"),
        ("MAA", "", "Abu Dhabi", "", "United Arab Emirates"),
        *UNKNOWN_PORTS,
    }
    reasons = {r.value.split("\t")[0].strip("' "): r.problem for r in problems.collect()}
    assert reasons == {
        "A4": "too many parts",
        "BAD": "too few parts",
        "ZZZ": "unknown state",
        "FRG": "unknown successor",
        "PHF": "withdrawn",
        "no separator here": "no separator",
        "ONE": "too few parts",
    }


def test_rejects_and_accepted_cover_all_lines(spark):
    entries = split_dictionary(lines(spark, *US), ["code", "label"])
    placed = place_parts(entries, "label", ["locality", "province"], "port")
    both = accepted(placed).count() + rejected(placed).count()
    # A label with too many parts is in both.
    assert both == len(US) + 1


def test_countries(spark):
    text = lines(
        spark,
        "582 =  'MEXICO'='North America'",
        "717 =  'BONAIRE, ST EUSTATIUS, SABA'='South America' ",
        "687 =  'ARGENTINA '='South America'",
        "729 =  'INDIAN OCEAN TERRITORY' ='Asia'",
        "0  =  'INVALID: STATELESS'='INVALID'",
        "705 =  'INVALID: STATELESS'='INVALID'",
    )
    assert sorted(tuple(r) for r in build_countries(text).collect()) == [
        (0, "invalid: stateless", "INVALID"),
        (582, "mexico", "North America"),
        (687, "argentina", "South America"),
        (705, "invalid: stateless", "INVALID"),
        (717, "bonaire, st eustatius, saba", "South America"),
        (729, "indian ocean territory", "Asia"),
    ]


def test_addresses_from_a_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("'AL'='ALABAMA'\n'WV'='West VIRGINIA'\n'WY'='WYOMING' \n'99'='All Other Codes'")
    got = build_addresses(read_labels(spark, str(tmp_path / "a.txt"))).collect()
    assert sorted(tuple(r) for r in got) == [
        ("99", "All Other Codes"), ("AL", "Alabama"), ("WV", "West Virginia"), ("WY", "Wyoming"),
    ]


def test_countries_with_a_table_of_continents(spark):
    text = lines(
        spark,
        "   582 =  'MEXICO Air Sea'",
        "   311 =  'Collapsed Tanzania (should not show)'",
        "   403 =  'No Country Code (403)'",
        "   236 =  'AFGHANISTAN'",
    )
    continents = spark.createDataFrame([(236, "Asia")], "cit_res_code int, continent string")
    assert sorted(tuple(r) for r in build_countries(text, continents).collect()) == [
        (236, "afghanistan", "Asia"), (582, "mexico air sea", None),
    ]


def test_addresses_spelled_as_in_the_state_table(spark):
    text = lines(spark, "'WI'='WISCONSON'", "'DC'='District Of Columbia'", "'99'='All Other Codes'")
    assert sorted(tuple(r) for r in build_addresses(text, states(spark)).collect()) == [
        ("99", "All Other Codes"), ("DC", "District of Columbia"), ("WI", "Wisconsin"),
    ]


def test_port_codes(spark):
    ports, _ = build_ports(lines(spark, *US), lines(spark, *ABROAD), states(spark))
    codes = build_port_codes(ports)
    assert codes.columns == ["code"] and codes.count() == 14


def test_redirects(spark):
    entries = spark.createDataFrame(
        [
            ("FOK", "SUFFOLK COUNTY, NY"),
            ("FRG", "Collapsed (FOK) 06/15"),
            ("ISP", "Collapsed (FOK) 06/15"),
            ("GTF", "Collapsed into INT, MN"),
            ("INT", "INTERNATIONAL FALLS, MN"),
            ("PHF", "No PORT Code (PHF)"),
            ("LST", "Collapsed (NON) 06/15"),
            ("TZA", "Collapsed Tanzania (should not show)"),
        ],
        "code string, label string",
    )
    got = {r.code: (r.target, r.label) for r in redirect_codes(entries, "code", "label").collect()}
    assert got == {
        "FOK": ("FOK", "SUFFOLK COUNTY, NY"),
        "FRG": ("FOK", "SUFFOLK COUNTY, NY"),
        "ISP": ("FOK", "SUFFOLK COUNTY, NY"),
        "GTF": ("INT", "INTERNATIONAL FALLS, MN"),
        "INT": ("INT", "INTERNATIONAL FALLS, MN"),
        "LST": ("NON", None),
    }


def test_chains_and_circles_of_successors(spark):
    pairs = [(f"c{i}", f"c{i + 1}") for i in range(20)] + [("x", "y"), ("y", "z"), ("z", "y"), ("me", "me")]
    got = {r.code: (r.target, r.circular) for r in follow_successors(spark.createDataFrame(pairs, "code string, target string")).collect()}
    assert all(got[f"c{i}"] == ("c20", False) for i in range(20))
    assert all(got[k][1] for k in ("x", "y", "z", "me"))


def test_collapsed_ports_keep_a_place(spark):
    us = [
        "'FOK' = 'SUFFOLK COUNTY, NY'",
        "'FRG' = 'Collapsed (FOK) 06/15'",
        "'HRL' = 'Collapsed into FRG, NY'",
        "'FAR' = 'Collapsed (YYZ) 06/15'",
        "'LST' = 'Collapsed (NON) 06/15'",
        "'ONE' = 'Collapsed (TWO) 06/15'",
        "'TWO' = 'Collapsed (ONE) 06/15'",
        "'PHF' = 'No PORT Code (PHF)'",
    ]
    ports, problems = build_ports(lines(spark, *us), lines(spark, "'YYZ' = 'Pearson, Toronto, Ontario, Canada'"), states(spark), [])
    got = {r.code: (r.locality, r.province) for r in ports.collect()}
    assert got == {
        "FOK": ("Suffolk County", "New York"), "FRG": ("Suffolk County", "New York"), "HRL": ("Suffolk County", "New York"),
        "FAR": ("Toronto", "Ontario"), "YYZ": ("Toronto", "Ontario"),
    }
    assert sorted((r.value[1:4], r.problem) for r in problems.collect()) == [
        ("LST", "unknown successor"), ("ONE", "successors in a circle"), ("PHF", "withdrawn"), ("TWO", "successors in a circle"),
    ]


def test_successors_run_no_job_while_the_plan_is_made(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), (None, "c"), ("d", None)], "code string, target string")
    spark.sparkContext.setJobGroup("planning", "")
    found = follow_successors(pairs)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    assert sorted(tuple(r) for r in found.collect()) == [("a", "c", False), ("b", "c", False), ("d", None, False)]
    assert follow_successors(pairs.limit(0)).collect() == []


def test_ports_of_one_section(spark):
    """States in short and in full, with remarks; ports abroad with two parts or more; withdrawn and odd lines."""
    section = lines(
        spark,
        "'ALC' = 'ALCAN, AK      '", "'CUR' = 'CURLEW, WA (BPS)'", "'BLI' = 'BELLINGHAM, WASHINGTON #INTL'",
        "'MOS' = 'Moses Airport, MOSES, AK'", "'EDA' = 'EDMONTON, CANADA'", "'CLG' = 'Calgary, Alberta, Canada'",
        "'LHR' = 'Heathrow, London, England, United Kingdom'", "'FRG' = 'Collapsed (ALC) 06/15'",
        "'PHF' = 'No PORT Code (PHF)'", "'ZZZ' = 'SOMEWHERE, ZZ'", "'ONE' = 'Monaco'", "no entry",
    )
    ports, problems = build_ports(*split_ports(section, states(spark)), states(spark), [])
    assert {tuple(r) for r in ports.collect()} == {
        ("ALC", "", "Alcan", "Alaska", "United States"),
        ("CUR", "", "Curlew", "Washington", "United States"),
        ("BLI", "", "Bellingham", "Washington", "United States"),
        ("MOS", "Moses Airport", "Moses", "Alaska", "United States"),
        ("FRG", "", "Alcan", "Alaska", "United States"),
        ("EDA", "", "EDMONTON", "", "CANADA"),
        ("CLG", "", "Calgary", "Alberta", "Canada"),
        ("LHR", "Heathrow", "London", "England", "United Kingdom"),
    }
    assert sorted(r.problem for r in problems.collect()) == ["no separator", "too few parts", "unknown state", "withdrawn"]


def test_dictionaries_from_one_file(spark, tmp_path):
    text = """
      value i94cntyl
       582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'
       996 =  'No Country Code (996)' ;
      value $i94prtl
       'ALC'\t=\t'ALCAN, AK'
       'PHF'\t=\t'No PORT Code (PHF)'
    ;
      value i94addrl
    'AL'='ALABAMA'
    'WI'='WISCONSON'
    ;
    """
    (tmp_path / "labels").write_text(text)
    continents = spark.createDataFrame([(582, "North America")], "cit_res_code int, continent string")
    problems = plans.run_dictionaries(spark, f"{tmp_path}/labels", continents, f"{tmp_path}/clean")
    assert [r.problem for r in problems.collect()] == ["withdrawn"]
    clean = {name: sorted(tuple(r) for r in read_csv(spark, f"{tmp_path}/clean/{name}").collect())
             for name in ("ports", "port_codes", "countries", "addresses")}
    assert clean["ports"][1] == ("ALC", "", "Alcan", "Alaska", "United States") and len(clean["ports"]) == 4
    assert clean["countries"] == [("582", "mexico air sea, and not reported (i-94, no land arrivals)", "North America")]
    assert clean["addresses"] == [("AL", "Alabama"), ("WI", "Wisconsin")]
