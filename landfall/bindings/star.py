"""The star schema and the questions asked of it."""

from pyspark.sql import functions as F

from landfall import plans
from landfall.bindings import adapters
from landfall.bindings.registry import query, table
from landfall.operators import match_rate, union_sources
from landfall.schemas import ADDRESSES, COUNTRIES, FACT, PORTS
from landfall.session import materialize, scratch_path
from landfall.sources import literal_table, read_csv, read_table, states, write_months, write_sorted, write_table

_RAW = """lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"""

_NATIONS = "nation join region on n_regionkey = r_regionkey"

# Ports as suppliers with their place.
_PORTS = f"""(
    select 'P' || s_suppkey as code, s_name as port, n_name as locality, r_name as province,
           'United States' as territory
    from supplier join {_NATIONS} on s_nationkey = n_nationkey
)"""

# Two ports per nation.
_CITY_PORTS = f"""(
    select unnest([n_name, 'N' || n_nationkey]) as code, n_name as locality, r_name as province
    from {_NATIONS}
)"""

_CITIES = f"""(
    select n_name as city, r_name as state, c_mktsegment as race, count(*) as people,
           count(case when c_acctbal > 0 then 1 end) as positive,
           cast(sum(count(*)) over (partition by n_name) as bigint) as total,
           cast(sum(count(case when c_acctbal > 0 then 1 end)) over (partition by n_name) as bigint) as positives
    from customer join {_NATIONS} on c_nationkey = n_nationkey
    group by n_name, r_name, c_mktsegment
)"""



def _students_sql(where: str = "true") -> str:
    """Students from Asia, each at the port of the first record."""
    return f"""(
        select i94port, count(*) as students_count from (
            select 'P' || l_suppkey as i94port,
                   row_number() over (partition by o_custkey order by l_orderkey, 'P' || l_suppkey) as nth
            from {_RAW} join {_NATIONS} on c_nationkey = n_nationkey
            where r_name = 'ASIA' and o_orderpriority = '3-MEDIUM' and l_tax > 0 and {where}
        ) where nth = 1 group by i94port
    )"""


_STUDENTS = _students_sql()


def _fact(spark, sf_dir):
    """The fact for questions that do not ask for addresses, whose lookup then vanishes."""
    return plans.build_fact(adapters.raw_arrivals(spark, sf_dir), adapters.addresses(spark, sf_dir))


def _full_fact(spark, sf_dir, **options):
    """The fact with addresses from a stored dictionary, whose size the optimizer knows."""
    addresses = materialize(adapters.addresses(spark, sf_dir))
    return plans.build_fact(adapters.raw_arrivals(spark, sf_dir), addresses, **options)


_FACT_SQL = f"""
    select l_orderkey as cicid, c_nationkey as i94cit, c_nationkey as i94res,
           strftime(l_shipdate, '%Y-%m-%d') as iso_arrdate,
           case when l_linestatus = 'F'
                then strftime(l_shipdate + to_days(cast(l_quantity as integer)), '%Y-%m-%d') end as iso_depdate,
           case when l_returnflag <> 'R' then strftime(o_orderdate, '%Y-%m-%d') end as iso_duedate,
           case o_orderpriority[1] when '1' then 'Business' when '2' then 'Pleasure'
                when '3' then 'Student' end as i94_visa,
           case l_linenumber when 1 then 'Air' when 2 then 'Sea' when 3 then 'Land' end as i94_mode,
           o_custkey as admnum, cast(l_partkey as varchar) as insnum,
           case when c_mktsegment <> 'MACHINERY'
                then c_mktsegment[1] || lower(c_mktsegment[2:]) end as "i94addr_US_state",
           c_mktsegment as airline, cast(l_linenumber as varchar) as fltno, o_orderstatus as visatype,
           cast(l_quantity as integer) as i94bir, l_linestatus as gender,
           cast(year(l_shipdate) as integer) as i94yr, cast(month(l_shipdate) as integer) as i94mon,
           'P' || l_suppkey as i94port
    from {_RAW}
    where l_tax > 0
"""


@query(_FACT_SQL)
def build_fact(spark, sf_dir):
    return _full_fact(spark, sf_dir)


@query(f"select * from ({_FACT_SQL}) where i94port in (select 'P' || s_suppkey from supplier where s_acctbal > 0)")
def build_fact_valid_ports(spark, sf_dir):
    valid = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(adapters.port_code("s_suppkey").alias("code"))
    return _full_fact(spark, sf_dir, valid_ports=valid)


def _preference_sql(where: str = "true") -> str:
    return f"""
        select s.i94port, students_count, locality, province, territory, race as "Race", people as "Count",
               people * 100 / total as "Race_percent_by_city", place as "Race_rank_by_city"
        from {_students_sql(where)} s join {_PORTS} p on i94port = code
        join (
            select c.*, dense_rank() over (partition by race order by people desc) as place
            from {_CITIES} c where exists (select 1 from {_PORTS} q where q.locality = c.city and q.province = c.state)
        ) d on d.city = p.locality and d.state = p.province
        where race = 'BUILDING'
        order by students_count desc, s.i94port limit 10
    """


@query(_preference_sql())
def flagship_port_preference(spark, sf_dir):
    """Fact, cities and ports are built from the raw tables, then asked."""
    ports = adapters.ports(spark, sf_dir)
    city_demo = plans.city_shares(adapters.cities(spark, sf_dir), ports)
    return plans.port_preference(
        _fact(spark, sf_dir),
        adapters.countries(spark, sf_dir),
        ports,
        city_demo,
        race="BUILDING",
    )


@query(_preference_sql("month(l_shipdate) = 8"))
def stored_star_preference(spark, sf_dir):
    """The star is stored first; the question is for August and reads only those partitions."""
    fact_path, demo_path = scratch_path(spark, "fact"), scratch_path(spark, "cities_demo")
    ports = adapters.ports(spark, sf_dir)
    write_months(_full_fact(spark, sf_dir), fact_path, ["i94yr", "i94mon"])
    demo = plans.build_city_demo(adapters.cities(spark, sf_dir), ports)
    write_table(demo, demo_path)
    return plans.port_preference(
        read_table(spark, fact_path, FACT),
        adapters.countries(spark, sf_dir),
        ports,
        read_table(spark, demo_path, demo.schema),
        race="BUILDING",
        month=8,
    )


@query(f"""
    select c_mktsegment as airline, 'N' || s_nationkey as i94port, count(*) as arrivals
    from {_RAW} join supplier on l_suppkey = s_suppkey
    where l_tax > 0 and s_nationkey = 3 and year(l_shipdate) = 1996 group by all
""")
def stored_port_carriers(spark, sf_dir):
    """The fact is stored by year, month and port; the question is for one port and year and reads only those files.

    Nations are the ports here, since one file per supplier and month would be tiny.
    """
    path = scratch_path(spark, "fact_by_port")
    suppliers = table(spark, sf_dir, "supplier").select(
        adapters.port_code("s_suppkey").alias("_code"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("_port")
    )
    fact = _full_fact(spark, sf_dir)
    fact = fact.join(suppliers, fact["i94port"] == suppliers["_code"])
    write_months(fact.withColumn("i94port", F.col("_port")).drop("_code", "_port"), path)
    stored = read_table(spark, path, FACT)
    return plans.carrier_preference(stored, by=["airline", "i94port"], year=1996, port="N3")


@query(f"select i94port, students_count from {_STUDENTS}")
def student_ports(spark, sf_dir):
    return plans.visitor_ports(_fact(spark, sf_dir), adapters.countries(spark, sf_dir))


@query(f"select i94port, students_count from {_STUDENTS} order by students_count desc, i94port limit 5")
def top_student_ports(spark, sf_dir):
    return plans.top_ports(plans.visitor_ports(_fact(spark, sf_dir), adapters.countries(spark, sf_dir)))


@query(f"""
    select i94port, students_count, code, port, locality, province, territory
    from {_STUDENTS} join {_PORTS} on i94port = code order by students_count desc, i94port limit 5
""")
def top_student_places(spark, sf_dir):
    counts = plans.visitor_ports(_fact(spark, sf_dir), adapters.countries(spark, sf_dir))
    return plans.top_ports(counts, adapters.ports(spark, sf_dir))


@query("""
    select 'A' || s_suppkey as ident, 'small_airport' as type, cast(floor(s_acctbal) as integer) as elevation_ft,
           'NA' as continent, cast(null as varchar) as gps_code, cast(null as varchar) as iata_code, cast(s_suppkey as varchar) as local_code,
           cast(null as varchar) as coordinates, 'US-' || r_name as iso_region, 'Aeródromo ' || s_name as "nameL",
           n_name as "municipalityL", unnest([n_name, 'N' || n_nationkey]) as code
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where r_name not in ('AFRICA', 'EUROPE')
""")
def build_airports(spark, sf_dir):
    """Suppliers as airfields with a garbled name, in a region or country that may be unknown."""
    nations = adapters.places(spark, sf_dir)
    none = F.lit(None).cast("string")
    raw = (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("ident"),
            F.lit("small_airport").alias("type"),
            F.concat(F.lit("AerÃ³dromo "), "s_name").alias("name"),
            F.floor("s_acctbal").cast("int").alias("elevation_ft"),
            F.lit("NA").alias("continent"),
            F.when(F.col("r_name") == "EUROPE", "XK").otherwise("US").alias("iso_country"),
            F.concat(F.lit("US-"), "r_name").alias("iso_region"),
            F.col("n_name").alias("municipality"),
            none.alias("gps_code"),
            none.alias("iata_code"),
            F.col("s_suppkey").cast("string").alias("local_code"),
            none.alias("coordinates"),
        )
    )
    country_names = literal_table(spark, [("US", "United States")], "alpha_2 string, name string")
    regions = (
        table(spark, sf_dir, "region")
        .filter(F.col("r_name") != "AFRICA")
        .select(F.concat(F.lit("US-"), "r_name").alias("code"), F.col("r_name").alias("name"))
    )
    cleaned = plans.clean_airports(raw, country_names, regions)
    return plans.build_airports(cleaned, adapters.city_ports(spark, sf_dir))


@query("""
    select cast(doc_id as varchar) as ident, source as type, cast(n_chars as integer) as elevation_ft,
           lang as continent, upper(lang) as iso_country, upper(lang) || '-' || source as iso_region,
           cast(null as varchar) as gps_code, cast(null as varchar) as iata_code, cast(null as varchar) as local_code, cast(null as varchar) as coordinates,
           text as "nameL", 'é ' || source as "municipalityL",
           replace(strip_accents(text), 'ß', 'ss') as "nameE", 'e ' || source as "municipalityE",
           case lang when 'de' then 'Germany' when 'fr' then 'France' when 'es' then 'Spain'
                else upper(lang) end as country,
           case when lang = 'es' then '' else 'Region ' || source end as state
    from documents
""")
def clean_airports(spark, sf_dir):
    """Documents as airport records: garbled text as name, language as country."""
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    none = F.lit(None).cast("string")
    documents = table(spark, sf_dir, "documents")
    region = F.concat(F.upper("lang"), F.lit("-"), "source")
    raw = documents.select(
        F.col("doc_id").cast("string").alias("ident"),
        F.col("source").alias("type"),
        garbled.alias("name"),
        F.col("n_chars").cast("int").alias("elevation_ft"),
        F.col("lang").alias("continent"),
        F.upper("lang").alias("iso_country"),
        region.alias("iso_region"),
        F.concat(F.lit("Ã© "), "source").alias("municipality"),
        none.alias("gps_code"),
        none.alias("iata_code"),
        none.alias("local_code"),
        none.alias("coordinates"),
    )
    country_names = literal_table(
        spark, [("DE", "Germany"), ("ES", "Spain"), ("FR", "France")], "alpha_2 string, name string"
    )
    regions = (
        documents.filter(F.col("lang") != "es")
        .select(region.alias("code"), F.concat(F.lit("Region "), "source").alias("name"))
        .distinct()
    )
    return plans.clean_airports(raw, country_names, regions)


@query(f"""
    with ranked as (
        select *, people * 100 / total as percent,
               dense_rank() over (partition by race order by people * 100 / total desc) as place
        from {_CITIES}
    )
    select cast(null as double) as "Median_Age", positives as "Male_Population",
           total - positives as "Female_Population", total as "Total_Population",
           cast(null as bigint) as "Number_of_Veterans", cast(null as bigint) as "Foreign-born",
           cast(null as double) as "Avg_Household_Size", race as "Race", people as "Count",
           percent as "Race_percent_by_city", place as "Race_rank_by_city", code
    from ranked join {_CITY_PORTS} on city = locality and state = province
""")
def build_city_demo(spark, sf_dir):
    return plans.build_city_demo(adapters.cities(spark, sf_dir), adapters.city_ports(spark, sf_dir))


def _us_port_lines(spark, sf_dir):
    """A supplier per line, in a state told by its region; one region has no state, some codes have moved."""
    nations = adapters.places(spark, sf_dir)
    state = (
        F.when(F.col("r_name") == "AFRICA", "AZ")
        .when(F.col("r_name") == "AMERICA", "AL")
        .when(F.col("r_name") == "ASIA", "TX")
        .when(F.col("r_name") == "EUROPE", "NY")
        .otherwise("??")
    )
    facility = F.when(F.col("s_acctbal") > 5000, F.concat("s_name", F.lit(" Airport, "))).otherwise("")
    place = F.concat(facility, "n_name", F.lit(","), state, F.lit("   "))
    # Every ninth code is collapsed into the one before, the next one into that, and a few name no code or each other.
    number = F.col("s_suppkey") % 9
    before = F.concat(F.lit("Collapsed (S"), (F.col("s_suppkey") - 1).cast("string"), F.lit(") 06/15"))
    label = F.when(number.isin(7, 8), before).when(F.col("s_suppkey") % 27 == 4, "Collapsed into S-1, again").otherwise(place)
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("'S"), F.col("s_suppkey").cast("string"), F.lit("'\t=\t'"), label, F.lit("'  ")).alias("value")
        )
    )


def _abroad_port_lines(spark, sf_dir):
    """A customer per line, in a country told by the market segment; some lack the province."""
    nations = adapters.places(spark, sf_dir)
    province = F.when(F.col("c_acctbal") > 0, F.col("r_name")).otherwise("")
    facility = F.when(F.col("c_acctbal") > 5000, F.concat("c_name", F.lit(" Airport, "))).otherwise("")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(
                F.lit("'C"), F.col("c_custkey").cast("string"), F.lit("'\t=\t'"), facility, "n_name", F.lit(", "),
                province, F.lit(", "), "c_mktsegment", F.lit("  '"),
            ).alias("value")
        )
    )


# Each code with the one whose place it has.
_MOVED = """(
    select s_suppkey as code, s_suppkey % 27 = 4 as lost,
           case s_suppkey % 9 when 7 then s_suppkey - 1 when 8 then s_suppkey - 2 else s_suppkey end as place
    from supplier
)"""


@query(f"""
    select 'S' || m.code as code, case when s_acctbal > 5000 then s_name || ' Airport' else '' end as port,
           n_name[1] || lower(n_name[2:]) as locality,
           case r_name when 'AFRICA' then 'Arizona' when 'AMERICA' then 'Alabama' when 'ASIA' then 'Texas'
                when 'EUROPE' then 'New York' end as province,
           'United States' as territory
    from {_MOVED} m join supplier on s_suppkey = m.place
         join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where r_name <> 'MIDDLE EAST' and not lost
    union all
    select 'C' || c_custkey, case when c_acctbal > 5000 then c_name || ' Airport' else '' end, n_name,
           case when c_acctbal > 0 then r_name else '' end, c_mktsegment
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    union all values
        ('XXX', 'NOT REPORTED/UNKNOWN', 'NOT REPORTED/UNKNOWN', 'NOT REPORTED/UNKNOWN', 'NOT REPORTED/UNKNOWN'),
        ('888', 'UNIDENTIFED AIR / SEAPORT', 'UNIDENTIFED AIR / SEAPORT', 'UNIDENTIFED AIR / SEAPORT',
         'UNIDENTIFED AIR / SEAPORT'),
        ('UNK', 'UNKNOWN POE', 'UNKNOWN POE', 'UNKNOWN POE', 'UNKNOWN POE')
""")
def build_ports(spark, sf_dir):
    ports, _ = plans.build_ports(_us_port_lines(spark, sf_dir), _abroad_port_lines(spark, sf_dir), states(spark))
    return ports


@query(f"""
    select 'S' || m.code as code,
           case when lost or m.place <> m.code then 'unknown successor' else 'unknown state' end as problem
    from {_MOVED} m left join supplier on s_suppkey = m.place left join nation on s_nationkey = n_nationkey
         left join region on n_regionkey = r_regionkey
    where lost or s_suppkey is null or r_name = 'MIDDLE EAST'
""")
def port_label_problems(spark, sf_dir):
    _, problems = plans.build_ports(_us_port_lines(spark, sf_dir), _abroad_port_lines(spark, sf_dir), states(spark))
    return problems.select(F.regexp_extract("value", "^'([^']*)'", 1).alias("code"), "problem")


@query("""
    select cast(c_custkey as integer) as cit_res_code, lower(c_name) || ', rep.' as country, c_mktsegment as continent
    from customer
""")
def build_countries(spark, sf_dir):
    lines = table(spark, sf_dir, "customer").select(
        F.concat(
            F.col("c_custkey").cast("string"), F.lit(" =  '"), F.upper("c_name"), F.lit(", REP. ' ='"),
            "c_mktsegment", F.lit("' "),
        ).alias("value")
    )
    return plans.build_countries(lines)


@query("""
    select cast(p_partkey as varchar) as i94addr, p_type[1] || lower(p_type[2:]) || ' Of Parts' as "i94addr_US_state"
    from part
""")
def build_addresses(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select(
        F.concat(
            F.lit("'"), F.col("p_partkey").cast("string"), F.lit("'='"), "p_type", F.lit(" of PARTS' ")
        ).alias("value")
    )
    return plans.build_addresses(lines)


@query(f"""
    select locality, province, cast(sum(n) as bigint) as arrivals
    from (select 'P' || l_suppkey as i94port, count(*) as n from {_RAW} where l_tax > 0 group by 1)
    join {_PORTS} on i94port = code group by all
""")
def traffic_by_city(spark, sf_dir):
    return plans.traffic(_fact(spark, sf_dir), adapters.ports(spark, sf_dir), ["locality", "province"])


@query(f"""
    select code, port, count(*) as arrivals from {_RAW} join {_PORTS} on 'P' || l_suppkey = code
    where l_tax > 0 group by all order by arrivals desc, code, port limit 10
""")
def traffic_by_port(spark, sf_dir):
    return plans.traffic(_fact(spark, sf_dir), adapters.ports(spark, sf_dir), k=10)


@query(f"""
    select case grouping_id(province, locality, code) when 0 then 'port' when 1 then 'city' when 3 then 'state' else 'total' end
               as level, province, locality, code, count(*) as arrivals
    from {_RAW} join {_PORTS} on 'P' || l_suppkey = code where l_tax > 0
    group by rollup (province, locality, code)
""")
def traffic_levels(spark, sf_dir):
    return plans.traffic_levels(_fact(spark, sf_dir), adapters.ports(spark, sf_dir))


@query(f"select i94port, students_count from {_STUDENTS}")
def stored_first_records(spark, sf_dir):
    """First records are stored for each month, then merged over all of them."""
    path = scratch_path(spark, "firsts")
    firsts = plans.first_records(_fact(spark, sf_dir))
    write_table(firsts, path, ["i94yr", "i94mon"])
    return plans.visitor_ports_from(read_table(spark, path, firsts.schema), adapters.countries(spark, sf_dir))


@query(f"select * from ({_FACT_SQL}) where admnum in (7, 42)")
def visitor_lookup(spark, sf_dir):
    """All records of two visitors, from files sorted by visitor."""
    path = scratch_path(spark, "by_visitor")
    write_sorted(_full_fact(spark, sf_dir), path, "admnum")
    return read_table(spark, path, FACT).filter(F.col("admnum").isin(7, 42))


@query(f"""
    select c_mktsegment as airline, count(*) as arrivals from {_RAW} where l_tax > 0
    group by all order by arrivals desc, airline limit 3
""")
def carrier_preference(spark, sf_dir):
    return plans.carrier_preference(_fact(spark, sf_dir), k=3)


@query(f"""
    select 'P' || l_suppkey as i94port, c_mktsegment as airline, count(*) as arrivals
    from {_RAW} where l_tax > 0 group by all
""")
def carrier_preference_by_port(spark, sf_dir):
    return plans.carrier_preference(_fact(spark, sf_dir), by=["i94port", "airline"])


def _month_keys_sql(key: str, column: str) -> str:
    parts = []
    for month, where in (("F", "= 'F'"), ("O", "= 'O'"), ("P", "= 'P'"), ("all", "is not null")):
        parts.append(
            f"""select '{month}' as month, '{key}' as key, cast(sum(n) as bigint) as rows, count(*) as different,
                count(case when n > 1 then 1 end) as repeated
                from (select {column}, count(*) as n from orders where o_orderstatus {where} group by 1)"""
        )
    return "\nunion all\n".join(parts)


@query(_month_keys_sql("cicid", "o_orderkey") + "\nunion all\n" + _month_keys_sql("admnum", "o_custkey"))
def month_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cicid"), F.col("o_custkey").alias("admnum"), "o_orderstatus"
    )
    months = {status: orders.filter(F.col("o_orderstatus") == status) for status in ("F", "O", "P")}
    return plans.month_keys(months)


@query("""
    select distinct n_name as "City", r_name as "State"
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def city_list(spark, sf_dir):
    return plans.city_list(adapters.cities(spark, sf_dir))


@query(f"""
    select count(*) as rows, count(case when s_acctbal > 0 then 1 end) as matched,
           count(case when s_acctbal > 0 then 1 end) * 100 / count(*) as percent
    from (select l_suppkey from {_RAW} where l_tax > 0) join supplier on l_suppkey = s_suppkey
""")
def port_match_rate(spark, sf_dir):
    known = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(adapters.port_code("s_suppkey").alias("code"))
    return match_rate(_fact(spark, sf_dir), known, {"i94port": "code"})


def _dictionary_rows(spark, clean):
    """The stored dictionaries in one table; NULL and empty text stay apart."""
    unknown = [code for code, *_ in plans.UNKNOWN_PORTS]
    ports = read_csv(spark, f"{clean}/ports", PORTS).filter(~F.col("code").isin(unknown))
    countries = read_csv(spark, f"{clean}/countries", COUNTRIES)
    addresses = read_csv(spark, f"{clean}/addresses", ADDRESSES)
    none = F.lit(None).cast("string")
    rows = [
        ports.select(F.lit("ports").alias("dictionary"), "code", "port", "locality", "province", "territory"),
        countries.select(F.lit("countries"), F.col("cit_res_code").cast("string"), "country", "continent", none, none),
        addresses.select(F.lit("addresses"), "i94addr", "i94addr_US_state", none, none, none),
    ]
    return union_sources(*[r.toDF("dictionary", "code", "name", "locality", "province", "territory") for r in rows])


@query("""
    select 'ports' as dictionary, 'S' || s_suppkey as code, 'Dock' as name, n_name[1] || lower(n_name[2:]) as locality,
           'Texas' as province, 'United States' as territory
    from supplier join nation on s_nationkey = n_nationkey where n_regionkey <> 4
    union all
    select 'ports', 'C' || c_custkey, case when c_acctbal > 5000 then c_name || ' Airport' else '' end, n_name,
           case when c_acctbal > 0 then r_name else '' end, c_mktsegment
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    union all
    select 'countries', cast(c_custkey as varchar), lower(c_name), 'Asia', null, null from customer
    union all
    select 'addresses', cast(p_partkey as varchar), 'State Of Parts', null, null, null from part
""")
def stored_dictionaries(spark, sf_dir):
    """All dictionaries from label files, through their jobs and back from the stored CSV."""
    lines, clean = scratch_path(spark, "lines"), scratch_path(spark, "clean")
    nations = adapters.places(spark, sf_dir)
    us = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    state = F.when(F.col("n_regionkey") == 4, "??").otherwise("TX")
    us = us.select(F.concat(F.lit("'S"), F.col("s_suppkey").cast("string"), F.lit("' = 'Dock, "), "n_name", F.lit(", "), state, F.lit("'")).alias("value"))
    countries = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(" = '"), "c_name", F.lit("' = 'Asia'")).alias("value")
    )
    addresses = table(spark, sf_dir, "part").select(
        F.concat(F.lit("'"), F.col("p_partkey").cast("string"), F.lit("' = 'STATE OF PARTS'")).alias("value")
    )
    sources = {"us": us, "abroad": _abroad_port_lines(spark, sf_dir), "countries": countries, "addresses": addresses}
    for name, df in sources.items():
        write_table(df, f"{lines}/{name}", fmt="text")
    plans.run_ports(spark, f"{lines}/us", f"{lines}/abroad", clean)
    plans.run_countries(spark, f"{lines}/countries", clean)
    plans.run_addresses(spark, f"{lines}/addresses", clean)
    return _dictionary_rows(spark, clean)


def _label_file(spark, sf_dir):
    """All dictionaries as the lines of one delivered file: section, place in it, and text."""
    nations = adapters.places(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.col("r_name")
    state = (
        F.when(region == "AFRICA", "AZ (BPS)").when(region == "AMERICA", "ALABAMA #INTL").when(region == "ASIA", "TX")
        .when(region == "EUROPE", "New York").otherwise("ZZ")
    )
    # Every seventh code is collapsed into the one before.
    moved = F.concat(F.lit("Collapsed (S"), (F.col("s_suppkey") - 1).cast("string"), F.lit(") 06/15"))
    place = F.concat("n_name", F.lit(", "), state, F.lit("   "))
    label = F.when(F.col("s_suppkey") % 7 == 6, moved).otherwise(place)
    province = F.when(F.col("c_acctbal") > 0, F.concat("r_name", F.lit(", "))).otherwise("")

    def lines(df, section, key, text):
        return df.select(F.lit(section).alias("section"), F.col(key).alias("place"), text.alias("value"))

    def quoted(prefix, key, sep, text):
        return F.concat(F.lit(f"   '{prefix}"), F.col(key).cast("string"), F.lit(f"'{sep}'"), text, F.lit("'"))

    # The places -2 and -1 come before a section's entries, the last one after them.
    last = 1 << 40
    fixed = [
        (0, -2, "libname library 'anywhere' ;"), (0, -1, "/* a comment; value no"), (0, 0, "   '0' = 'NO ENTRY' */"),
        (1, -1, "  value i94cntyl"), (1, last, ";"), (2, -2, "/* ports */"), (2, -1, "  value $i94prtl"), (2, last, ";"),
        (4, -1, "value i94model"), (4, 0, "   1 = 'Air'"), (4, last, "   9 = 'Not reported' ;"),
        (5, -1, "value i94addrl"), (5, last, "   'XX'='All Other Codes' ;"), (6, 0, "   '0' = 'NO ENTRY'"), (6, 1, "run ;"),
    ]
    countries = F.concat(F.lit("   "), F.col("c_custkey").cast("string"), F.lit(" =  '"), F.upper("c_name"), F.lit("; REP. '"))
    return union_sources(
        spark.createDataFrame(fixed, "section int, place bigint, value string"),
        lines(customers, 1, "c_custkey", countries),
        lines(suppliers, 2, "s_suppkey", quoted("S", "s_suppkey", "\t=\t", label)),
        lines(customers, 2, "c_custkey", quoted("C", "c_custkey", "\t=\t", F.concat("n_name", F.lit(", "), province, "c_mktsegment"))),
        lines(table(spark, sf_dir, "part"), 5, "p_partkey", quoted("", "p_partkey", "=", F.concat("p_type", F.lit(" of PARTS")))),
    )


@query("""
    with moved as (
        select s_suppkey as code, case s_suppkey % 7 when 6 then s_suppkey - 1 else s_suppkey end as place from supplier
    )
    select 'ports' as dictionary, 'S' || code as code, '' as name, n_name[1] || lower(n_name[2:]) as locality,
           case r_name when 'AFRICA' then 'Arizona' when 'AMERICA' then 'Alabama' when 'ASIA' then 'Texas' else 'New York' end
               as province, 'United States' as territory
    from moved join supplier on place = s_suppkey join nation on s_nationkey = n_nationkey
         join region on n_regionkey = r_regionkey where r_name <> 'MIDDLE EAST'
    union all
    select 'ports', 'C' || c_custkey, '', n_name, case when c_acctbal > 0 then r_name else '' end, c_mktsegment
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    union all
    select 'countries', cast(c_custkey as varchar), lower(c_name) || '; rep.', c_mktsegment, null, null from customer
    union all
    select 'addresses', cast(p_partkey as varchar), p_type[1] || lower(p_type[2:]) || ' Of Parts', null, null, null from part
    union all values ('addresses', 'XX', 'All Other Codes', null, null, null)
""")
def label_file_dictionaries(spark, sf_dir):
    """All dictionaries from one label file whose sections run over many splits, back from the stored CSV."""
    path, clean = scratch_path(spark, "label_file"), scratch_path(spark, "clean")
    write_table(_label_file(spark, sf_dir).orderBy("section", "place", "value").select("value"), path, fmt="text")
    continents = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("cit_res_code"), F.col("c_mktsegment").alias("continent")
    )
    plans.run_dictionaries(spark, path, continents, clean, across_files=True)
    return _dictionary_rows(spark, clean)
