"""Joins, filters and projections."""

from pyspark.sql import functions as F

from landfall.bindings.adapters import countries
from landfall.bindings.registry import query, table
from landfall.operators import (
    add_label,
    append_members,
    conform,
    count_by,
    keep_valid_codes,
    project,
    require_not_null,
    union_sources,
)
from landfall.sources import literal_table, modes, visas

STATUS = [("F", "Finished"), ("O", "Open")]


@query("""
    select o_orderkey, case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open' end as status_label
    from orders
""")
def lookup_left_label(spark, sf_dir):
    labels = F.broadcast(literal_table(spark, STATUS, "status string, label string"))
    orders = table(spark, sf_dir, "orders")
    return add_label(orders, "o_orderstatus", labels, "status", "label", name="status_label", unique=True).select(
        "o_orderkey", "status_label"
    )


@query("""
    select l_orderkey, l_linenumber,
           case l_linenumber when 1 then 'Air' when 2 then 'Sea' when 3 then 'Land' end as i94_mode
    from lineitem
""")
def mode_lookup(spark, sf_dir):
    """A code held as double against the table of modes."""
    lines = table(spark, sf_dir, "lineitem").withColumn("mode", F.col("l_linenumber").cast("double"))
    labelled = add_label(lines, "mode", F.broadcast(modes(spark)), "i94mode", "i94_mode", unique=True)
    return labelled.select("l_orderkey", "l_linenumber", "i94_mode")


@query("""
    select o_orderkey, case o_orderpriority[1] when '1' then 'Business' when '2' then 'Pleasure'
                            when '3' then 'Student' end as i94_visa
    from orders
""")
def visa_lookup(spark, sf_dir):
    """A code held as text such as ``1.0`` against the table of visa categories."""
    code = F.concat(F.col("o_orderpriority").substr(1, 1), F.lit(".0"))
    orders = table(spark, sf_dir, "orders").withColumn("visa", code.try_cast("double").try_cast("int"))
    labelled = add_label(orders, "visa", F.broadcast(visas(spark)), "i94visa", "i94_visa", unique=True)
    return labelled.select("o_orderkey", "i94_visa")


@query("""
    select o_orderkey,
           case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open' else o_orderstatus end as or_code,
           case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open' else '' end as or_empty
    from orders
""")
def lookup_code_fallback(spark, sf_dir):
    labels = F.broadcast(literal_table(spark, STATUS, "status string, label string"))
    orders = table(spark, sf_dir, "orders")
    orders = add_label(
        orders, "o_orderstatus", labels, "status", "label", name="or_code", default=F.col("o_orderstatus"), unique=True
    )
    orders = add_label(orders, "o_orderstatus", labels, "status", "label", name="or_empty", default="", unique=True)
    return orders.select("o_orderkey", "or_code", "or_empty")


@query("""
    select l_suppkey, count(*) as lines from lineitem
    where l_suppkey in (select s_suppkey from supplier where s_acctbal > 0) group by l_suppkey
""")
def valid_code_semi(spark, sf_dir):
    codes = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return count_by(keep_valid_codes(table(spark, sf_dir, "lineitem"), "l_suppkey", codes, "s_suppkey"), ["l_suppkey"], "lines")


@query("""
    with kinds as (
        select l_returnflag as flag, l_linestatus as status, cast(year(l_shipdate) + 1 as integer) as ship_year, count(*) as kind_lines
        from lineitem group by all
    )
    select flag, status, kinds.ship_year, kind_lines, count(*) as lines
    from lineitem join kinds
      on l_returnflag = flag and l_linestatus = status and year(l_shipdate) = kinds.ship_year
    group by all
""")
def multi_key_join(spark, sf_dir):
    """Lines of each kind next to those of the year before; both sides are counted before they meet."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("l_year")
    )
    counts = count_by(lines, ["l_returnflag", "l_linestatus", "l_year"], "lines")
    kinds = counts.withColumn("l_year", F.col("l_year") + 1).toDF("flag", "status", "ship_year", "kind_lines")
    pairs = {"l_returnflag": "flag", "l_linestatus": "status", "l_year": "ship_year"}
    return conform(counts, kinds, pairs).select("flag", "status", "ship_year", "kind_lines", "lines")


@query("""
    with customers as (
        select n_name as city, r_regionkey as state, c_mktsegment as segment, count(*) as people
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        group by all
    )
    select city, state, segment, people, s_suppkey as code
    from customers join (
        select s_suppkey, n_name as locality, n_regionkey as province from supplier join nation on s_nationkey = n_nationkey
    ) on city = locality and state = province
""")
def two_key_join(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    groups = count_by(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "people")
    cities = conform(groups, nation, {"c_nationkey": "n_nationkey"}).select(
        F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("state"),
        F.col("c_mktsegment").alias("segment"),
        "people",
    )
    ports = conform(table(spark, sf_dir, "supplier"), nation, {"s_nationkey": "n_nationkey"}).select(
        F.col("s_suppkey").alias("code"),
        F.col("n_name").alias("locality"),
        F.col("n_regionkey").alias("province"),
    )
    return conform(cities, ports, {"city": "locality", "state": "province"}).drop("locality", "province")


@query("""
    select c_custkey, n_name as country from customer
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where r_name = 'ASIA'
""")
def fact_country_join(spark, sf_dir):
    merged = conform(table(spark, sf_dir, "customer"), countries(spark, sf_dir), {"c_nationkey": "cit_res_code"})
    return merged.filter(F.col("continent") == "Asia").select("c_custkey", "country")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'")
def null_port_drop(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return require_not_null(orders, ["o_orderstatus"]).select("o_orderkey", "o_orderstatus")


@query("""
    select cast(p_partkey as varchar) as part_id, p_brand as brand, cast(p_size as double) as size,
           p_retailprice * 2 as double_price
    from part where p_type = 'PROMO' and p_size = 10
""")
def select_rename_cast(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumns({"double_price": F.col("p_retailprice") * 2, "p_unused": F.lit(1)})
    promo = parts.drop("p_unused", "p_absent").where((F.col("p_type") == "PROMO") & (F.col("p_size") == 10))
    names = {"p_partkey": "part_id", "p_brand": "brand", "p_size": "size", "double_price": "double_price"}
    return project(promo, names, {"part_id": "string", "size": "double"})


@query("""
    select 'customer' as kind, c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
    union all
    select 'supplier', s_suppkey, s_name, s_acctbal, null from supplier
""")
def union_months(spark, sf_dir):
    customers = project(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    suppliers = project(
        table(spark, sf_dir, "supplier"), {"s_acctbal": "balance", "s_name": "name", "s_suppkey": "id"}
    )
    return union_sources(
        customers.withColumn("kind", F.lit("customer")), suppliers.withColumn("kind", F.lit("supplier"))
    )


@query("""
    select s_suppkey as code, s_name as name from supplier
    union all values (-1, 'NOT REPORTED'), (-2, 'UNKNOWN')
""")
def append_unknown_member(spark, sf_dir):
    suppliers = project(table(spark, sf_dir, "supplier"), {"s_suppkey": "code", "s_name": "name"})
    return append_members(suppliers, [(-1, "NOT REPORTED"), (-2, "UNKNOWN")])


@query("select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey = 77")
def large_id_filter(spark, sf_dir):
    """An id beyond the range of int that has been stored as double."""
    shift = 55_442_526_433
    lines = table(spark, sf_dir, "lineitem").withColumn("admnum", (F.col("l_partkey") + shift).cast("double"))
    found = lines.filter(F.col("admnum") == 77 + shift)
    return project(found, {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey"})
