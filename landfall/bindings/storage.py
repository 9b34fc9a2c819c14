"""Round trips through files in the shared folder."""

from pyspark.sql import functions as F

from landfall import plans
from landfall.bindings import adapters
from landfall.bindings.registry import query, table
from landfall.operators import QualityError, accepted, distinct_sketches, merged_counts, project, split_dictionary
from landfall.session import scratch_path
from landfall.sources import (
    compact,
    land,
    read_arrivals,
    read_csv,
    read_labels,
    read_table,
    replace_month,
    write_csv,
    write_months,
    write_table,
)

_MONTHLY = "o_orderkey bigint, o_custkey bigint, o_totalprice double, yr int, mon int, port string"


def _monthly_orders(spark, sf_dir):
    """Orders with year, month and an all-digit text code as partition keys."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.year("o_orderdate").alias("yr"),
        F.month("o_orderdate").alias("mon"),
        F.concat(F.lit("00"), F.translate("o_orderstatus", "FOP", "123")).alias("port"),
    )


@query("""
    select o_orderkey, o_custkey, o_totalprice, cast(year(o_orderdate) as integer) as yr,
           cast(month(o_orderdate) as integer) as mon, '00' || translate(o_orderstatus, 'FOP', '123') as port
    from orders
""")
def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    write_table(_monthly_orders(spark, sf_dir), path, keys=["yr", "mon", "port"])
    return read_table(spark, path, _MONTHLY)


@query("""
    select cast(year(o_orderdate) as integer) as yr, cast(month(o_orderdate) as integer) as mon, count(*) as orders
    from orders
    where not (year(o_orderdate) = 1996 and month(o_orderdate) = 4 and o_orderstatus = 'P')
    group by all
""")
def month_overwrite(spark, sf_dir):
    """All months are stored; then one is loaded again, where a port has disappeared."""
    keys = ["yr", "mon", "port"]
    path = scratch_path(spark, "months")
    orders = _monthly_orders(spark, sf_dir)
    write_months(orders, path, keys)
    corrected = orders.filter(F.col("port") != "003")
    for _ in range(2):
        replace_month(corrected, path, 1996, 4, keys)
    stored = read_table(spark, path, _MONTHLY)
    return stored.groupBy("yr", "mon").agg(F.count(F.lit(1)).alias("orders"))


@query("""
    select cast(year(o_orderdate) as integer) as yr, cast(month(o_orderdate) as integer) as mon, count(*) as orders,
           count(case when month(o_orderdate) > 6 then 1 end) as corrected
    from orders group by all
""")
def month_append(spark, sf_dir):
    """The months of each half-year arrive in turn, the second ones twice, at last with corrected prices."""
    keys = ["yr", "mon"]
    path = scratch_path(spark, "arriving")
    orders = _monthly_orders(spark, sf_dir)
    corrected = orders.withColumn("o_totalprice", -F.col("o_totalprice"))
    for arriving in (orders.filter("mon <= 6"), orders.filter("mon > 6"), corrected.filter("mon > 6")):
        write_months(arriving, path, keys)
    stored = read_table(spark, path, _MONTHLY)
    return stored.groupBy("yr", "mon").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_totalprice") < 0).alias("corrected")
    )


def _guarded_loads(spark, sf_dir):
    """All months arrive; then April 1996 with records that repeat, May corrected, and May once more under the same name."""
    keys = ["yr", "mon", "port"]
    path = scratch_path(spark, "guarded")
    orders = _monthly_orders(spark, sf_dir)
    april, may = (orders.filter((F.col("yr") == 1996) & (F.col("mon") == month)) for month in (4, 5))
    corrected = may.filter("port <> '003'").withColumn("o_totalprice", -F.col("o_totalprice"))
    plans.load_months(orders, path, "all months", ["o_orderkey"], keys)
    try:
        plans.load_months(april.union(april.filter("o_orderkey % 2 = 0")), path, "April again", ["o_orderkey"], keys)
    except QualityError:
        pass  # as it should: the ledger tells
    for rows in (corrected, may):
        plans.load_months(rows, path, "May corrected", ["o_orderkey"], keys)
    return path


@query("""
    select o_orderkey, case when yr = 1996 and mon = 5 then -o_totalprice else o_totalprice end as o_totalprice, yr, mon, port
    from (
        select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as yr,
               cast(month(o_orderdate) as integer) as mon, '00' || translate(o_orderstatus, 'FOP', '123') as port
        from orders
    ) where not (yr = 1996 and mon = 5 and port = '003')
""")
def guarded_months(spark, sf_dir):
    """What is stored after a rejected and a corrected load."""
    stored = read_table(spark, _guarded_loads(spark, sf_dir), _MONTHLY)
    return stored.select("o_orderkey", "o_totalprice", "yr", "mon", "port")


@query("""
    with months as (
        select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, count(*) as n,
               count(*) filter (o_orderkey % 2 = 0) as even, count(*) filter (o_orderstatus <> 'P') as corrected
        from orders group by all
    )
    select 'all months' as load, year, month, n as rows, n as different, 'published' as status from months
    union all
    select 'April again', year, month, n + even, n, 'rejected' from months where year = 1996 and month = 4
    union all
    select 'May corrected', year, month, corrected, corrected, 'published' from months where year = 1996 and month = 5
""")
def load_ledger(spark, sf_dir):
    """What the ledger tells about the loads."""
    history = plans.load_history(spark, _guarded_loads(spark, sf_dir))
    return plans.last_steps(history).select("load", "year", "month", "rows", "different", "status")


@query("""
    select o_orderkey, o_custkey, o_totalprice, cast(year(o_orderdate) as integer) as yr,
           cast(month(o_orderdate) as integer) as mon, '00' || translate(o_orderstatus, 'FOP', '123') as port
    from orders
""")
def compacted_months(spark, sf_dir):
    """Months arrive in three pieces, so each partition has as many files; then they are put together."""
    keys = ["yr", "mon", "port"]
    path = scratch_path(spark, "pieces")
    orders = _monthly_orders(spark, sf_dir)
    for piece in range(3):
        write_table(orders.filter(F.col("o_orderkey") % 3 == piece), path, keys, mode="append")
    compact(spark, path, _MONTHLY, keys)
    return read_table(spark, path, _MONTHLY)


@query("""
    select cast(year(o_orderdate) as integer) as yr, count(*) as rows, count(distinct o_custkey) as different, true as close
    from orders group by all
""")
def merged_distincts(spark, sf_dir):
    """Sketches of each month's customers are stored; years are estimated from them, within 6 % of the exact number."""
    path = scratch_path(spark, "sketches")
    orders = _monthly_orders(spark, sf_dir)
    sketches = distinct_sketches(orders, ["yr", "mon"], "o_custkey")
    write_table(sketches, path)
    merged = merged_counts(read_table(spark, path, sketches.schema), ["yr"], "estimate")
    exact = orders.groupBy(F.col("yr").alias("_yr")).agg(F.count_distinct("o_custkey").alias("different"))
    close = F.abs(F.col("estimate") - F.col("different")) <= F.col("different") * 0.06
    return merged.join(exact, F.col("yr") == F.col("_yr")).select("yr", "rows", "different", close.alias("close"))


@query("""
    select n_name as "City", r_name as "State", c_mktsegment as "Race", count(*) as "Count"
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    group by all
""")
def cities_by_state(spark, sf_dir):
    path = scratch_path(spark, "cities")
    cities = adapters.cities(spark, sf_dir)
    write_table(cities, path, keys=["State"])
    return read_table(spark, path, cities.schema).select("City", "State", "Race", "Count")


@query("select c_custkey as code, c_name as label from customer")
def label_text_scan(spark, sf_dir):
    path = scratch_path(spark, "labels")
    line = F.format_string("'%d'\t=\t'%s'", "c_custkey", "c_name")
    write_table(table(spark, sf_dir, "customer").select(line.alias("value")), path, fmt="text")
    entries = accepted(split_dictionary(read_labels(spark, path), ["code", "label"]))
    return project(entries, ["code", "label"], {"code": "bigint"})


_NO_TEXT = ", ".join(
    f"cast(null as varchar) as {name}"
    for name in ("dtadfile", "visapost", "occup", "entdepa", "entdepd", "entdepu", "matflag")
)


@query(f"""
    select cast(l_orderkey as double) as cicid, cast(year(l_shipdate) as double) as i94yr,
           cast(month(l_shipdate) as double) as i94mon, cast(c_nationkey as double) as i94cit,
           cast(c_nationkey as double) as i94res, case when l_tax > 0 then 'P' || l_suppkey end as i94port,
           cast(date_diff('day', date '1960-01-01', cast(l_shipdate as date)) as double) + l_discount as arrdate,
           cast(l_linenumber as double) as i94mode, c_mktsegment[1:2] as i94addr,
           case when l_linestatus = 'F'
                then cast(date_diff('day', date '1960-01-01', cast(l_shipdate as date)) as double) + l_quantity
           end as depdate,
           l_quantity as i94bir, cast(o_orderpriority[1] as double) as i94visa, {_NO_TEXT},
           year(o_orderdate) - l_quantity as biryear,
           case when l_returnflag = 'R' then 'D/S' else strftime(o_orderdate, '%m%d%Y') end as dtaddto,
           l_linestatus as gender, cast(l_partkey as varchar) as insnum, c_mktsegment as airline,
           cast(o_custkey as double) as admnum, cast(l_linenumber as varchar) as fltno, o_orderstatus as visatype
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
""")
def arrivals_ingest(spark, sf_dir):
    """The raw extract as delivered in CSV, landed as Parquet, read under its contract: all 27 columns."""
    delivered, landed = scratch_path(spark, "extract"), scratch_path(spark, "landed")
    write_csv(adapters.raw_arrivals(spark, sf_dir), delivered)
    land(read_arrivals(spark, delivered, fmt="csv"), landed)
    return read_arrivals(spark, landed)


@query("""
    select s_suppkey, s_nationkey, case when s_acctbal > 0 then s_acctbal end as s_acctbal,
           case s_suppkey % 6 when 0 then null when 1 then '' when 2 then s_name || '|"' || s_name || '"'
                when 3 then s_name || chr(10) || '  second line ' when 4 then chr(13) || chr(10) || ',' else s_name end as s_name
    from supplier
""")
def csv_roundtrip(spark, sf_dir):
    """NULL, empty text, quotes, separators, blanks and line breaks come back as they were."""
    path = scratch_path(spark, "suppliers")
    name, case = F.col("s_name"), F.col("s_suppkey") % 6
    odd = (
        F.when(case == 0, None)
        .when(case == 1, "")
        .when(case == 2, F.concat(name, F.lit('|"'), name, F.lit('"')))
        .when(case == 3, F.concat(name, F.lit("\n  second line ")))
        .when(case == 4, F.lit("\r\n,"))
        .otherwise(name)
    )
    balance = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))
    suppliers = table(spark, sf_dir, "supplier").withColumns({"s_name": odd, "s_acctbal": balance})
    write_csv(suppliers, path, sep="|", multi_line=True)
    return read_csv(spark, path, suppliers.schema, sep="|", multi_line=True)


@query("""
    select 'rejected' as kind, count(*) as n from supplier where s_suppkey % 7 = 0
    union all
    select 'read', count(*) from supplier where s_suppkey % 7 <> 0
""")
def rejected_csv_lines(spark, sf_dir):
    """Lines with a balance that is no number are kept apart and counted."""
    path = scratch_path(spark, "damaged")
    balance = F.when(F.col("s_suppkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("s_acctbal").cast("string"))
    write_csv(table(spark, sf_dir, "supplier").withColumn("s_acctbal", balance), path)
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    landed = land(read_csv(spark, path, schema, rejects="reject"), scratch_path(spark, "landed"))
    kind = F.when(F.col("reject").isNotNull(), "rejected").otherwise("read")
    return landed.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("select * from documents")
def latin1_csv_roundtrip(spark, sf_dir):
    """Whole texts with their line breaks, in an encoding of one byte per character."""
    path = scratch_path(spark, "latin1")
    documents = table(spark, sf_dir, "documents")
    write_csv(documents, path, sep="|", encoding="ISO-8859-1", multi_line=True)
    return read_csv(spark, f"{path}/*.csv", documents.schema, sep="|", encoding="ISO-8859-1", multi_line=True)


@query("""
    select cast(c_custkey as integer) as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
""")
def inferred_csv_scan(spark, sf_dir):
    """Types as inferred: these ids fit an int."""
    path = scratch_path(spark, "inferred")
    write_csv(table(spark, sf_dir, "customer"), path, sep=";")
    return read_csv(spark, path, sep=";", infer=True)


@query("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def landing_conversion(spark, sf_dir):
    source = scratch_path(spark, "delivered")
    parts = table(spark, sf_dir, "part")
    write_csv(parts, source)
    return land(read_csv(spark, source, parts.schema), scratch_path(spark, "landed"))
