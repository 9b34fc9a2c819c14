"""Checks and profiles."""

from pyspark.sql import functions as F

from landfall.bindings.registry import query, table
from landfall.operators import (
    check_non_empty,
    check_unique,
    frequent_values,
    match_rate,
    profile,
    reconcile,
    reconcile_filters,
    union_sources,
)

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


@query(
    "\nunion all\n".join(
        f"""select 'non_empty' as "check", '{name}' as target, count(*) as measured,
            cast(1 as bigint) as expected, count(*) > 0 as passed from {name}"""
        for name in TABLES
    )
)
def non_empty_check(spark, sf_dir):
    return check_non_empty({name: table(spark, sf_dir, name) for name in TABLES})


@query("""
    select 'unique' as "check", 'orders' as target, count(distinct o_orderkey) as measured,
           count(*) as expected, count(*) = count(distinct o_orderkey) as passed from orders
    union all
    select 'unique', 'lineitem', (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)),
           count(*), count(*) = (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))
    from lineitem
""")
def key_uniqueness(spark, sf_dir):
    return union_sources(
        check_unique(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"),
        check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
    )


@query("""
    select 'reconcile' as "check", 'orders by status' as target, count(*) as measured,
           count(*) as expected, true as passed
    from orders
""")
def row_reconciliation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return reconcile_filters(orders, [F.col("o_orderstatus") == status for status in ("F", "O", "P")], "orders by status")


@query("""
    select 'reconcile' as "check", 'customers and suppliers' as target,
           (select count(*) from customer) as measured,
           (select count(*) from supplier) + (select count(*) from nation) as expected,
           (select count(*) from customer) = (select count(*) from supplier) + (select count(*) from nation) as passed
""")
def table_reconciliation(spark, sf_dir):
    """Parts that are tables of their own."""
    parts = [table(spark, sf_dir, name) for name in ("supplier", "nation")]
    return reconcile(parts, table(spark, sf_dir, "customer"), "customers and suppliers")


@query("""
    select count(*) as rows, count(o_orderkey) as matched, count(o_orderkey) * 100 / count(*) as percent
    from lineitem left join (select o_orderkey from orders where o_orderpriority < '4') on l_orderkey = o_orderkey
""")
def join_match_rate(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority < '4'")
    return match_rate(table(spark, sf_dir, "lineitem"), urgent, {"l_orderkey": "o_orderkey"})


_GAPS = """(
    select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus,
           case when o_totalprice < 250000 then o_totalprice end as o_totalprice,
           nullif(o_orderpriority, '5-LOW') as o_orderpriority
    from orders
)"""

_GAP_COLUMNS = {
    "o_orderkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


def _with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") < 250000, F.col("o_totalprice")).alias("o_totalprice"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )


@query(
    "\nunion all\n".join(
        f"""select {i} as position, '{name}' as "column", '{dtype}' as type, count(*) as rows,
            count(*) - count({name}) as nulls from {_GAPS}"""
        for i, (name, dtype) in enumerate(_GAP_COLUMNS.items())
    )
)
def missing_profile(spark, sf_dir):
    return profile(_with_gaps(spark, sf_dir))


@query(
    "\nunion all\n".join(
        f"""select {i} as position, '{name}' as "column", '{dtype}' as type, count(*) as rows,
            count(*) - count({name}) as nulls, count(distinct {name}) as distinct_values from {_GAPS}"""
        for i, (name, dtype) in enumerate(_GAP_COLUMNS.items())
    )
)
def column_profile(spark, sf_dir):
    return profile(_with_gaps(spark, sf_dir), distincts="exact")


_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    "\nunion all\n".join(
        f"""select '{name}' as "column", cast({name} as varchar) as value, count(*) as rows from lineitem
            group by {name} having count(*) >= 0.05 * (select count(*) from lineitem)"""
        for name in _LINE_COLUMNS
    )
)
def frequent_line_values(spark, sf_dir):
    """Values that make up a twentieth of their column, for all columns in two scans."""
    return frequent_values(table(spark, sf_dir, "lineitem"), 0.05)
