"""Counts and duplicates."""

from pyspark.sql import functions as F

from landfall.bindings.registry import query, table
from landfall.operators import (
    count_by,
    distinct_count,
    duplicate_keys,
    first_per_key,
    global_count,
    value_counts,
)


@query("select o_orderpriority, count(*) as orders from orders group by all")
def group_count(spark, sf_dir):
    return count_by(table(spark, sf_dir, "orders"), ["o_orderpriority"], "orders")


@query("select c_nationkey, c_mktsegment, count(*) as customers from customer group by all")
def group_count_multi(spark, sf_dir):
    return count_by(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "customers")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def having_duplicates(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select count(*) as lines from lineitem")
def global_row_count(spark, sf_dir):
    return global_count(table(spark, sf_dir, "lineitem"), "lines")


@query("""
    select count(*) as parts from (
        select distinct case when l_returnflag <> 'N' then l_partkey end from lineitem
    )
""")
def distinct_count_one(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keyed = lines.select(F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("part"))
    return distinct_count(keyed, ["part"], "parts")


@query("""
    select count(*) as pairs from (
        select distinct l_suppkey, l_returnflag, l_linestatus from lineitem where l_discount > 0.05
    )
""")
def distinct_count_multi(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_discount > 0.05D")
    return distinct_count(lines, ["l_suppkey", "l_returnflag", "l_linestatus"], "pairs")


@query("select distinct c_nationkey, c_mktsegment from customer")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("""
    select o_custkey, o_orderkey, o_orderstatus from (
        select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as nth from orders
    ) where nth = 1
""")
def dedupe_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("select event_type, count(*) as n from events group by all order by n desc, event_type")
def value_frequency(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "events"), "event_type")
