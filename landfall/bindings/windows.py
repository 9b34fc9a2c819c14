"""Ranks, shares and top-k."""

from pyspark.sql import functions as F

from landfall.bindings.adapters import cities
from landfall.bindings.registry import query, table
from landfall.functions import percent_of
from landfall.operators import dense_rank_by, last_k, share_of_total, top_k
from landfall.session import materialize


@query("""
    with shares as (
        select c_custkey, c_mktsegment,
               cast(floor(c_acctbal) as bigint) * 100 / count(*) over (partition by c_nationkey) as percent
        from customer
    )
    select *, dense_rank() over (partition by c_mktsegment order by percent desc) as place from shares
""")
def percent_dense_rank(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    people = customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("people"))
    shares = customers.join(people, "c_nationkey").withColumn("percent", percent_of(F.floor("c_acctbal"), "people"))
    ranked = dense_rank_by(shares, ["c_mktsegment"], "percent", "place")
    return ranked.select("c_custkey", "c_mktsegment", "percent", "place")


@query("""
    with counts as (
        select l_suppkey, l_returnflag, count(*) as lines from lineitem group by all
    )
    select l_suppkey, l_returnflag, lines,
           dense_rank() over (partition by l_returnflag order by lines desc) as place
    from counts
""")
def count_dense_rank(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("lines"))
    return dense_rank_by(counts, ["l_returnflag"], "lines", "place")


@query("""
    with cities as (
        select n_name as city, r_name as state, c_mktsegment as race, count(*) as people
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        group by all
    ), shares as (
        select *, cast(sum(people) over (partition by state, race) as bigint) * 100
                  / cast(sum(people) over (partition by state) as bigint) as percent
        from cities
    )
    select city, state, race, percent, dense_rank() over (partition by race order by percent desc) as place
    from shares
""")
def share_of_state(spark, sf_dir):
    shares = materialize(share_of_total(cities(spark, sf_dir), ["State", "Race"], ["State"], "Count", "percent"))
    ranked = dense_rank_by(shares, ["Race"], "percent", "place")
    return ranked.select(
        F.col("City").alias("city"), F.col("State").alias("state"), F.col("Race").alias("race"), "percent", "place"
    )


@query("""
    select o_orderkey, o_custkey, o_totalprice from orders
    order by o_totalprice desc nulls last, o_orderkey limit 10
""")
def top_orders(spark, sf_dir):
    return top_k(table(spark, sf_dir, "orders"), 10, "o_totalprice", ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("""
    select o_orderkey, o_custkey, o_totalprice from orders
    order by o_totalprice nulls last, o_orderkey limit 10
""")
def cheapest_orders(spark, sf_dir):
    return top_k(table(spark, sf_dir, "orders"), 10, "o_totalprice", ["o_orderkey"], ascending=True).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("""
    select * from (
        select o_orderkey, o_custkey, o_orderpriority from orders order by o_custkey desc, o_orderkey desc limit 12
    ) order by o_custkey, o_orderkey
""")
def last_orders(spark, sf_dir):
    """The tail of the orders in the order of customers."""
    return last_k(table(spark, sf_dir, "orders"), 12, ["o_custkey", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )
