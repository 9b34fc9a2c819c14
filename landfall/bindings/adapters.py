"""The test tables in the roles of arrival records and their dimensions.

Order lines play the arrivals: the customer is the visitor, the supplier the
port, the nation the city, the region the continent or state, the market
segment the population group and the order priority the visa category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.bindings.registry import table
from landfall.functions.dates import DAY_ZERO


def day_number(timestamp: str):
    """A timestamp as days since the day count starts."""
    return F.datediff(F.col(timestamp).cast("date"), F.lit(DAY_ZERO)).cast("double")


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a raw record: coded, with fractions, gaps and invalid text."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        customers, orders.o_custkey == customers.c_custkey
    )
    arrival = day_number("l_shipdate")
    none = F.lit(None).cast("string")
    return joined.select(
        F.col("l_orderkey").cast("double").alias("cicid"),
        F.year("l_shipdate").cast("double").alias("i94yr"),
        F.month("l_shipdate").cast("double").alias("i94mon"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.col("c_nationkey").cast("double").alias("i94res"),
        F.when(F.col("l_tax") > 0, port_code("l_suppkey")).alias("i94port"),
        (arrival + F.col("l_discount")).alias("arrdate"),
        F.col("l_linenumber").cast("double").alias("i94mode"),
        F.col("c_mktsegment").substr(1, 2).alias("i94addr"),
        F.when(F.col("l_linestatus") == "F", arrival + F.col("l_quantity")).alias("depdate"),
        F.col("l_quantity").alias("i94bir"),
        F.col("o_orderpriority").substr(1, 1).cast("double").alias("i94visa"),
        none.alias("dtadfile"),
        none.alias("visapost"),
        none.alias("occup"),
        none.alias("entdepa"),
        none.alias("entdepd"),
        none.alias("entdepu"),
        none.alias("matflag"),
        (F.year("o_orderdate") - F.col("l_quantity")).alias("biryear"),
        F.when(F.col("l_returnflag") == "R", "D/S")
        .otherwise(F.date_format("o_orderdate", "MMddyyyy"))
        .alias("dtaddto"),
        F.col("l_linestatus").alias("gender"),
        F.col("l_partkey").cast("string").alias("insnum"),
        F.col("c_mktsegment").alias("airline"),
        F.col("o_custkey").cast("double").alias("admnum"),
        F.col("l_linenumber").cast("string").alias("fltno"),
        F.col("o_orderstatus").alias("visatype"),
    )


def port_code(key: str):
    return F.concat(F.lit("P"), F.col(key).cast("string"))


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address labels for all market segments but one."""
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") != "MACHINERY")
        .select(
            F.col("c_mktsegment").substr(1, 2).alias("i94addr"),
            F.initcap("c_mktsegment").alias("i94addr_US_state"),
        )
        .distinct()
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select(
        F.col("n_nationkey").alias("cit_res_code"),
        F.col("n_name").alias("country"),
        F.initcap("r_name").alias("continent"),
    )


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One port per supplier; a nation has many."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = places(spark, sf_dir)
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        port_code("s_suppkey").alias("code"),
        F.col("s_name").alias("port"),
        F.col("n_name").alias("locality"),
        F.col("r_name").alias("province"),
        F.lit("United States").alias("territory"),
    )


def city_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ports per nation: its name in full and a short form."""
    return places(spark, sf_dir).select(
        F.explode(
            F.array(F.col("n_name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
        ).alias("code"),
        F.lit(None).cast("string").alias("port"),
        F.col("n_name").alias("locality"),
        F.col("r_name").alias("province"),
        F.lit("United States").alias("territory"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation and market segment as population figures."""
    customers = table(spark, sf_dir, "customer")
    nations = places(spark, sf_dir)
    groups = customers.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("Count"), F.count_if(F.col("c_acctbal") > 0).alias("_positive")
    )
    towns = groups.groupBy("c_nationkey").agg(
        F.sum("Count").alias("_total"), F.sum("_positive").alias("_positives")
    )
    return (
        groups.join(towns, "c_nationkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("City"),
            F.col("r_name").alias("State"),
            F.lit(None).cast("double").alias("Median Age"),
            F.col("_positives").alias("Male Population"),
            (F.col("_total") - F.col("_positives")).alias("Female Population"),
            F.col("_total").alias("Total Population"),
            F.lit(None).cast("bigint").alias("Number of Veterans"),
            F.lit(None).cast("bigint").alias("Foreign-born"),
            F.lit(None).cast("double").alias("Average Household Size"),
            F.substring("r_name", 1, 2).alias("State Code"),
            F.col("c_mktsegment").alias("Race"),
            F.col("Count"),
        )
    )
