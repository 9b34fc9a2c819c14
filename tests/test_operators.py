import random
from collections import Counter

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from landfall.operators import (
    QualityError,
    add_label,
    append_members,
    check_no_rejects,
    check_non_empty,
    check_unique,
    conform,
    count_by,
    dense_rank_by,
    distinct_count,
    duplicate_keys,
    enforce,
    first_per_key,
    global_count,
    keep_valid_codes,
    last_k,
    match_rate,
    profile,
    project,
    reconcile,
    reconcile_filters,
    require_not_null,
    share_of_total,
    top_k,
    union_sources,
    value_counts,
)
from landfall.sources import land, literal_table, read_csv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(
        [(1, "NYC", 1.0), (2, "NYC", 2.0), (3, "ZZZ", 7.0), (4, None, None)], "id int, port string, mode double"
    )


@pytest.fixture(scope="module")
def names(spark):
    return literal_table(spark, [(1, "Air"), (2, "Sea")], "k int, name string")


def test_lookup_keeps_every_row(visits, names):
    got = add_label(visits, "mode", names, "k", "name").select("id", "name")
    assert rows(got) == [(1, "Air"), (2, "Sea"), (3, None), (4, None)]


def test_lookup_fallbacks(visits, names):
    assert rows(add_label(visits, "mode", names, "k", "name", default="").select("id", "name")) == [
        (1, "Air"), (2, "Sea"), (3, ""), (4, ""),
    ]
    code = F.col("mode").cast("string")
    assert rows(add_label(visits, "mode", names, "k", "name", name="mode", default=code).select("id", "mode")) == [
        (1, "Air"), (2, "Sea"), (3, "7.0"), (4, None),
    ]


def test_valid_codes_listed_twice_do_not_multiply(spark, visits):
    codes = spark.createDataFrame([("NYC",), ("NYC",), ("LAX",)], "code string")
    assert rows(keep_valid_codes(visits, "port", codes).select("id")) == [(1,), (2,)]


def test_require_not_null(visits):
    assert rows(require_not_null(visits, ["port", "mode"]).select("id")) == [(1,), (2,), (3,)]


def test_conform_fans_out_and_is_exact(spark):
    cities = spark.createDataFrame([("Laredo", "Texas"), ("laredo", "Texas"), ("Nassau", None)], "c string, s string")
    ports = spark.createDataFrame(
        [("A", "Laredo", "Texas"), ("B", "Laredo", "Texas"), ("C", "Nassau", None)], "code string, l string, p string"
    )
    place = {"c": "l", "s": "p"}
    assert rows(conform(cities, ports, place).select("code")) == [("A",), ("B",)]
    assert rows(conform(cities, ports, place, null_safe=True).select("code")) == [("A",), ("B",), ("C",)]


def test_first_per_key_with_a_hot_key(spark):
    data = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), (F.col("id") * 7919 % 20011).alias("o")
    )
    expected = {}
    for r in data.collect():
        expected[r.k] = min(expected.get(r.k, r.o), r.o)
    got = {r.k: r.o for r in first_per_key(data, ["k"], ["o"]).collect()}
    assert got == expected


def test_counts(spark):
    data = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 2), ("c", 3)], "k string, v int")
    assert rows(count_by(data, ["k"])) == [("a", 2), ("b", 1), ("c", 2)]
    assert rows(duplicate_keys(data, ["k", "v"])) == [("a", 1, 2)]
    assert [tuple(r) for r in value_counts(data, "k").collect()] == [("a", 2), ("c", 2), ("b", 1)]
    assert rows(global_count(data)) == [(5,)]
    assert rows(distinct_count(data, ["v"])) == [(4,)]
    assert rows(distinct_count(data, ["k", "v"])) == [(4,)]
    assert rows(distinct_count(data, ["v"], approximate=True)) == [(4,)]


def test_top_k_puts_null_last_and_breaks_ties(spark):
    data = spark.createDataFrame([("b", 5), ("a", 5), ("c", None), ("d", 9)], "k string, n int")
    assert [r.k for r in top_k(data, 3, "n", ["k"]).collect()] == ["d", "a", "b"]
    assert [r.k for r in top_k(data, 9, "n", ["k"]).collect()] == ["d", "a", "b", "c"]


def test_smallest_and_last_rows(spark):
    data = spark.createDataFrame([("b", 5), ("a", 5), ("c", None), ("d", 9)], "k string, n int")
    assert [r.k for r in top_k(data, 3, "n", ["k"], ascending=True).collect()] == ["a", "b", "d"]
    assert [r.k for r in last_k(data, 2, ["k"]).collect()] == ["c", "d"]


def test_repeated_keys_of_a_lookup_add_no_rows(spark):
    data = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    labels = spark.createDataFrame([("x", "b"), ("x", "a"), (None, "n")], "k string, label string")
    got = sorted((r.id, r.label) for r in add_label(data, "k", labels, "k", "label").collect())
    assert got == [(1, "a"), (2, None), (3, None)]


def test_filters_are_reconciled_in_one_pass(spark):
    data = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    checks = reconcile_filters(data, [F.col("n") < 2, F.col("n") >= 2], "numbers")
    assert rows(checks) == [("reconcile", "numbers", 3, 3, True)]
    tree = plan_text(checks)
    assert tree.count("Exchange (") <= 2  # the final plan's and the initial plan's
    assert not reconcile_filters(data, [F.col("n") < 2], "numbers").collect()[0].passed


def test_rejected_lines_are_counted(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,x\nseven,y\n3,"z"\n')
    with pytest.raises(Exception, match="MALFORMED|BAD"):
        read_csv(spark, str(tmp_path / "x.csv"), "a int, b string").collect()
    landed = land(read_csv(spark, str(tmp_path / "x.csv"), "a int, b string", rejects="bad"), str(tmp_path / "p"))
    assert sorted((r.b, r.a, r.bad) for r in landed.collect()) == [("x", 1, None), ("y", None, "seven,y"), ("z", 3, None)]
    assert rows(check_no_rejects(landed, "bad", "x")) == [("no_rejects", "x", 1, 0, False)]


def test_dense_rank_equals_brute_force(spark):
    rng = random.Random(5)
    # One group and one value hold a third of the rows; values and groups may be NULL.
    data = [
        (i, "hot" if i % 3 == 0 else rng.choice(["x", "y", None]), 1.5 if i % 3 == 1 else rng.choice([None, rng.randint(0, 400) / 4]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(data, "id int, g string, v double").repartition(16)
    got = {r.id: r.place for r in dense_rank_by(df, ["g"], "v", "place").collect()}
    expected = {}
    for group in {g for _, g, _ in data}:
        values = {v for _, g, v in data if g == group}
        order = sorted(values - {None}, reverse=True) + ([None] if None in values else [])
        ranks = {v: n for n, v in enumerate(order, 1)}
        expected |= {i: ranks[v] for i, g, v in data if g == group}
    assert got == expected


def test_dense_rank_over_many_slices(spark):
    df = spark.range(50000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    ranked = dense_rank_by(df, ["g"], "v", "place")
    wrong = ranked.filter(F.col("place") != F.floor((49999 - F.col("v")) / 2) + 1)
    assert wrong.count() == 0 and ranked.count() == 50000


def test_shares(spark):
    data = spark.createDataFrame(
        [("TX", "a", 1), ("TX", "a", 2), ("TX", "b", 1), ("NY", "a", 0), (None, "a", 3)], "s string, r string, n int"
    )
    got = rows(share_of_total(data, ["s", "r"], ["s"], "n", "share"))
    assert got == [
        ("NY", "a", 0, None), ("TX", "a", 1, 75.0), ("TX", "a", 2, 75.0), ("TX", "b", 1, 25.0), (None, "a", 3, 100.0),
    ]


def test_union_by_name_with_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, n string")
    b = spark.createDataFrame([("y", 2, 0.5)], "n string, id int, extra double")
    assert rows(union_sources(a, b)) == [(1, "x", None), (2, "y", 0.5)]


def test_append_members(spark):
    df = spark.createDataFrame([("NYC", "New York")], "code string, place string")
    assert rows(append_members(df, [("XXX", "UNKNOWN"), ("888", None)])) == [
        ("888", None), ("NYC", "New York"), ("XXX", "UNKNOWN"),
    ]


def test_project_renames_and_casts(spark):
    df = spark.createDataFrame([("7", "x", 1.0), ("n/a", "y", 2.0)], "`Total Population` string, `Foreign-born` string, z double")
    got = project(df, {"Total Population": "Total", "Foreign-born": "Foreign-born"}, {"Total": "int"})
    assert got.columns == ["Total", "Foreign-born"] and got.dtypes[0][1] == "int"
    assert rows(got) == [(7, "x"), (None, "y")]


def test_checks(spark, visits):
    empty = visits.filter("false")
    checks = check_non_empty({"visits": visits, "empty": empty})
    assert rows(checks) == [("non_empty", "empty", 0, 1, False), ("non_empty", "visits", 4, 1, True)]
    with pytest.raises(QualityError, match="empty: 0, expected 1"):
        enforce(checks)
    enforce(check_unique(visits, ["id"], "visits"))
    with pytest.raises(QualityError):
        enforce(check_unique(visits, ["port"], "visits"))
    assert rows(check_unique(visits, ["port"], "visits")) == [("unique", "visits", 3, 4, False)]
    assert rows(check_unique(empty, ["port"], "none")) == [("unique", "none", 0, 0, True)]


def test_reconcile(visits):
    a, b = visits.filter("id < 3"), visits.filter("id >= 3")
    assert rows(reconcile([a, b], visits, "visits")) == [("reconcile", "visits", 4, 4, True)]
    assert rows(reconcile([a], visits, "visits")) == [("reconcile", "visits", 4, 2, False)]


def test_match_rate(spark, visits):
    dim = spark.createDataFrame([("NYC",), ("NYC",), (None,)], "code string")
    assert rows(match_rate(visits, dim, {"port": "code"})) == [(4, 2, 50.0)]
    assert rows(match_rate(visits.filter("false"), dim, {"port": "code"})) == [(0, 0, None)]


def test_profile(visits):
    assert rows(profile(visits)) == [
        (0, "id", "int", 4, 0), (1, "port", "string", 4, 1), (2, "mode", "double", 4, 1),
    ]
    exact = rows(profile(visits, distincts="exact"))
    assert [r[-1] for r in exact] == [4, 2, 3]
    assert rows(profile(visits, distincts="approximate")) == exact


def test_totals_survive_skew(spark):
    keys = [0 if i % 3 else i for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    assert {r.k: r.n for r in count_by(df, ["k"]).collect()} == Counter(keys)


def test_hot_keys_are_split_when_no_side_is_small(spark):
    """A third of the rows share one key and nothing may be broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 900000, 1, 16).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20000).alias("k")
        )
        dim = spark.range(20000).select(F.col("id").alias("code"), F.col("id").cast("string").alias("name"))
        results = {
            "label": add_label(facts, "k", dim, "code", "name"),
            "conform": conform(facts, dim, {"k": "code"}),
            "null safe": conform(facts, dim, {"k": "code"}, null_safe=True),
            "valid": keep_valid_codes(facts, "k", dim),
            "rank": dense_rank_by(facts.withColumn("g", F.col("k") % 3), ["g"], "k", "place"),
            "share": share_of_total(facts.withColumn("g", F.col("k") % 3), ["g", "k"], ["g"], "id", "share"),
        }
        for label, df in results.items():
            counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.max(c) for c in df.columns])
            assert counted.collect()[0].n == 900000, label
            assert "skewed" in plan_text(counted), label
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
