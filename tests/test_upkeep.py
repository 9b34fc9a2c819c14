"""Names, frequent values, sketches, sorted files and compaction."""

import random
from collections import Counter

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from landfall import plans
from landfall.operators import distinct_sketches, frequent_values, merged_counts, repair_names, with_repairs
from landfall.schemas import FACT
from landfall.sources import compact, file_sizes, read_table, small_partitions, write_sorted, write_table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


# Names


def test_repairs_equal_all_pairs(spark):
    """Edits of any kind, names of one letter or none, signs beyond ASCII, ties, and several states."""
    rng = random.Random(2)
    known = [("NY", "Buffalo"), ("NY", "Bufallo"), ("VT", "Richford"), ("VT", ""), ("VT", "A"), ("MN", "Łódź"), (None, "Nowhere"), ("NY", None)]
    known += [(rng.choice(("NY", "VT")), "".join(rng.choices("abc", k=rng.randrange(8)))) for _ in range(60)]
    names = [("VT", "Richfort"), ("NY", "Buffallo"), ("NY", "Richfort"), ("VT", "Z"), ("MN", "Lódz"), (None, "Nowher"), ("NY", None), ("VT", "Richfort")]
    for state, name in known:
        edited = list(name or "")
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(edited) + 1)
            edited[i : i + rng.randrange(2)] = rng.choice(("", "a", "x"))
        names.append((state, "".join(edited)))
    df, table = (spark.createDataFrame(x, "state string, name string") for x in (names, known))
    expected = set()
    for state, name in set(names):
        if name is None or (state, name) in known:
            continue
        found = sorted({(distance(name, k), k) for s, k in known if s == state and k is not None and distance(name, k) <= 2})
        least = [k for d, k in found if d == found[0][0]]
        expected.add((state, name, least[0] if len(least) == 1 else None, found[0][0] if found else None, tuple(least)))
    got = repair_names(df, "name", table, within=["state"])
    assert {(r.state, r.name, r.repaired, r.distance, tuple(r.candidates)) for r in got.collect()} == expected
    mended = [tuple(r) for r in with_repairs(df, "name", got, ["state"]).collect()]
    right = {(s, n): r or n for s, n, r, _, _ in expected}
    assert Counter(mended) == Counter((s, right.get((s, n), n)) for s, n in names)


def test_names_do_not_meet_all_with_all(spark):
    df = spark.createDataFrame([("ab",)], "name string")
    text = plan_text(repair_names(df, "name", df))
    assert "NestedLoop" not in text and "Cartesian" not in text and "EvalPython" not in text


def test_names_are_spread_before_their_keys(spark):
    known = spark.createDataFrame([(f"name{i:03d}",) for i in range(300)], "name string")
    wrong = spark.createDataFrame([(f"nme{i:03d}",) for i in range(0, 300, 7)], "name string")
    got = repair_names(wrong, "name", known)
    assert "REPARTITION_BY_NUM" in plan_text(got)
    assert {(r.name, r.repaired, r.distance) for r in got.collect()} == {(f"nme{i:03d}", f"name{i:03d}", 1) for i in range(0, 300, 7)}


def test_repairs_of_nothing(spark):
    none = spark.createDataFrame([], "name string")
    some = spark.createDataFrame([("a",), (None,)], "name string")
    assert repair_names(none, "name", some).collect() == []
    assert [tuple(r) for r in repair_names(some, "name", none).collect()] == [("a", None, None, [])]


# Frequent values


def test_frequent_values_are_exact(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice([None, 1, 1, 2, k]), rng.choice(["x" * 5000, "y", None, "", str(k), str(k), str(k)]), k / 7, rng.random() < 0.99, [k])
        for k in range(5000)
    ]
    df = spark.createDataFrame(rows, "a int, `b c` string, d double, e boolean, f array<int>")
    expected = set()
    for i, name in enumerate(("a", "b c", "d", "e")):
        for value, n in Counter(r[i] for r in rows).items():
            if n >= 0.05 * len(rows):
                text = str(value).lower() if isinstance(value, bool) else value if value is None else str(value)
                expected.add((name, text, n))
    assert {tuple(r) for r in frequent_values(df).collect()} == expected
    assert frequent_values(df.limit(0)).collect() == []


def test_frequent_values_take_two_scans(spark, tmp_path):
    write_table(spark.range(100).selectExpr("id % 3 as a", "id % 4 as b", "id % 5 as c", "id as d"), f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    text = plan_text(frequent_values(df))
    # The first scan has run; the second one is the only one of the plan.
    assert text.count("Scan parquet") == 2 and text.count("Location") == 1


# Sketches


def test_merged_sketches_are_close(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 12).alias("month"), F.when(F.col("id") % 100 > 0, F.col("id") % 30_011).alias("who")
    )
    stored = distinct_sketches(rows, ["month"], "who")
    got = merged_counts(stored.withColumn("year", F.lit(1)), ["year"]).first()
    exact = rows.agg(F.count_distinct("who")).first()[0]
    assert got.rows == 200_000 and abs(got.different - exact) <= 0.06 * exact


# First records


@pytest.mark.parametrize("month", [None, 2])
def test_first_records_merge_over_months(spark, month):
    rng = random.Random(5)
    rows = [
        (rng.randrange(400), rng.randrange(4), rng.choice(["Student", "Business", None]), rng.choice([None, *range(60)]),
         rng.choice([None, "A", "B", "C"]), 2016, rng.choice((1, 2, 3)))
        for _ in range(1500)
    ]
    fact = spark.createDataFrame(rows, "cicid bigint, i94cit int, i94_visa string, admnum bigint, i94port string, i94yr int, i94mon int")
    countries = spark.createDataFrame([(1, "Asia"), (2, "Asia"), (3, "Europe")], "cit_res_code int, continent string")
    expected = plans.visitor_ports(fact, countries, month=month)
    got = plans.visitor_ports_from(plans.first_records(fact), countries, month=month)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


# Levels


def test_levels_of_traffic(spark):
    """A state without a name is a state of its own, apart from the total."""
    fact = spark.createDataFrame([("A", 1), ("A", 1), ("B", 1), ("C", 2), ("?", 1)], "i94port string, i94mon int")
    ports = spark.createDataFrame(
        [("A", "p", "X", "N", "U"), ("B", "q", "Y", "N", "U"), ("C", "r", "Z", None, "U")],
        "code string, port string, locality string, province string, territory string",
    )
    got = {tuple(r) for r in plans.traffic_levels(fact, ports).collect()}
    assert got == {
        ("port", "N", "X", "A", 2), ("port", "N", "Y", "B", 1), ("port", None, "Z", "C", 1),
        ("city", "N", "X", None, 2), ("city", "N", "Y", None, 1), ("city", None, "Z", None, 1),
        ("state", "N", None, None, 3), ("state", None, None, None, 1), ("total", None, None, None, 4),
    }
    assert len(plans.traffic_levels(fact, ports, month=2).collect()) == 4


# Files


def rows_read(df):
    """Rows that the scan gave on, of a plan that has run."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    return rows, scan.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    fact = spark.range(n).select((F.col("id") * 7919 % n).alias("admnum"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    write_sorted(fact, f"{tmp_path}/sorted", "admnum", row_group_bytes=1 << 18)
    stored = read_table(spark, f"{tmp_path}/sorted", "admnum bigint, text string")
    rows, read = rows_read(stored.filter("admnum = 1234"))
    assert len(rows) == 1 and read < n / 20
    # Keys that no file holds are ruled out by the Bloom filters, though they lie within the range of a row group.
    gaps = fact.filter("admnum % 2 = 0")
    write_sorted(gaps, f"{tmp_path}/gaps", "admnum", row_group_bytes=1 << 18)
    rows, read = rows_read(read_table(spark, f"{tmp_path}/gaps", "admnum bigint, text string").filter("admnum = 1235"))
    assert rows == [] and read == 0


def test_sorted_files_keep_their_partitions(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("month"))
    write_sorted(rows, f"{tmp_path}/t", "id", ["month"])
    stored = read_table(spark, f"{tmp_path}/t", "id bigint, month bigint")
    assert stored.filter("month = 1 and id = 4").count() == 1 and stored.count() == 1000


def test_compaction_rewrites_only_what_needs_it(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id bigint, month int, port string"
    rows = spark.range(3000).select(
        "id", (F.col("id") % 3).cast("int").alias("month"), F.when(F.col("id") % 5 > 0, F.lit("001")).alias("port")
    )
    for piece in range(4):
        write_table(rows.filter((F.col("id") % 4 == piece) & (F.col("month") < 2)), path, ["month", "port"], mode="append")
    write_table(rows.filter("month = 2"), path, ["month", "port"], mode="append")
    whole = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/month=2/**/*.parquet")}
    plan = small_partitions(file_sizes(spark, path))
    assert sorted((r.files, r.wanted) for r in plan.collect()) == [(4, 1)] * 4
    # Jobs of two partitions at most, by their bytes.
    most = max(r.bytes for r in plan.collect())
    assert compact(spark, path, schema, ["month", "port"], job_bytes=2 * most) == 4
    assert {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/month=2/**/*.parquet")} == whole
    files = file_sizes(spark, path).groupBy("folder").count().collect()
    assert [r["count"] for r in files] == [1] * 6
    assert sorted(map(tuple, read_table(spark, path, schema).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert compact(spark, path, schema, ["month", "port"]) == 0


def test_large_partitions_get_several_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(1).alias("month"))
    rows.repartition(40).write.partitionBy("month").parquet(path)
    total = file_sizes(spark, path).agg(F.sum("bytes")).first()[0]
    assert compact(spark, path, "text string, month int", ["month"], target_bytes=total // 4) == 1
    assert 2 <= file_sizes(spark, path).count() < 40
    assert read_table(spark, path, "text string, month int").distinct().count() == 60_000


def test_visitors_are_found_in_the_stored_fact(spark, tmp_path):
    columns = [c.strip().split(" ") for c in FACT.replace("\n", " ").split(",")]
    fact = spark.range(100).select(
        *[(F.col("id") % 10 if name == "admnum" else F.lit(1)).cast(kind).alias(name) for name, kind in columns]
    )
    write_sorted(fact, f"{tmp_path}/fact", "admnum", ["i94yr", "i94mon"])
    assert read_table(spark, f"{tmp_path}/fact", FACT).filter("admnum = 3").count() == 10
