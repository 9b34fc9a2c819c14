"""Loads that are published after their checks."""

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from landfall import plans
from landfall.operators import QualityError
from landfall.plans import loads
from landfall.sources import Written, read_table, write_table

SCHEMA = "cicid bigint, airline string, i94yr int, i94mon int, i94port string"


def rows(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def stored(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path, SCHEMA).collect())


def steps(spark, path, load):
    found = plans.load_history(spark, path).filter(F.col("load") == load).orderBy("step", "month").collect()
    return [(r.step, r.month, r.rows, r.different, r.status) for r in found]


APRIL = [(1, "AA", 2016, 4, "001"), (2, None, 2016, 4, "NYC"), (3, "BB", 2016, 4, "NYC")]
MAY = [(1, "AA", 2016, 5, "NYC")]


def test_a_failing_load_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/fact"
    plans.load_months(rows(spark, *APRIL, *MAY), path, "first")
    before = stored(spark, path)
    assert len(before) == 4
    files = sorted(tmp_path.glob("fact/**/*.parquet"))
    with pytest.raises(QualityError, match="unique fact 2016-04: 1, expected 2"):
        plans.load_months(rows(spark, (9, "X", 2016, 4, "SFO"), (9, "Y", 2016, 4, "LAX"), (8, "Z", 2016, 5, "LAX")), path, "bad")
    with pytest.raises(QualityError, match="non_empty"):
        plans.load_months(rows(spark), path, "none")
    assert stored(spark, path) == before and sorted(tmp_path.glob("fact/**/*.parquet")) == files
    assert steps(spark, path, "bad") == [(1, 4, 2, 1, "rejected"), (1, 5, 1, 1, "rejected")]
    assert steps(spark, path, "none") == [(1, None, 0, 0, "rejected")]
    assert not list(tmp_path.glob("fact.loads/staging/*"))


def test_a_load_replaces_its_months_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/fact"
    plans.load_months(rows(spark, *APRIL, *MAY), path, "first")
    entry = plans.load_months(rows(spark, (5, "CC", 2016, 4, "NYC")), path, "April").collect()
    assert [(r.month, r.rows, r.status) for r in entry] == [(4, 1, "published")]
    # The port 001 has gone from April, and May stays.
    assert stored(spark, path) == [MAY[0], (5, "CC", 2016, 4, "NYC")]
    plans.load_months(rows(spark, *APRIL), path, "April")  # has been published already
    assert len(stored(spark, path)) == 2
    plans.load_months(rows(spark, *APRIL), path, "April, corrected")
    assert len(stored(spark, path)) == 4


@pytest.mark.parametrize("again", [True, False])
def test_an_interrupted_load_is_finished_from_its_staged_rows(spark, tmp_path, monkeypatch, again):
    path = f"{tmp_path}/fact"
    plans.load_months(rows(spark, *MAY), path, "first")

    def fail_in_may(df, target, year, month, *args, **options):
        if month == 5:
            raise OSError("executor and driver lost")
        replace(df, target, year, month, *args, **options)

    replace = loads.replace_month
    monkeypatch.setattr(loads, "replace_month", fail_in_may)
    both = rows(spark, *APRIL, (7, "DD", 2016, 5, "LAX"))
    with pytest.raises(OSError, match="lost"):
        plans.load_months(both, path, "both")
    monkeypatch.setattr(loads, "replace_month", replace)
    assert {s[-1] for s in steps(spark, path, "both")} == {"checked"}
    if again:
        plans.load_months(both, path, "both")
    else:
        assert plans.finish_loads(spark, path, SCHEMA) == ["both"]
    assert stored(spark, path) == sorted([*APRIL, (7, "DD", 2016, 5, "LAX")], key=lambda r: r[0])
    assert plans.finish_loads(spark, path, SCHEMA) == []


def test_checks_of_a_write_add_no_scan(spark, tmp_path):
    """Rows and conditions are counted by the job that writes."""
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    plain, counts = f"{tmp_path}/plain", Written(even=F.col("id") % 2 == 0)
    spark.sparkContext.setJobGroup("plain", "")
    write_table(df, plain, ["part"])
    spark.sparkContext.setJobGroup("counted", "")
    write_table(df, f"{tmp_path}/counted", ["part"], counts=counts)
    assert (counts["rows"], counts["even"]) == (1000, 500)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("counted")) == len(tracker.getJobIdsForGroup("plain"))


def test_counts_are_taken_after_the_last_shuffle(spark):
    counted = Written().watch(spark.range(10).hint("rebalance", "id"))
    text = plan_text(counted)
    assert text.index("CollectMetrics") < text.index("Exchange")


def test_only_key_columns_are_read_again(spark, tmp_path, monkeypatch):
    seen = []
    months = loads._months
    monkeypatch.setattr(loads, "_months", lambda staged, *a: seen.append(plan_text(staged.groupBy("i94yr", "i94mon", "cicid").count())) or months(staged, *a))
    plans.load_months(rows(spark, *APRIL), f"{tmp_path}/fact", "first")
    read = next(line for line in seen[0].splitlines() if "ReadSchema" in line)
    assert "cicid" in read and "airline" not in read
