import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from landfall.session import cluster_settings, scratch_path, scratch_scope, shared_folder
from landfall.sources import (
    land,
    locate,
    read_arrivals,
    read_csv,
    read_table,
    replace_month,
    write_csv,
    write_months,
    write_table,
)

FACT = "cicid bigint, i94yr int, i94mon int, i94port string"


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame(
        [(1, 2016, 4, "NYC"), (2, 2016, 4, "888"), (3, 2016, 5, "NYC"), (4, 2016, 5, "001")], FACT
    )


def stored(spark, path):
    return {tuple(r) for r in read_table(spark, path, FACT).collect()}


def test_all_digit_ports_stay_text(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    write_months(fact, path)
    assert stored(spark, path) == {tuple(r) for r in fact.collect()}


def test_months_are_replaced_and_others_stay(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    write_months(fact, path)
    write_months(fact.filter("i94mon = 5").withColumn("cicid", F.col("cicid") + 10), path)
    assert stored(spark, path) == {
        (1, 2016, 4, "NYC"), (2, 2016, 4, "888"), (13, 2016, 5, "NYC"), (14, 2016, 5, "001"),
    }


def test_replaced_month_loses_ports_that_disappeared(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    write_months(fact, path)
    for _ in range(2):
        # Rows of other months in the input are left alone.
        replace_month(fact.filter("i94port = 'NYC'").withColumn("cicid", F.col("cicid") + 10), path, 2016, 4)
        assert stored(spark, path) == {(11, 2016, 4, "NYC"), (3, 2016, 5, "NYC"), (4, 2016, 5, "001")}


def test_month_filter_prunes_partitions(spark, fact, tmp_path):
    from conftest import plan_text

    path = str(tmp_path / "fact")
    write_months(fact, path)
    text = plan_text(read_table(spark, path, FACT).filter("i94mon = 4 and i94port = '888'"))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "i94mon" in filters and "i94port" in filters


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One port holds nearly all rows; its directory still gets several files."""
    path = str(tmp_path / "hot")
    rows = spark.range(0, 400000, 1, 8).select(
        F.col("id").alias("cicid"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 1000 == 0, "LAX").otherwise("NYC").alias("i94port"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        write_table(rows, path, keys=["i94port"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p: len(list((tmp_path / "hot" / f"i94port={p}").glob("*.parquet"))) for p in ("NYC", "LAX")}
    assert files["NYC"] > 1
    assert spark.read.parquet(path).count() == 400000


def test_write_fails_if_present(fact, tmp_path):
    path = str(tmp_path / "t")
    write_table(fact, path)
    with pytest.raises(AnalysisException):
        write_table(fact, path)
    write_table(fact, path, mode="overwrite")


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    df = spark.createDataFrame(
        [("a|b", 'say "x"', " padded "), ("back\\slash", "é", None), ("comma, too", "", "z")], "a string, b string, c string"
    )
    for sep, encoding in (("|", "UTF-8"), (",", "ISO-8859-1"), (";", "UTF-8")):
        path = str(tmp_path / f"{ord(sep)}")
        write_csv(df, path, sep=sep, encoding=encoding)
        got = read_csv(spark, f"{path}/*.csv", df.schema, sep=sep, encoding=encoding).collect()
        assert {tuple(r) for r in got} == {tuple(r) for r in df.collect()}
    write_csv(df, str(tmp_path / "same"), empty_as_null=True)
    got = read_csv(spark, str(tmp_path / "same"), df.schema).collect()
    assert {tuple(r) for r in got} == {tuple(x or None for x in r) for r in df.collect()}


def test_csv_is_lossless_or_loud(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, "\r"), (3, "Łódź"), (4, ""), (5, None)], "i int, s string")
    write_csv(df, str(tmp_path / "lines"), multi_line=True)
    got = read_csv(spark, str(tmp_path / "lines"), df.schema, multi_line=True).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="line break"):
        write_csv(df.filter("i < 3"), str(tmp_path / "broken"))
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        write_csv(df.filter("i = 3"), str(tmp_path / "latin"), encoding="ISO-8859-1")
    write_csv(df, str(tmp_path / "lossy"), encoding="ISO-8859-1", lossy=True)
    got = {r.i: r.s for r in read_csv(spark, str(tmp_path / "lossy"), df.schema, encoding="ISO-8859-1").collect()}
    assert got == {1: "a b", 2: " ", 3: "?ód?", 4: "", 5: None}


def test_csv_header_must_match_the_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    assert read_csv(spark, str(tmp_path / "x.csv")).dtypes == [("b", "string"), ("a", "string")]
    assert read_csv(spark, str(tmp_path / "x.csv"), infer=True).dtypes == [("b", "int"), ("a", "int")]
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "x.csv"), "a int, b int").collect()


def test_arrivals_contract(spark, tmp_path):
    from landfall.schemas import RAW_ARRIVALS

    raw = spark.createDataFrame([(1.0, "NYC")], "cicid double, i94port string")
    empty = spark.createDataFrame([], RAW_ARRIVALS)
    full = empty.unionByName(raw, allowMissingColumns=True)
    assert len(full.columns) == 27
    landed = land(full, str(tmp_path / "p"))
    assert landed.count() == 1 and landed.schema == full.schema
    assert read_arrivals(spark, str(tmp_path / "p")).select("cicid", "i94port").collect()[0] == (1.0, "NYC")
    write_csv(full, str(tmp_path / "c"))
    assert read_arrivals(spark, str(tmp_path / "c"), fmt="csv").select("cicid", "admnum").collect()[0] == (1.0, None)


def test_locations(spark):
    assert locate("s3a://bucket/base/", "/x.csv") == "s3a://bucket/base/x.csv"
    assert scratch_path(spark, "n").startswith(shared_folder(spark))
    assert scratch_path(spark, "n") != scratch_path(spark, "n")


def session_stub(master, folder=None, checkpoints=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints, applicationId=f"{master} {checkpoints}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_no_machine_local_folder_on_a_cluster():
    for checkpoints in (None, "file:/tmp/x", "/tmp/x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session_stub("yarn", checkpoints=checkpoints))
    assert shared_folder(session_stub("yarn", "hdfs://shared/")) == "hdfs://shared"
    assert shared_folder(session_stub("yarn", checkpoints="hdfs://shared/id")) == "hdfs://shared/id"
    own = shared_folder(session_stub("local[8]"))
    assert "landfall-" in own and shared_folder(session_stub("local[8]")) == own


def test_a_plain_session_has_a_folder(tmp_path):
    """A real session without any setting, apart from this one."""
    code = """
from landfall.session import local_session, release_scratch, scratch_path
from landfall.bindings import QUERIES
import os
spark = local_session("2")
assert spark.conf.get("spark.checkpoint.dir", None) is None
rows = QUERIES["build_city_demo"](spark, "/root/testdata/sf0.001").count()
assert rows > 0 and release_scratch(spark) > 0
print("rows", rows)
"""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    root = Path(__file__).resolve().parent.parent
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "rows" in out.stdout, out.stderr[-2000:]


def test_scratch_is_removed(spark):
    with scratch_scope(spark):
        kept = scratch_path(spark, "kept")
        spark.range(3).write.parquet(kept)
        local = Path(kept.removeprefix("file:").replace("///", "/"))
        assert local.is_dir()
    assert not local.exists()


def test_partitions_follow_the_size_of_the_shuffle():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert cluster_settings(1024)[key] == "200"
    assert cluster_settings(10**12)[key] == "3726"
    assert cluster_settings(100 * 10**12)[key] == "50000"
    assert cluster_settings(100 * 10**12, max_partitions=10**6)[key] == "372530"


def test_clustered_rows_are_written_without_a_shuffle(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    write_months(fact.coalesce(1).sortWithinPartitions("i94mon", "i94port"), path, clustered=True)
    assert stored(spark, path) == {tuple(r) for r in fact.collect()}
    replace_month(fact, path, 2016, 4, clustered=True)
    assert stored(spark, path) == {tuple(r) for r in fact.collect()}
