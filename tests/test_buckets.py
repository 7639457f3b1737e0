"""Merging into a bucketed store: who wins, nulls in keys, broken runs, and plans that leave the old side where it is."""

import shutil

import pytest
from pyspark.sql import functions as F

from paperloom.operators import review
from paperloom.sources import buckets

KEY = ["basename", "start", "end"]
SCHEMA = "basename string, start int, end int, pos int, verdict string"


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def as_set(df):
    return {tuple(r) for r in df.select("basename", "start", "end", "pos", "verdict").collect()}


@pytest.fixture
def runs(spark):
    first = rows(spark, ("a", 1, 2, 0, "pass"), ("a", 1, 2, 1, "fail"), ("b", 1, 2, 2, "fail"), (None, 1, None, 3, "fail"), ('a"', 1, 2, 4, "pass"))
    second = rows(spark, ("b", 1, 2, 0, "pass"), ("c", 1, 2, 1, "pass"), (None, 1, None, 2, "pass"), (None, None, 1, 3, "pass"))
    return first, second


@pytest.mark.parametrize("latest", [False, True])
def test_same_as_a_merge_of_tables(spark, runs, tmp_path, latest):
    first, second = runs
    path = str(tmp_path / "store")
    for part in (first, second):
        buckets.merge(part, path, KEY, ["pos"], latest, 4)
    want = as_set(review.merged_results(first, second, latest))
    assert as_set(buckets.read(spark, path, latest)) == want
    buckets.merge(rows(spark, ("c", 1, 2, 9, "fail")), path, KEY, ["pos"], latest)
    want = {w for w in want if not latest or w[0] != "c"} | ({("c", 1, 2, 9, "fail")} if latest else set())
    assert as_set(buckets.read(spark, path, latest)) == want
    buckets.compact(spark, path, latest)
    assert len(buckets.generations(spark, path)) == 1
    assert as_set(buckets.read(spark, path, latest)) == want


def test_old_rows_stay_where_they_are(spark, tmp_path):
    path = str(tmp_path / "store")
    made = spark.range(2000).select(F.col("id").cast("string").alias("basename"), F.lit(1).alias("start"), F.lit(2).alias("end"), F.col("id").cast("int").alias("pos"), F.lit("pass").alias("verdict"))
    folder = buckets.merge(made.where("pos < 1000"), path, KEY, ["pos"], buckets=4)
    files = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "store").glob("g*/*.parquet")}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        new = buckets.unknown(made.where("pos >= 500"), path, KEY, ["pos"])
        plan = new._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert "ReadSchema: struct<__key:string>" in plan
        buckets.merge(made.where("pos >= 500"), path, KEY, ["pos"], latest=True)
        plan = buckets.read(spark, path, latest=True)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert buckets.read(spark, path, latest=True).count() == 2000
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "store").glob(f"{folder.rsplit('/', 1)[1]}/*.parquet")} == files


def test_broken_merge_is_not_seen_and_is_replaced(spark, runs, tmp_path):
    path = str(tmp_path / "store")
    buckets.merge(runs[0], path, KEY, ["pos"], buckets=2)
    broken = buckets.merge(runs[1], path, KEY, ["pos"])
    (tmp_path / "store" / broken.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    assert as_set(buckets.read(spark, path)) == as_set(review.merged_results(runs[0].limit(0), runs[0]))
    assert buckets.merge(runs[1], path, KEY, ["pos"]) == broken
    assert as_set(buckets.read(spark, path)) == as_set(review.merged_results(runs[0], runs[1]))


def test_a_later_session_finds_the_store(spark, runs, tmp_path):
    path = str(tmp_path / "store")
    buckets.merge(runs[0], path, KEY, ["pos"], buckets=2)
    shutil.copytree(path, tmp_path / "moved")
    assert as_set(buckets.read(spark, str(tmp_path / "moved"))) == as_set(review.merged_results(runs[0].limit(0), runs[0]))
    with pytest.raises(ValueError, match="no results"):
        buckets.read(spark, str(tmp_path / "none"))


def test_empty(spark, tmp_path):
    path = str(tmp_path / "store")
    buckets.merge(rows(spark), path, KEY, ["pos"], buckets=2)
    assert buckets.read(spark, path).count() == 0
    buckets.merge(rows(spark, ("a", 1, 2, 0, "pass")), path, KEY, ["pos"])
    assert as_set(buckets.read(spark, path)) == {("a", 1, 2, 0, "pass")}
