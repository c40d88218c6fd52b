"""Uniqueness from stored sketches, and the lake's own files as the inventory of the storage tiers."""
import datetime
import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators import dq, oplog, uniqueness
from tillroll.sources import files


def version(spark, first, rows, repeat_every=0, prefix="k"):
    """Rows with a key; with ``repeat_every`` n every n-th row repeats the key before it."""
    i = F.col("id") - (F.when(F.col("id") % repeat_every == 1, 1).otherwise(0) if repeat_every else F.lit(0))
    return spark.range(first, first + rows).select(F.concat(F.lit(prefix), i.cast("string")).alias("k"))


class Unread:
    """A history that must not be counted."""

    def __getattr__(self, name):
        raise AssertionError(f"the history was asked for {name}")


@pytest.mark.parametrize("repeat_every, status", [(0, "PASS"), (4, "FAIL"), (100, "FAIL")])
def test_clear_cases_leave_the_history_alone(spark, tmp_lake, repeat_every, status):
    versions = [version(spark, n * 100_000, 100_000, repeat_every) for n in range(3)]
    for n, df in enumerate(versions):
        uniqueness.write_sketches(df, "k", f"{tmp_lake}/sketches", n)
    uniqueness.write_sketches(versions[1], "k", f"{tmp_lake}/sketches", 1)  # a retried run replaces itself
    got = uniqueness.check_uniqueness(uniqueness.read_sketches(spark, f"{tmp_lake}/sketches"), Unread(), "t", "k").first()
    history = versions[0].union(versions[1]).union(versions[2])
    exact = dq.check_uniqueness(history, "t", "k").first()
    assert got["status"] == exact["status"] == status
    assert got["metric_value"] == pytest.approx(exact["metric_value"], rel=0.001)
    assert "of 300,000 unique" in got["detail"]


def test_keys_that_repeat_across_versions_are_seen(spark, tmp_lake):
    for n in range(2):
        uniqueness.write_sketches(version(spark, 0, 50_000), "k", tmp_lake + "/s", n)
    got = uniqueness.check_uniqueness(uniqueness.read_sketches(spark, tmp_lake + "/s"), Unread(), "t", "k", 0.9).first()
    assert got["status"] == "FAIL" and got["metric_value"] == pytest.approx(0.5, rel=0.001)


@pytest.mark.parametrize("threshold", [0.98999, 0.99, 0.99001])
def test_a_threshold_inside_the_interval_is_counted_exactly(spark, threshold):
    df = version(spark, 0, 200_000, 100)
    b = uniqueness.bounds(uniqueness.key_sketches(df, "k")).first()
    assert b["low"] < threshold * 200_000 <= b["high"]
    got = uniqueness.check_uniqueness(uniqueness.key_sketches(df, "k"), df, "t", "k", threshold).first()
    assert got.asDict() | {"run_ts": 0} == dq.check_uniqueness(df, "t", "k", threshold).first().asDict() | {"run_ts": 0}
    assert got["status"] == ("PASS" if threshold <= 0.99 else "FAIL")


def test_null_keys_and_empty_tables(spark):
    nulls = version(spark, 0, 1000).union(spark.range(1000).select(F.lit(None).cast("string").alias("k")))
    empty = nulls.limit(0)
    for df in (nulls, empty):
        got = uniqueness.check_uniqueness(uniqueness.key_sketches(df, "k"), Unread(), "t", "k").first()
        exact = dq.check_uniqueness(df, "t", "k").first()
        assert (got["status"], got["metric_value"]) == (exact["status"], exact["metric_value"])


def test_sketches_are_combined_before_the_shuffle(spark):
    plan = uniqueness.key_sketches(version(spark, 0, 10), "k")._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan


def set_age(path, days, as_of=datetime.datetime(2024, 6, 1, 12, tzinfo=datetime.timezone.utc)):
    at = (as_of - datetime.timedelta(days=days)).timestamp()
    os.utime(path, (at, at))


def data_files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")]


def test_tiers_of_the_lakes_own_files(spark, tmp_lake):
    row = spark.createDataFrame([(1,)], "k int").coalesce(1)
    ages = {"hot day": 3, "cool+day": 40, "archive": 200, "old": 900}
    for name, days in ages.items():
        row.write.parquet(f"{tmp_lake}/bronze/sales/{name}")
        for f in data_files(f"{tmp_lake}/bronze/sales/{name}"):
            set_age(f, days)
    versions = {"dim": [], "fact": []}
    for table in versions:
        for days in (200, 100, 5):
            versions[table].append(files.write_version(spark, row, tmp_lake, "silver", table))
            for f in data_files(f"{tmp_lake}/silver/{table}/v={versions[table][-1]}"):
                set_age(f, days)
    staged, _ = files.stage_version(row, tmp_lake, "silver", "dim")
    inventory = files.lake_inventory(spark, tmp_lake, added_up=("silver.fact",))
    tiers = {tuple(r["path"].split("/")[:3]): r for r in oplog.storage_tiers(inventory, "2024-06-01").collect()
             if r["path"].endswith(".parquet")}
    assert {name: tiers["bronze", "sales", name]["tier"] for name in ages} == {
        "hot day": "hot", "cool+day": "cool", "archive": "archive", "old": "delete"}
    of = lambda t, v: tiers["silver", t, f"v={v}"]["tier"]
    assert [of("dim", v) for v in [*versions["dim"], staged]] == ["delete", "delete", "hot", "hot"]
    assert [of("fact", v) for v in versions["fact"]] == ["hot"] * 3
    assert len(tiers) == 4 + 4 + 3
    for r in inventory.filter("path like 'bronze/%'").collect():
        assert round(r["size_gb"] * (1 << 30)) == os.path.getsize(f"{tmp_lake}/{r['path']}")


def test_the_inventory_reads_no_content_and_needs_no_pointer(spark, tmp_lake):
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{tmp_lake}/bronze/t")
    inventory = files.lake_inventory(spark, tmp_lake)
    assert "content" not in inventory._jdf.queryExecution().executedPlan().toString()
    assert inventory.filter("is_version").count() == 0 < inventory.count()
