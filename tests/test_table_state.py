"""Damaged or odd table state stops a run; it is never read as "no table yet"."""
import glob
import os
import tempfile

import pytest

from tillroll.operators import scd2, silver
from tillroll.sources import files

COLS = "customer_id string, region string, loyalty_tier string, signup_date string, email_opt_in string"


@pytest.fixture()
def lake(spark):
    lake = tempfile.mkdtemp(prefix="tillroll-state-")
    files.write_version(spark, spark.createDataFrame([(1,)], "k int"), lake, "silver", "t")
    return lake


def pointer_files(lake):
    return glob.glob(f"{lake}/_current/silver/t/part-*.json")


def test_only_a_missing_pointer_means_no_table(spark, lake):
    assert files.table_exists(spark, lake, "silver", "t") and not files.table_exists(spark, lake, "silver", "other")


@pytest.mark.parametrize("text", ['{"versi', "", '{"other": "1"}\n'])
def test_damaged_pointer_raises(spark, lake, text):
    for f in pointer_files(lake):
        with open(f, "w") as out:
            out.write(text)
        os.unlink(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    for read in (files.table_exists, files.current_version, files.read_table, files.read_all_versions):
        with pytest.raises(files.TableStateError):
            read(spark, lake, "silver", "t")


def test_unpublished_versions_do_not_show(spark, lake):
    files.stage_version(spark.createDataFrame([(2,)], "k int"), lake, "silver", "t")
    assert [r.k for r in files.read_table(spark, lake, "silver", "t").collect()] == [1]
    assert [r.k for r in files.read_all_versions(spark, lake, "silver", "t").collect()] == [1]


def test_keyless_rows_are_rejected_and_counted(spark):
    bronze = spark.createDataFrame([("C1", "N", "Gold", "2024-01-01", "true"), (None, "N", "Gold", "2024-01-01", "true"),
                                    ("", "N", "Gold", "2024-01-01", "true")], COLS)
    staged = silver.conform(bronze, "customers")
    dim = scd2.scd2_initial(staged, "2024-01-01")
    again = scd2.scd2_merge(dim, staged, ["customer_id"], ["loyalty_tier"], "2024-01-02")
    assert dim.count() == again.count() == 1
    assert silver.rejected_rows(bronze, "customers") == {"malformed": 0, "keyless": 2}


def test_catalog_tables(spark):
    files.create_layers(spark, ("bronze",))
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    files.save_catalog_table(df, "bronze", "state_probe")
    assert files.catalog_table_exists(spark, "bronze", "state_probe")
    assert not files.catalog_table_exists(spark, "bronze", "state_probe_missing")
    assert files.read_catalog_table(spark, "bronze", "state_probe", "spark_catalog").collect() == df.collect()
    spark.sql("DROP TABLE bronze.state_probe")
