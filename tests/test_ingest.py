"""Ingest loses nothing: headers, short lines, nested files, many batches, empty drops."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tillroll.operators import dq, silver
from tillroll.plans import pipeline
from tillroll.schemas import CORRUPT, RAW_COLUMNS
from tillroll.sources import binding, files
from tillroll.streaming import file_ingest

SF = "/root/testdata/sf0.001"


def drop(root, name, text, table="stores"):
    path = f"{root}/landing/{table}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def ingest(spark, root, **options):
    return file_ingest.ingest_table(spark, f"{root}/landing", "stores", f"{root}/bronze/stores",
                                    f"{root}/_ckpt", **options)


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="tillroll-in-")


def test_reordered_header_stops_batch_and_stream(spark, root):
    drop(root, "a.csv", "region,store_id,store_format\nNorth,S1,Mall\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_landing_csv(spark, f"{root}/landing/stores", "stores").collect()
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        ingest(spark, root)
    assert not files.path_exists(spark, f"{root}/bronze/stores") or file_ingest._rows(spark, f"{root}/bronze/stores") == 0


def test_short_and_long_lines_are_rejects(spark, root):
    drop(root, "a.csv", "store_id,region,store_format\nS1,North,Mall\nS2,South\nS3,East,Mall,extra\nS4,,Express\n")
    assert ingest(spark, root) == 4
    bronze = spark.read.parquet(f"{root}/bronze/stores")
    assert sorted(r[0] for r in bronze.filter(silver.malformed()).select(CORRUPT).collect()) == ["S2,South", "S3,East,Mall,extra"]
    assert sorted(r.store_id for r in silver.conform(bronze, "stores").collect()) == ["S1", "S4"]
    assert silver.rejected_rows(bronze, "stores") == {"malformed": 2, "keyless": 0}


def test_nested_files_are_counted_and_ingested(spark, root):
    drop(root, "2024/01/a.csv", "store_id,region,store_format\nS1,North,Mall\n")
    drop(root, "b.csv", "store_id,region,store_format\nS2,South,Mall\n")
    fresh = files.read_new_landing(spark, f"{root}/landing", "stores", f"{root}/bronze/stores")
    assert fresh.count() == 2 and ingest(spark, root) == 2
    assert files.read_new_landing(spark, f"{root}/landing", "stores", f"{root}/bronze/stores").count() == 0
    drop(root, "2024/02/late day.csv", "store_id,region,store_format\nS3,East,Mall\n")
    fresh = files.read_new_landing(spark, f"{root}/landing", "stores", f"{root}/bronze/stores")
    assert [r.store_id for r in fresh.collect()] == ["S3"] and ingest(spark, root) == 1


def test_row_count_of_more_batches_than_progress_keeps(spark, root):
    for i in range(110):
        drop(root, f"{i:03d}.csv", f"store_id,region,store_format\nS{i},North,Mall\n")
    assert ingest(spark, root, max_files_per_trigger=1) == 110


def test_gate_counts_the_new_delivery_only(spark, root):
    landing, lake = f"{root}/landing", f"{root}/lake"
    pipeline.write_landing(spark, SF, landing)
    first = pipeline.run_bronze(spark, landing, lake)
    assert first["landing_rows"] == first["bronze_rows"]
    for table, columns in RAW_COLUMNS.items():
        drop(root, "second.csv", ",".join(columns) + "\n", table)
    with pytest.raises(dq.DQGateError, match="landing zone below minimum"):
        pipeline.run_bronze(spark, landing, lake)


def test_silver_appends_what_is_new(spark, root):
    """Two deliveries, the second repeating ids of the first, give the Silver of one cleanse of both."""
    landing, lake = f"{root}/landing", f"{root}/lake"
    whole = binding.raw_transactions(spark, SF)
    late = F.pmod(F.hash("product_id"), F.lit(3)) == 0
    rest = {t: None for t in ("customers", "products", "stores", "loyalty_events")}
    pipeline.write_landing(spark, SF, landing, list(rest))
    pipeline.write_landing(spark, SF, landing, ["transactions"], {"transactions": whole.filter(~late)})
    pipeline.run_bronze(spark, landing, lake)
    pipeline.run_silver(spark, lake, "2024-01-01", pass_rate=0.5)
    pipeline.write_landing(spark, SF, landing, list(rest))
    pipeline.write_landing(spark, SF, landing, ["transactions"], {"transactions": whole.filter(late)})
    pipeline.run_bronze(spark, landing, lake)
    acc = pipeline.run_silver(spark, lake, "2024-01-02", pass_rate=0.5, keep_versions=1)["accounting"]
    bronze = spark.read.parquet(f"{lake}/bronze/transactions")
    kept = silver.drop_stamps(pipeline._silver_read(spark, lake, "transactions"))
    want = silver.drop_stamps(silver.cleanse_transactions(bronze))
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.select(*kept.columns).collect()))
    once = silver.reject_accounting(bronze).first()
    for c in ("total", "clean", "rejected", "bad_quantity", "missing_customer", "duplicates"):
        assert acc[c] == once[c], c
    assert acc["clean"] + acc["malformed"] + acc["bad_quantity"] + acc["missing_customer"] + acc["duplicates"] == acc["total"]
    assert len(os.listdir(f"{lake}/silver/products")) == 1 and files.read_table(spark, lake, "silver", "products").count() > 0
