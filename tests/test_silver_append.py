"""Silver by batch: no row skipped or taken twice, no shuffle of the history, one pass over Bronze."""
import tempfile

import pytest
from pyspark.sql import functions as F

from tillroll.operators import dq, silver
from tillroll.sources import files
from tillroll.streaming import silver_append

RAW = "transaction_id string, customer_id string, product_id string, store_id string, " \
      "transaction_date string, quantity string, amount string, payment_method string"


def line(i, quantity="1", customer="C1", amount="5.00"):
    return (f"T{i}", customer, "P1", "S1", "2024-01-01", quantity, amount, "Card")


def deliver(spark, lake, rows, stamp):
    (spark.createDataFrame(rows, RAW).withColumn("_ingested_ts", F.lit(stamp).cast("timestamp"))
     .withColumn("_source_file", F.lit(stamp)).coalesce(1).write.mode("append").parquet(f"{lake}/bronze/transactions"))


def ids(spark, lake):
    return sorted(r.transaction_id for r in files.read_epochs(spark, lake, "silver", "transactions").collect())


@pytest.fixture()
def lake(spark):
    lake = tempfile.mkdtemp(prefix="tillroll-append-")
    deliver(spark, lake, [line(1), line(2), line(2, amount="4.00"), line(3, quantity="0"), line(4, customer="")],
            "2024-02-01")
    return lake


def append(spark, lake, pass_rate=0.1, **kw):
    return silver_append.append_transactions(spark, lake, pass_rate, **kw)


def test_a_clock_that_steps_back_loses_no_row(spark, lake):
    acc, epoch = append(spark, lake)
    assert ids(spark, lake) == ["T1", "T2"] and int(epoch) == 0
    deliver(spark, lake, [line(2, amount="9.00"), line(5)], "2023-01-01")  # stamped a year before the first
    acc, epoch = append(spark, lake)
    assert ids(spark, lake) == ["T1", "T2", "T5"] and int(epoch) == 1
    two = files.read_epochs(spark, lake, "silver", "transactions").filter("transaction_id = 'T2'").first()
    assert str(two.amount) == "4.00"  # published rows never lose
    assert acc == {"total": 7, "malformed": 0, "bad_quantity": 1, "missing_customer": 1, "duplicates": 2, "clean": 3,
                   "rejected": 4, "pass_rate": 3 / 7}
    assert append(spark, lake) == (acc, epoch)  # nothing new


def test_a_batch_that_broke_is_taken_again_once(spark, lake, monkeypatch):
    append(spark, lake)
    deliver(spark, lake, [line(2), line(6)], "2024-02-02")
    publish = files.publish_version

    def broken(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(files, "publish_version", broken)
    with pytest.raises(Exception, match="lost driver"):
        append(spark, lake)
    assert ids(spark, lake) == ["T1", "T2"]  # written, not published
    monkeypatch.setattr(files, "publish_version", publish)
    acc, _ = append(spark, lake)
    assert ids(spark, lake) == ["T1", "T2", "T6"] and acc["total"] == 7 and acc["clean"] == 3


def test_a_published_epoch_is_not_taken_again(spark, lake):
    acc, epoch = append(spark, lake)
    batch = spark.read.parquet(f"{lake}/bronze/transactions")
    stream = silver_append._query_id(spark, f"{lake}/_checkpoints/silver_transactions")
    assert silver_append.append_epoch(spark, lake, batch, 0, stream, 0.1) == {}
    with pytest.raises(files.TableStateError, match="does not belong"):
        silver_append.append_epoch(spark, lake, batch, 0, "another stream", 0.1)
    assert silver_append.total_accounting(spark, lake) == acc


def test_a_batch_under_the_pass_rate_stays_first_in_line(spark, lake):
    with pytest.raises(dq.DQGateError, match="pass rate 40.00% below 95%"):
        append(spark, lake, 0.95)
    assert not files.table_exists(spark, lake, "silver", "transactions")
    deliver(spark, lake, [line(7)], "2024-02-02")
    append(spark, lake, 0.3)
    assert ids(spark, lake) == ["T1", "T2", "T7"]


def test_counts_of_a_task_that_ran_twice_are_not_used(spark, lake, monkeypatch):
    class Twice(silver_append.Observation):
        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(silver_append, "Observation", Twice)
    acc, _ = append(spark, lake)
    assert (acc["total"], acc["bad_quantity"], acc["missing_customer"], acc["duplicates"]) == (5, 1, 1, 1)


def test_bronze_is_scanned_once_a_run(spark, lake, monkeypatch):
    """The rejects are counted on the pass that cleanses: no plan but that one reads a Bronze column."""
    plans = []
    write = silver.cleanse_transactions

    def noted(bronze, stamp=True):
        out = write(bronze, stamp)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(silver, "cleanse_transactions", noted)
    recounts = []
    monkeypatch.setattr(silver, "reject_counts", lambda *a: recounts.append(a))
    acc, _ = append(spark, lake)
    assert len(plans) == 1 and "CollectMetrics" in plans[0] and plans[0].count("Scan") == 1 and not recounts
    bronze = spark.read.parquet(f"{lake}/bronze/transactions")
    once = silver.reject_accounting(bronze).first().asDict()
    assert {k: acc[k] for k in once} == once


def test_history_is_neither_shuffled_nor_sorted(spark, lake):
    for i in range(3):
        append(spark, lake, buckets=4)
        deliver(spark, lake, [line(100 + i), line(200 + i)], "2024-02-02")
    history = files.read_epochs(spark, lake, "silver", "transactions")
    batch = silver.cleanse_transactions(spark.read.parquet(f"{lake}/bronze/transactions"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = silver_append.known_ids(history, batch, 4)
        assert sorted(r[0] for r in known.collect()) == ["T1", "T100", "T101", "T2", "T200", "T201"]
        plan = known._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.split("== Initial Plan ==")[0]
    side = final[final.index("ShuffledHashJoin"):].split("\n")
    scan = next(i for i, x in enumerate(side) if "silver_transactions" in x and "Scan" in x)
    above = [x for x in side[1:scan] if "BroadcastQueryStage" not in x]
    assert "Bucketed: true" in final
    assert not [x for x in above if "Exchange" in x or "Sort" in x or "ShuffleQueryStage" in x], "\n".join(above)


def test_a_new_session_finds_the_table(spark, lake):
    append(spark, lake, buckets=4)
    name = files.bucketed_table(spark, lake, "silver", "transactions")
    spark.sql(f"DROP TABLE `{name}`")  # what an in-memory catalog forgets
    assert ids(spark, lake) == ["T1", "T2"]
    assert files.bucket_count(spark, lake, "silver", "transactions") == 4


def test_batches_are_bounded_in_bytes(spark, lake):
    for i in range(4):
        deliver(spark, lake, [line(10 + i)], "2024-02-02")
    _, epoch = append(spark, lake, max_bytes_per_batch="1")
    assert int(epoch) == 4 and len(ids(spark, lake)) == 6


def test_bucket_counts():
    assert [files.buckets_for(n) for n in (0, 1, 1 << 24, (1 << 24) + 1, 1 << 27, 1 << 60)] == [1, 1, 1, 2, 8, 1 << 16]
