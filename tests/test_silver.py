"""Silver rules: the reference's pipeline cases plus dirty-copy and cast edges."""
from pyspark.sql import functions as F

from tillroll.operators import silver

SF_SMALL = "/root/testdata/sf0.001"

TXN = ("transaction_id string, customer_id string, product_id string, store_id string, "
       "transaction_date string, quantity string, amount string, payment_method string")


def test_negative_quantity_rejected(spark):
    df = spark.createDataFrame([("T1", "-1", "C1"), ("T2", "2", "C2")],
                               "transaction_id string, quantity string, customer_id string")
    typed = df.select("transaction_id", silver.coerce_number("quantity").alias("quantity"))
    clean = silver.positive_quantity(typed).collect()
    assert [r.transaction_id for r in clean] == ["T2"]


def test_missing_customer_id_rejected(spark):
    df = spark.createDataFrame([("T1", ""), ("T2", "C2"), ("T3", None)],
                               "transaction_id string, customer_id string")
    assert [r.transaction_id for r in silver.present_key(df).collect()] == ["T2"]


def test_coercing_cast(spark):
    df = spark.createDataFrame([("2.0",), ("2.7",), ("abc",), (None,), ("1e20",)], "q string")
    got = [r.q for r in df.select(silver.coerce_number("q").alias("q")).collect()]
    assert got == [2, 2, None, None, None]


def test_dirty_first_copy_does_not_win(spark):
    rows = [("T1", "C1", "P1", "S1", "2024-01-01", "-1", "10.00", "Card"),
            ("T1", "C1", "P1", "S1", "2024-01-02", "3", "30.00", "Card"),
            ("T2", "", "P1", "S1", "2024-01-01", "1", "5.00", "Cash"),
            ("T2", "C2", "P1", "S1", "2024-01-03", "1", "5.00", "Cash")]
    clean = silver.cleanse_transactions(spark.createDataFrame(rows, TXN), stamp=False)
    got = {r.transaction_id: (r.quantity, r.customer_id) for r in clean.collect()}
    assert got == {"T1": (3, "C1"), "T2": (1, "C2")}


def test_reject_accounting_adds_up(spark):
    from tillroll.sources import binding
    raw = binding.raw_transactions(spark, SF_SMALL)
    acc = silver.reject_accounting(raw).first()
    clean = silver.cleanse_transactions(raw, stamp=False).count()
    assert acc.clean == clean
    assert acc.total == raw.count()
    assert acc.rejected == acc.bad_quantity + acc.missing_customer + acc.duplicates
    assert acc.clean + acc.rejected == acc.total


def test_latest_per_key_keeps_newest(spark):
    df = spark.createDataFrame([("P1", "A", "2024-01-01 00:00:00"), ("P1", "B", "2024-01-02 00:00:00"),
                                ("P2", "C", "2024-01-01 00:00:00")],
                               "product_id string, category string, _ingested_ts string")
    df = df.withColumn("_ingested_ts", F.col("_ingested_ts").cast("timestamp"))
    got = {r.product_id: r.category for r in silver.latest_per_key(df, ["product_id"]).collect()}
    assert got == {"P1": "B", "P2": "C"}


def test_union_feeds_once_per_event(spark):
    b = spark.createDataFrame([("E1", "C1", "earn", 10)], "event_id string, customer_id string, event_type string, points long")
    r = spark.createDataFrame([("E1", "C1", "earn", 10), ("E2", "C2", "redeem", -5)],
                              "event_id string, customer_id string, event_type string, points long")
    r = r.withColumn("_eventstream_ingested_ts", F.current_timestamp())
    u = silver.union_feeds(b, r)
    assert sorted(x.event_id for x in u.collect()) == ["E1", "E2"]


def test_integrity_semi_join_does_not_fan_out(spark):
    ev = spark.createDataFrame([("E1", "C1"), ("E2", "C9")], "event_id string, customer_id string")
    keys = spark.createDataFrame([("C1",), ("C1",)], "customer_id string")
    assert [r.event_id for r in silver.integrity_filter(ev, keys).collect()] == ["E1"]


def test_reject_counts_match_one_pass_accounting(spark):
    from tillroll.sources import binding
    raw = binding.raw_transactions(spark, SF_SMALL)
    clean = silver.cleanse_transactions(raw, stamp=False).count()
    a = silver.reject_accounting(raw).first().asDict()
    b = silver.reject_counts(raw, clean)
    assert b.pop("malformed") == 0 and a == b
