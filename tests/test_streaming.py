"""Streams: drain-and-stop ingest is idempotent; stream result = batch result."""
import os
import tempfile

from pyspark.sql import functions as F

from tillroll.operators import oplog, silver
from tillroll.sources import binding
from tillroll.streaming import file_ingest, realtime

SF = "/root/testdata/sf0.001"


def test_ingest_each_file_once(spark):
    root = tempfile.mkdtemp(prefix="tillroll-ingest-")
    landing = f"{root}/landing"
    binding.raw_stores(spark, SF).write.option("header", True).csv(f"{landing}/stores")
    args = (spark, landing, "stores", f"{root}/bronze/stores", f"{root}/_ckpt/stores")
    first = file_ingest.ingest_table(*args)
    again = file_ingest.ingest_table(*args)
    n = binding.raw_stores(spark, SF).count()
    assert first == n and again == 0
    bronze = spark.read.parquet(f"{root}/bronze/stores")
    assert bronze.count() == n
    assert {"_ingested_ts", "_source_file"} <= set(bronze.columns)
    # a new extract is picked up on the next run, the old one is not re-read
    binding.raw_stores(spark, SF).write.mode("append").option("header", True).csv(f"{landing}/stores")
    assert file_ingest.ingest_table(*args) == n
    assert spark.read.parquet(f"{root}/bronze/stores").count() == 2 * n


def test_json_realtime_leg_filters_and_stamps(spark):
    root = tempfile.mkdtemp(prefix="tillroll-rt-")
    src = f"{root}/in"
    os.makedirs(src)
    with open(f"{src}/batch1.json", "w") as f:
        f.write('{"event_id": "E1", "customer_id": "C1", "event_date": "2024-01-01", "event_type": "earn", "points": "10"}\n')
        f.write('{"event_id": "E2", "customer_id": "C1", "event_date": "2024-01-01", "event_type": "bogus", "points": "5"}\n')
    leg = realtime.realtime_leg(realtime.json_source(spark, src))
    realtime.run_to_sink(leg, f"{root}/out", f"{root}/_ckpt")
    got = spark.read.parquet(f"{root}/out").collect()
    assert [r.event_id for r in got] == ["E1"] and got[0]._eventstream_ingested_ts is not None


def test_stream_alerts_equal_batch(spark):
    import __spark_entry__ as E
    key = lambda df: sorted((r.window_start, r.window_end, r.alert, r.severity, r.hits) for r in df.collect())
    for stream, batch in (("alert_stream", oplog.alert_failed_runs(binding.pipeline_runs(spark, SF))),
                          ("alert_gate_stream", oplog.alert_gate_failed(binding.activity_runs(spark, SF))),
                          ("alert_runtime_stream", oplog.alert_runtime(binding.job_runs(spark, SF)))):
        got = key(E.queries()[stream](spark, SF))
        assert got == key(batch) and got


def test_alert_windows_over_micro_batches_with_late_rows(spark):
    """Each file is a micro-batch; the third brings a late row for the first window."""
    root = tempfile.mkdtemp(prefix="tillroll-late-")
    schema = "TimeGenerated timestamp, Status string"
    times = [["2024-01-01 00:01", "2024-01-01 00:02"], ["2024-01-01 00:20"], ["2024-01-01 00:03", "2024-01-01 00:40"]]
    for n, batch in enumerate(times):
        spark.createDataFrame([(t, "Failed") for t in batch], "t string, Status string").select(
            F.to_timestamp("t").alias("TimeGenerated"), "Status").coalesce(1).write.mode("append").json(f"{root}/in")
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/in")
    fired = realtime.window_alerts(log, F.col("Status") == "Failed", F.col("TimeGenerated"), "15 minutes",
                                   "1 hour", "a", 1)
    realtime.drain_updates(fired, f"{root}/out", f"{root}/_ckpt")
    got = realtime.latest_updates(spark, f"{root}/out", fired.schema, ["window_start", "window_end"])
    assert sorted((str(r.window_start)[11:16], r.hits) for r in got.collect()) == [("00:00", 3), ("00:15", 1), ("00:30", 1)]


def test_late_events_reach_the_union(spark):
    """Distinct events over several micro-batches, one far behind: all are kept, repeats once."""
    root = tempfile.mkdtemp(prefix="tillroll-union-")
    days = [("E1", "2024-01-09"), ("E2", "2024-01-10"), ("E3", "2024-01-10"), ("E4", "2023-06-01"), ("E2", "2024-01-10")]
    for e, d in days:
        spark.createDataFrame([(e, "C1", d, "earn", "3")], realtime.LOYALTY_JSON_SCHEMA).coalesce(1) \
            .write.mode("append").json(f"{root}/in")
    src = spark.readStream.schema(realtime.LOYALTY_JSON_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{root}/in")
    realtime.run_to_sink(realtime.realtime_leg(src), f"{root}/out", f"{root}/_ckpt")
    rt = silver.type_table(silver.drop_stamps(spark.read.parquet(f"{root}/out")), "loyalty_events")
    assert sorted(r.event_id for r in silver.union_feeds(rt.limit(0), rt).collect()) == ["E1", "E2", "E3", "E4"]


def test_json_text_is_parsed(spark):
    raw = spark.createDataFrame([('{"event_id": "E1", "points": "7", "other": 1}',), ("not json",), (None,)], "value string")
    got = [tuple(r) for r in realtime.parse_events(raw).select("event_id", "points").collect()]
    assert got == [("E1", "7"), (None, None), (None, None)]


def test_stream_union_equals_batch_union(spark):
    import __spark_entry__ as E
    s = {tuple(r) for r in E.queries()["stream_batch_union"](spark, SF).collect()}
    b = {tuple(r) for r in E.queries()["loyalty_feed_union"](spark, SF).collect()}
    assert s == b


def test_continuous_leg_picks_up_new_files(spark):
    import time
    root = tempfile.mkdtemp(prefix="tillroll-cont-")
    src = f"{root}/in"
    os.makedirs(src)
    line = '{{"event_id": "{}", "customer_id": "C1", "event_date": "2024-01-01", "event_type": "earn", "points": "1"}}\n'
    with open(f"{src}/a.json", "w") as f:
        f.write(line.format("E1"))
    q = realtime.run_to_sink(realtime.realtime_leg(realtime.json_source(spark, src)), f"{root}/out",
                             f"{root}/_ckpt", continuous_every="1 second")
    try:
        q.processAllAvailable()
        with open(f"{src}/b.json", "w") as f:
            f.write(line.format("E2"))
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/out").collect()) == ["E1", "E2"]


def test_backlog_drains_in_bounded_batches(spark):
    root = tempfile.mkdtemp(prefix="tillroll-backlog-")
    landing = f"{root}/landing"
    for _ in range(3):   # three extracts waiting
        binding.raw_stores(spark, SF).coalesce(1).write.mode("append").option("header", True).csv(f"{landing}/stores")
    q = file_ingest.start_ingest(spark, landing, "stores", f"{root}/bronze/stores", f"{root}/_ckpt/stores",
                                 max_files_per_trigger=1)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if int(p.get("numInputRows", 0)) > 0]
    assert len(batches) == 3
    assert spark.read.parquet(f"{root}/bronze/stores").count() == 3 * binding.raw_stores(spark, SF).count()
