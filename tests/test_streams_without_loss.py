"""Folder tables, empty drains, old time stamps, uneven backlogs and refused events."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.plans import pipeline
from tillroll.sources import files
from tillroll.streaming import file_ingest, realtime

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="tillroll-loss-")


def rows(df):
    return sorted(map(str, df.collect()))


def test_alert_stream_reads_a_folder_of_parts(spark, root):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(f"{root}/events.parquet")
    assert rows(E.queries()["alert_stream"](spark, root)) == rows(E.queries()["alert_failed_runs"](spark, SF))


def test_alert_stream_of_an_empty_log(spark, root):
    spark.read.parquet(f"{SF}/events.parquet").limit(0).write.parquet(f"{root}/events.parquet")
    got = E.queries()["alert_stream"](spark, root)
    assert got.count() == 0 and got.columns == E.queries()["alert_failed_runs"](spark, SF).columns


def test_a_single_file_is_matched_by_its_own_name(spark, root):
    for name, k in (("a[1].parquet", 1), ("a1.parquet", 2)):
        spark.createDataFrame([(k,)], "k int").coalesce(1).write.parquet(f"{root}/{k}")
        part = next(f for f in os.listdir(f"{root}/{k}") if f.startswith("part-"))
        os.makedirs(f"{root}/t", exist_ok=True)
        os.link(f"{root}/{k}/{part}", f"{root}/t/{name}")
    stream = file_ingest.stream_table(spark, f"{root}/t/a[1].parquet", "k int")
    realtime.run_to_sink(stream, f"{root}/out", f"{root}/ck")
    assert [r.k for r in spark.read.parquet(f"{root}/out").collect()] == [1]


def drop(root, name, text, age_days=0):
    path = f"{root}/landing/stores/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("store_id,region,store_format\n" + text)
    if age_days:
        t = os.path.getmtime(path) - age_days * 86400
        os.utime(path, (t, t))


def ingest(spark, root, **kw):
    return file_ingest.ingest_table(spark, f"{root}/landing", "stores", f"{root}/bronze", f"{root}/ck", **kw)


def test_a_late_file_with_an_old_time_stamp_is_read(spark, root):
    drop(root, "a.csv", "S1,North,Mall\n")
    assert ingest(spark, root) == 1
    drop(root, "b.csv", "S2,North,Mall\n", age_days=400)
    assert ingest(spark, root) == 1


def test_an_uneven_backlog_is_drained_in_batches_bounded_in_bytes(spark, root):
    for i in range(6):  # one large file among small ones
        drop(root, f"{i}.csv", f"S{i},North,Mall\n" * (2000 if i == 3 else 20))
    small = os.path.getsize(f"{root}/landing/stores/0.csv")
    assert ingest(spark, root, max_bytes_per_trigger=str(small * 2)) == 2100
    sizes = []
    for batch in sorted(os.listdir(f"{root}/ck/sources/0")):
        if not batch.startswith("."):
            with open(f"{root}/ck/sources/0/{batch}") as f:
                listed = [json.loads(x)["path"] for x in f.read().splitlines()[1:]]
            sizes.append(sum(os.path.getsize(p.removeprefix("file://")) for p in listed))
    assert len(sizes) >= 3 and sum(s > small * 2 for s in sizes) <= 1  # only the file that is larger by itself
    with pytest.raises(ValueError):
        ingest(spark, root, max_bytes_per_trigger="1k", max_files_per_trigger=1)


LINES = ['{"event_id":"E1","customer_id":"C1","event_date":"2024-01-01","event_type":"earn","points":"5"}',
         '{"event_id":"E2","customer_id":"C1","event_type":"error"}', '{"event_id":"E3","event_type":"earn"',
         'not json', '', '   ', '[1, 2]', '5', 'null', '{"event_type":"earn"}', '{"event_id":"","event_type":"earn"}',
         '{"event_id":"E4","event_type":"redeem","points":7,"extra":{"a":1}}', '{}', '{"event_id":"E5"}']


def test_every_event_is_kept_or_refused_with_its_text(spark, root):
    os.makedirs(f"{root}/in")
    with open(f"{root}/in/a.txt", "w") as f:
        f.write("\n".join(LINES))
    pipeline.run_realtime_checked(spark, realtime.text_source(spark, f"{root}/in"), f"{root}/lake")
    bronze, quarantine = (f"{root}/lake/{x}/loyalty_realtime" for x in ("bronze", "quarantine"))
    assert sorted(r.event_id for r in spark.read.parquet(bronze).collect()) == ["E1", "E4"]
    refused = {r.raw: r.reason for r in spark.read.parquet(quarantine).collect()}
    assert refused == {LINES[1]: "event_type", LINES[2]: "malformed", "not json": "malformed", "[1, 2]": "malformed",
                       "5": "malformed", "null": "malformed", LINES[9]: "keyless", LINES[10]: "keyless", "{}": "keyless",
                       LINES[13]: "event_type"}
    counts = {r.outcome: r.events for r in realtime.checked_accounting(spark, bronze, quarantine).collect()}
    assert sum(counts.values()) == sum(bool(x.strip()) for x in LINES) and counts["kept"] == 2
    # a batch that is tried again replaces its own rows
    judged = realtime.judge_events(spark.createDataFrame([(x,) for x in LINES], "value string"))
    realtime.split_sink(bronze, quarantine)(judged, 0)
    assert {r.outcome: r.events for r in realtime.checked_accounting(spark, bronze, quarantine).collect()} == counts
    assert "_batch" in spark.read.parquet(bronze).columns


def test_new_files_are_named_not_matched(spark, root):
    drop(root, "day[1].csv", "S1,North,Mall\n")
    drop(root, "day1.csv", "S2,North,Mall\n")
    fresh = files.read_new_landing(spark, f"{root}/landing", "stores", f"{root}/bronze")
    assert sorted(r.store_id for r in fresh.collect()) == ["S1", "S2"]
    assert fresh.filter(F.col("store_id") == "S1").count() == 1
