"""The realtime loyalty leg and stream-side alerting.

T2: broker (or file) JSON events -> accepted-type filter -> arrival stamp ->
append to Bronze. Stateless, so it scales with the source's partitions.

With ``run_checked`` the leg refuses nothing silently: one stream writes what
it accepts to Bronze and everything else, with its text and the reason, to a
quarantine, so events in = events kept + events refused.

T3: the realtime Bronze is unioned with the batch feed and de-duplicated on
``event_id`` in Silver (``silver.union_feeds``), over all events: a watermark
in the stream would silently drop late ones.

T4: tumbling alert windows over a stream with a watermark. Windows are
written in update mode, so an alert shows in the micro-batch that raises it
and the last windows of a bounded drain come out too; the watermark only
bounds the state. The newest row per window counts.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.silver import ACCEPTED_EVENT_TYPES
from tillroll.schemas import CORRUPT
from tillroll.sources.files import ANY_AGE, path_exists

LOYALTY_JSON_SCHEMA = ("event_id string, customer_id string, event_date string, "
                       "event_type string, points string")


def json_source(spark: SparkSession, path: str, schema: str = LOYALTY_JSON_SCHEMA) -> DataFrame:
    """JSON event files as a stream (tests and file drops)."""
    return spark.readStream.schema(schema).json(path)


def parse_events(raw: DataFrame, schema: str = LOYALTY_JSON_SCHEMA, col: str = "value") -> DataFrame:
    """JSON text (or bytes) in a column -> event columns; other text gives NULLs."""
    return raw.select(F.from_json(F.col(col).cast("string"), schema).alias("e")).select("e.*")


def kafka_source(spark: SparkSession, servers: str, topic: str, schema: str = LOYALTY_JSON_SCHEMA,
                 starting_offsets: str = "earliest") -> DataFrame:
    """The same events from a Kafka-compatible broker (needs the
    spark-sql-kafka package on the cluster). A first run starts at the oldest
    event; later runs go on from the checkpoint."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return parse_events(raw, schema)


def realtime_leg(events: DataFrame, accepted: list[str] | None = None) -> DataFrame:
    """Filter to accepted event types and stamp arrival time."""
    return (events.filter(F.col("event_type").isin(*(accepted or ACCEPTED_EVENT_TYPES)))
                  .withColumn("_eventstream_ingested_ts", F.current_timestamp()))


# Why an event is refused, in the order of the tests.
MALFORMED, KEYLESS, TYPE = "malformed", "keyless", "event_type"


def text_source(spark: SparkSession, path: str) -> DataFrame:
    """JSON event files as a stream of raw lines (``value``), for ``run_checked``."""
    return spark.readStream.option("maxFileAge", ANY_AGE).text(path)


def kafka_lines(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """The broker's events as raw text, for ``run_checked``."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .select(F.col("value").cast("string").alias("value")))


def judge_events(raw: DataFrame, schema: str = LOYALTY_JSON_SCHEMA, accepted: list[str] | None = None,
                 key: str = "event_id") -> DataFrame:
    """Raw lines -> event columns, the line as ``_raw`` and ``_refused``, the reason or NULL.

    Blank lines are no events. A line that is not one JSON object, or whose
    values do not fit the schema, is malformed; an event without a key cannot
    be told from a repeat; other types than the accepted ones are not ours.
    """
    lines = raw.select(F.col("value").cast("string").alias("_raw")).filter(F.trim("_raw") != "")
    parsed = lines.withColumn("_e", F.from_json("_raw", f"{schema}, {CORRUPT} string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    event = parsed.select("_raw", "_e.*")
    kind = F.coalesce(F.col("event_type").isin(*(accepted or ACCEPTED_EVENT_TYPES)), F.lit(False))
    one_object = F.trim("_raw").startswith("{")
    reason = (F.when(F.col(CORRUPT).isNotNull() | ~one_object, MALFORMED)
              .when(F.col(key).isNull() | (F.col(key) == ""), KEYLESS)
              .when(~kind, TYPE))
    return event.withColumn("_refused", reason).drop(CORRUPT)


def split_sink(bronze: str, quarantine: str):
    """One micro-batch, two sinks: kept events to Bronze, refused lines to the quarantine.

    The batch is parsed once and kept while both are written. Each batch has a
    folder of its own in either sink, so a batch that is tried again replaces
    what it wrote before.
    """
    def save(batch: DataFrame, number: int) -> None:
        judged = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (judged.filter(F.col("_refused").isNull()).drop("_refused", "_raw")
             .withColumn("_eventstream_ingested_ts", F.current_timestamp())
             .write.mode("overwrite").parquet(f"{bronze}/_batch={number}"))
            (judged.filter(F.col("_refused").isNotNull())
             .select(F.col("_refused").alias("reason"), F.col("_raw").alias("raw"),
                     F.current_timestamp().alias("_eventstream_ingested_ts"))
             .write.mode("overwrite").parquet(f"{quarantine}/_batch={number}"))
        finally:
            judged.unpersist()
    return save


def run_checked(raw: DataFrame, bronze: str, quarantine: str, checkpoint: str, schema: str = LOYALTY_JSON_SCHEMA,
                accepted: list[str] | None = None, continuous_every: str | None = None) -> StreamingQuery:
    """T2 with a quarantine, over raw lines from ``text_source`` or ``kafka_lines``."""
    w = (judge_events(raw, schema, accepted).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(split_sink(bronze, quarantine)))
    if continuous_every:
        return w.trigger(processingTime=continuous_every).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def checked_accounting(spark: SparkSession, bronze: str, quarantine: str) -> DataFrame:
    """(outcome, events): 'kept' and one row a reason, over all batches."""
    kept = spark.read.schema("event_id string").parquet(bronze).select(F.lit("kept").alias("outcome"))
    refused = spark.read.schema("reason string").parquet(quarantine).select(F.col("reason").alias("outcome"))
    return kept.unionByName(refused).groupBy("outcome").agg(F.count(F.lit(1)).alias("events"))


def window_alerts(events: DataFrame, predicate: Column, ts: Column, window: str, delay: str,
                  alert: str, severity: int) -> DataFrame:
    """T4: tumbling-window counts of matching rows with a watermark.

    ``ts`` must be a TIMESTAMP (watermarks do not accept TIMESTAMP_NTZ);
    the emitted window bounds are returned as TIMESTAMP_NTZ. Matches are
    counted inside the aggregate rather than filtered before it: a filter
    would be pushed below the watermark, and the state would then be kept
    until the next *matching* row arrives instead of when the log moves on.
    """
    return (events.withColumn("_t", ts).withWatermark("_t", delay)
                  .groupBy(F.window("_t", window).alias("w"))
                  .agg(F.count_if(predicate).alias("hits"))
                  .filter(F.col("hits") > 0)
                  .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                          F.lit(alert).alias("alert"), F.lit(severity).alias("severity"), "hits"))


def run_to_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                continuous_every: str | None = None) -> StreamingQuery:
    """S12 (stream): append to a parquet sink.

    By default drain the available input and stop (availableNow). With
    ``continuous_every`` (e.g. "1 minute") the query keeps running on a
    processing-time trigger and the handle is returned without waiting.
    """
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode)
    if continuous_every:
        return w.trigger(processingTime=continuous_every).start(path)
    q = w.trigger(availableNow=True).start(path)
    q.awaitTermination()
    return q


def drain_updates(df: DataFrame, path: str, checkpoint: str) -> None:
    """Drain a windowed aggregate in update mode into one folder per micro-batch.

    A batch that is tried again overwrites its own folder.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
       .trigger(availableNow=True).foreachBatch(save).start().awaitTermination())


def latest_updates(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """The newest row per key of ``drain_updates`` folders; none when no batch came."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])) \
        .option("basePath", path).parquet(path)
    rest = [c for c in schema.names if c not in keys]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("newest"))
            .select(*[F.col(c) if c in keys else F.col(f"newest.{c}").alias(c) for c in schema.names]))
