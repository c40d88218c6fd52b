"""Bronze -> Silver by batch: each Bronze file is cleansed once, never by the clock.

Bronze is read as a file stream with a checkpoint of its own. What a batch
holds is settled by the checkpoint's log before the batch runs, so a row can
neither be skipped because a clock stepped back nor taken twice because two
ingests overlapped, and a batch that is tried again has the same rows.

One batch (epoch n):
1. if epoch n is published already, only the checkpoint is behind: done;
2. cleanse the batch into a staging folder. The same pass counts the rejects
   (``observe``). A task that ran twice counts twice, so the counts are taken
   only when their total equals the files' row count (footers); otherwise one
   plain aggregate counts again;
3. set the staged rows against the published ids. The history is bucketed by
   id and streamed where it lies, probing a hash table of the batch's ids: the
   history is neither shuffled nor sorted. Only ids that are known come out;
4. write what is new as partition ``epoch=n``, replacing a half-written one;
5. check the pass rate over all published epochs and this one, write the
   epoch's accounting, then publish it. Readers see published epochs only.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import dq, silver
from tillroll.sources import files

COUNTS = ["total", "malformed", "bad_quantity", "missing_customer", "duplicates", "clean"]
KEY = "transaction_id"


def bronze_stream(spark: SparkSession, path: str, max_bytes_per_batch: str | None = None) -> DataFrame:
    """The files of a Bronze table as a stream, in batches of bounded size when asked for."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFileAge", files.ANY_AGE)
    if max_bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    return reader.parquet(path)


def known_ids(history: DataFrame, ids: DataFrame, buckets: int, key: str = KEY) -> DataFrame:
    """The ids of a batch that the bucketed history holds: the history is the streamed side.

    The batch's ids are dealt by the history's own buckets. Left to itself the
    planner deals both sides into the session's shuffle partitions when these
    are more than the buckets, and would shuffle the history each run.
    """
    new = ids.select(key).repartition(buckets, key).hint("shuffle_hash")
    return history.select(key).join(new, key, "left_semi")


def past_counts(spark: SparkSession, lake: str, book: str) -> dict:
    """Sums of the published epochs' accounting."""
    if not files.table_exists(spark, lake, "silver", "transactions"):
        return dict.fromkeys(COUNTS, 0)
    done = files.published(spark, lake, "silver", "transactions")
    rows = spark.read.parquet(book).withColumn("v", F.col("v").cast("bigint")).join(done, "v", "left_semi")
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]).first().asDict()


def total_accounting(spark: SparkSession, lake: str) -> dict:
    """The reject accounting over all published epochs."""
    acc = past_counts(spark, lake, _book(lake))
    acc["rejected"] = acc["total"] - acc["clean"]
    acc["pass_rate"] = acc["clean"] / acc["total"] if acc["total"] else 0.0
    return acc


def _book(lake: str) -> str:
    return f"{lake.rstrip('/')}/_accounting/transactions"


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def _published_by(spark: SparkSession, lake: str, epoch: int) -> str | None:
    """The stream that published an epoch, if one did."""
    if not files.table_exists(spark, lake, "silver", "transactions"):
        return None
    if files.published(spark, lake, "silver", "transactions").filter(F.col("v") == epoch).isEmpty():
        return None
    return spark.read.parquet(f"{_book(lake)}/v={epoch}").first()["source"]


def append_epoch(spark: SparkSession, lake: str, batch: DataFrame, epoch: int, source: str,
                 pass_rate: float, buckets: int | None = None) -> dict:
    """Cleanse one batch and publish it as epoch ``epoch``; returns its accounting.

    ``buckets`` counts for the table's first epoch only.
    """
    by = _published_by(spark, lake, epoch)
    if by == source:
        return {}
    if by is not None:
        raise files.TableStateError(
            f"epoch {epoch} of silver.transactions was published by stream {by}, not {source}: "
            "the checkpoint does not belong to this table")
    seen = Observation(f"transactions-{epoch}")
    staging = f"{lake}/_staging/transactions/epoch={epoch}"
    silver.cleanse_transactions(batch.observe(seen, *silver.reject_metrics(batch))).write.mode("overwrite") \
        .parquet(staging)
    clean = spark.read.parquet(staging)
    metrics = seen.get
    if metrics["total"] != batch.count():
        metrics = batch.agg(*silver.reject_metrics(batch)).first().asDict()
    if files.table_exists(spark, lake, "silver", "transactions"):
        known = known_ids(files.read_epochs(spark, lake, "silver", "transactions"), clean,
                          files.bucket_count(spark, lake, "silver", "transactions"))
        clean = clean.join(known, KEY, "left_anti").select(*clean.columns)
    buckets = buckets or files.buckets_for(metrics["total"] * files.LAID_OUT_RUNS)
    name = files.bucketed_table(spark, lake, "silver", "transactions", clean.schema, KEY, buckets)
    files.write_epoch(spark, clean, name, KEY, files.bucket_count(spark, lake, "silver", "transactions"), epoch)
    own = silver.accounting(metrics, spark.table(name).filter(F.col("epoch") == epoch).count())
    past = past_counts(spark, lake, _book(lake))
    total, good = past["total"] + own["total"], past["clean"] + own["clean"]
    rate = good / total if total else 0.0
    if rate < pass_rate:
        raise dq.DQGateError(f"transactions pass rate {rate:.2%} below {pass_rate:.0%}")
    (spark.createDataFrame([(source, *[own[c] for c in COUNTS])],
                           "source string, " + ", ".join(f"{c} bigint" for c in COUNTS))
     .coalesce(1).write.mode("overwrite").parquet(f"{_book(lake)}/v={epoch}"))
    files.publish_version(spark, lake, "silver", "transactions", f"{epoch:015d}")
    return own


def append_transactions(spark: SparkSession, lake: str, pass_rate: float = 0.95, buckets: int | None = None,
                        max_bytes_per_batch: str | None = None, bronze: str | None = None) -> tuple[dict, str | None]:
    """Drain the Bronze transactions that no run has taken into Silver.

    Returns the accounting over all runs and the newest published epoch. A
    batch under the pass rate raises and stays first in line: nothing of it is
    visible, and the next run tries the same rows again.
    """
    lake = lake.rstrip("/")
    checkpoint = f"{lake}/_checkpoints/silver_transactions"
    failed: list[Exception] = []

    def take(batch: DataFrame, epoch: int) -> None:
        try:
            append_epoch(batch.sparkSession, lake, batch, epoch, _query_id(spark, checkpoint), pass_rate, buckets)
        except (dq.DQGateError, files.TableStateError) as e:
            failed.append(e)
            raise

    query = (bronze_stream(spark, bronze or f"{lake}/bronze/transactions", max_bytes_per_batch).writeStream
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take).start())
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise
    return total_accounting(spark, lake), files.current_version(spark, lake, "silver", "transactions")
