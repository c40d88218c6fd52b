"""Incremental file ingest into Bronze.

A file stream with a checkpoint picks up each landing file exactly once;
``trigger(availableNow=True)`` drains what is there and stops, so the
stream runs like a batch job but never re-reads a file. The checkpoint must
live on shared storage so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.schemas import TABLES
from tillroll.sources.files import ANY_AGE, is_folder, landing_options, landing_schema, literal_path, path_exists, stamp_ingest


def landing_stream(spark: SparkSession, landing_dir: str, table: str, glob: str = "*.csv",
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Streaming CSV source for one landing table (explicit schema, S3).

    The options are those of the batch read, so stream and landing gate see
    the same files and reject the same headers. A file's age does not count:
    the checkpoint knows what was read, and a late copy may carry an old time
    stamp. A large backlog is split into several micro-batches (availableNow
    honours the limits): ``max_bytes_per_trigger`` bounds a batch whatever the
    sizes of the files, ``max_files_per_trigger`` by their number (S5). One of
    the two at most.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a batch is bounded in files or in bytes, not both")
    reader = spark.readStream.schema(landing_schema(table)).options(**landing_options(glob)) \
        .option("maxFileAge", ANY_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.csv(f"{landing_dir.rstrip('/')}/{table}")


def start_ingest(spark: SparkSession, landing_dir: str, table: str, bronze_path: str,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: str | None = None) -> StreamingQuery:
    """Start draining new landing files of one table into Bronze."""
    src = landing_stream(spark, landing_dir, table, max_files_per_trigger=max_files_per_trigger,
                         max_bytes_per_trigger=max_bytes_per_trigger)
    return (stamp_ingest(src).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(bronze_path))


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of a written table (footers only); 0 before its first write."""
    return spark.read.schema("_source_file string").parquet(path).count() if path_exists(spark, path) else 0


def ingest_table(spark: SparkSession, landing_dir: str, table: str, bronze_path: str,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: str | None = None) -> int:
    """Drain new landing files of one table into Bronze; returns rows added.

    The number comes from the table: the query's progress log forgets all but
    its last updates.
    """
    before = _rows(spark, bronze_path)
    query = start_ingest(spark, landing_dir, table, bronze_path, checkpoint, max_files_per_trigger,
                         max_bytes_per_trigger)
    query.awaitTermination()
    return _rows(spark, bronze_path) - before


def ingest_all(spark: SparkSession, landing_dir: str, lake: str,
               tables: list[str] | None = None,
               max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> dict[str, int]:
    """Ingest every table; returns rows in each Bronze table afterwards.

    The tables are independent, so their streams run concurrently and share
    the cluster; each stops when its landing folder is drained. The counts
    come from the written tables.
    """
    root = lake.rstrip("/")
    tables = tables or TABLES
    queries = {t: start_ingest(spark, landing_dir, t, f"{root}/bronze/{t}", f"{root}/_checkpoints/{t}",
                               max_files_per_trigger, max_bytes_per_trigger)
               for t in tables}
    for q in queries.values():
        q.awaitTermination()
    return {t: _rows(spark, f"{root}/bronze/{t}") for t in tables}


def stream_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table as a stream: a folder of parts, or one file.

    A file is reached through its folder, as a file stream lists folders.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.option("pathGlobFilter", literal_path(name)).parquet(folder)
