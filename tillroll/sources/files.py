"""File sources and sinks: CSV landing, ingest stamps, table writes.

Storage layout under a lake root (any Hadoop path):
  <lake>/bronze/<table>        parquet, appended by the ingest streams
  <lake>/silver/<table>/v=<id> parquet, one directory per written version
  <lake>/silver/transactions/epoch=<n>  appended, bucketed by transaction id:
                               one partition per consumed Bronze batch
  <lake>/gold/<table>/v=<id>
  <lake>/_current/<layer>/<table>  append-only log of published versions
A new version is written completely before the pointer moves, so a reader
never sees a half-written table and a table can be rebuilt from itself
(SCD2) without overwriting the files it is reading. One writer per table.
"""

from __future__ import annotations

import hashlib
import json
import time
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.oplog import LOG_DAY
from tillroll.schemas import CORRUPT, RAW_SCHEMAS


class TableStateError(RuntimeError):
    """A table's stored state is damaged; nothing may be assumed about it."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Only "there is no such path" is False; any other trouble raises."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# Files of a stream are told apart by its checkpoint, never by their age: a file
# that comes late or with an old time stamp is as new as any other.
ANY_AGE = "36500d"


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def literal_path(path: str) -> str:
    """A path that readers take as it is: characters of glob patterns are escaped."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def landing_schema(table: str) -> T.StructType:
    """The registry's text columns, and a place for lines that do not fit them."""
    return T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(CORRUPT, T.StringType(), True)])


def landing_options(glob: str = "*.csv", recursive: bool = True) -> dict:
    """S1 + S4 for batch and stream alike.

    The header is checked against the registry (a reordered or renamed column
    stops the read instead of landing in the wrong field), a line with too few
    or too many fields is kept whole in the corrupt-record column, and files
    are picked up below the folder as well.
    """
    return {"header": "true", "enforceSchema": "false", "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT, "pathGlobFilter": glob,
            "recursiveFileLookup": str(recursive).lower()}


def read_landing_csv(spark: SparkSession, path: str | list[str], table: str, glob: str = "*.csv",
                     recursive: bool = True) -> DataFrame:
    """S1 + S4: header row, comma, every column text; recursive wildcard pick-up.

    The schema comes from the registry (S3), never from inference.
    """
    return spark.read.schema(landing_schema(table)).options(**landing_options(glob, recursive)).csv(path)


def landing_files(spark: SparkSession, path: str, glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """(file) under a landing folder, from the listing alone: no content is read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file string")
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(path)
            .select(F.col("_metadata.file_path").alias("file")))


def new_landing_files(spark: SparkSession, path: str, bronze_path: str) -> list[str]:
    """Landing files of which Bronze holds no row yet (one delivery's file names)."""
    found = landing_files(spark, path)
    if path_exists(spark, bronze_path):
        done = spark.read.schema("_source_file string").parquet(bronze_path) \
            .select(F.col("_source_file").alias("file")).distinct()
        found = found.join(done, "file", "left_anti")
    return sorted(unquote(r["file"]) for r in found.collect())


def read_new_landing(spark: SparkSession, landing: str, table: str, bronze_path: str) -> DataFrame:
    """The rows that the next ingest of a table will add."""
    files = new_landing_files(spark, f"{landing.rstrip('/')}/{table}", bronze_path)
    if not files:
        return spark.createDataFrame([], landing_schema(table))
    return read_landing_csv(spark, [literal_path(f) for f in files], table)


def ingest_stamps() -> list[Column]:
    """Ingest time and source file of each row."""
    return [F.current_timestamp().alias("_ingested_ts"),
            F.col("_metadata.file_path").alias("_source_file")]


def stamp_ingest(df: DataFrame) -> DataFrame:
    return df.select("*", *ingest_stamps())


def write_overwrite(df: DataFrame, path: str) -> None:
    """S11."""
    df.write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str) -> None:
    """S12 (batch)."""
    df.write.mode("append").parquet(path)


def write_day_log(df: DataFrame, path: str, ts: str = "TimeGenerated") -> None:
    """Append log rows to a table with one folder per day.

    Rows are dealt by time, so a task writes few days and a busy day is dealt
    over several tasks, and sorted by time inside a file, so that its row
    groups can be skipped by time as well. Rows without a time go to the
    default partition, which no time window reads.
    """
    day = F.to_date(F.col(ts))
    (df.withColumn(LOG_DAY, day).repartitionByRange(LOG_DAY, ts).sortWithinPartitions(LOG_DAY, ts)
     .write.mode("append").partitionBy(LOG_DAY).parquet(path))


def read_day_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A log laid out by day; its window queries list and read the days asked for."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(LOG_DAY, T.DateType(), True)])).parquet(path)


def publish_view(spark: SparkSession, lake: str, layer: str, table: str, name: str, database: str,
                 catalog: str | None = None) -> str:
    """A catalog view on a table's current version, pointed anew at each publication.

    The view names the version's folder: replacing it is one catalog change,
    and a reader that has resolved the old one reads on undisturbed. Any
    session of the catalog sees it; nothing is copied.
    """
    version = current_version(spark, lake, layer, table)
    if version is None:
        raise FileNotFoundError(f"{layer}.{table} has no version under {lake}")
    view = _qualified(catalog, database, name)
    folder = f"{lake.rstrip('/')}/{layer}/{table}/v={version}".replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT 'version {version}' AS SELECT * FROM parquet.`{folder}`")
    return view


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV export of a Gold table (one file set per table)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _pointer(lake: str, layer: str, table: str) -> str:
    return f"{lake.rstrip('/')}/_current/{layer}/{table}"


def _published(spark: SparkSession, lake: str, layer: str, table: str) -> DataFrame:
    """The pointer log: one (version) row per publication."""
    return spark.read.schema("version string").json(_pointer(lake, layer, table))


def published(spark: SparkSession, lake: str, layer: str, table: str) -> DataFrame:
    """(v) as numbers: the versions that readers may see, to join version folders with."""
    return _published(spark, lake, layer, table).select(F.col("version").cast("bigint").alias("v")).distinct()


def current_version(spark: SparkSession, lake: str, layer: str, table: str) -> str | None:
    """The current version id of a table, or None when it was never written.

    Only a missing pointer means "never written"; a damaged one raises.
    """
    if not path_exists(spark, _pointer(lake, layer, table)):
        return None
    row = _published(spark, lake, layer, table).agg(
        F.max("version").alias("version"), F.count(F.lit(1)).alias("n"), F.count("version").alias("good")).first()
    if not row["n"] or row["n"] != row["good"]:
        raise TableStateError(f"damaged pointer of {layer}.{table} under {lake}")
    return row["version"]


def table_exists(spark: SparkSession, lake: str, layer: str, table: str) -> bool:
    """S16 for path tables (``spark.catalog.tableExists`` for catalog ones)."""
    return current_version(spark, lake, layer, table) is not None


def read_table(spark: SparkSession, lake: str, layer: str, table: str) -> DataFrame:
    """The current version of a layer table."""
    v = current_version(spark, lake, layer, table)
    if v is None:
        raise FileNotFoundError(f"{layer}.{table} has no version under {lake}")
    return spark.read.parquet(f"{lake.rstrip('/')}/{layer}/{table}/v={v}")


def sorted_layout(df: DataFrame, by: list[str | Column]) -> DataFrame:
    """O1 as a layout: rows dealt to tasks by ranges of ``by`` and sorted inside each.

    File and row group hold a narrow range each, so a filter on the leading
    column skips the others by their statistics, and reading the files in
    order gives the rows in order, without any task holding them all.
    """
    return df.repartitionByRange(*by).sortWithinPartitions(*by) if by else df


def stage_version(df: DataFrame, lake: str, layer: str, table: str, partition_by: list[str] | None = None,
                  sort_by: list[str | Column] | None = None) -> tuple[str, str]:
    """Write a new version folder without publishing it; returns (version, path)."""
    df = sorted_layout(df, sort_by or [])
    version = f"{int(time.time() * 1000):015d}"
    path = f"{lake.rstrip('/')}/{layer}/{table}/v={version}"
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return version, path


def publish_version(spark: SparkSession, lake: str, layer: str, table: str, version: str) -> None:
    """Move the table's pointer to a staged version.

    The pointer is an append-only log of published versions; the current
    version is the newest entry. Appending never removes the previous entry,
    so a concurrent reader always finds a complete version.
    """
    (spark.createDataFrame([(version,)], "version string").coalesce(1)
          .write.mode("append").json(_pointer(lake, layer, table)))


def write_version(spark: SparkSession, df: DataFrame, lake: str, layer: str, table: str,
                  sort_by: list[str | Column] | None = None) -> str:
    """S11 as a versioned overwrite: write a new version, then move the pointer."""
    version, _ = stage_version(df, lake, layer, table, sort_by=sort_by)
    publish_version(spark, lake, layer, table, version)
    return version


def read_all_versions(spark: SparkSession, lake: str, layer: str, table: str) -> DataFrame:
    """Rows of every published version, with the version id in ``v``.

    For tables whose versions add up (appended facts, closed dimension rows).
    Versions that were staged but never published do not show.
    """
    if current_version(spark, lake, layer, table) is None:
        raise FileNotFoundError(f"{layer}.{table} has no version under {lake}")
    done = published(spark, lake, layer, table)
    rows = spark.read.parquet(f"{lake.rstrip('/')}/{layer}/{table}")
    return rows.withColumn("v", F.col("v").cast("bigint")).join(done, "v", "left_semi")


def _decoded(uri: Column) -> Column:
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def lake_inventory(spark: SparkSession, lake: str, added_up: tuple[str, ...] = ()) -> DataFrame:
    """(path, size_gb, modified, is_version) of the lake's own files, for ``oplog.storage_tiers``.

    Names, sizes and times come from the listing; no content is read. ``path``
    is relative to the lake. A file is an old version if its table has a newer
    published one; of the tables in ``added_up`` ("layer.table"), whose
    versions add up, every published version is current. A staged version that
    is newer than the published one is current, too. Files and folders whose
    names start with _ or . (pointers, markers) are not listed.
    """
    root = lake.rstrip("/")
    below = root.split("://", 1)[-1].split("/", 1)[-1] + "/"
    uri = _decoded(F.col("_metadata.file_path"))
    rest = F.substr(uri, F.locate(below, uri) + F.lit(len(below)))
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(rest.alias("path"), (F.col("_metadata.file_size") / F.lit(float(1 << 30))).alias("size_gb"),
                     F.col("_metadata.file_modification_time").alias("modified")))
    part = lambda c, i: F.nullif(F.regexp_extract(c, r"^([^/]+)/([^/]+)/v=(\d+)/", i), F.lit(""))
    found = found.select("*", part("path", 1).alias("layer"), part("path", 2).alias("name"),
                         part("path", 3).cast("bigint").alias("v"))
    pointers = f"{root}/_current"
    if not path_exists(spark, pointers):
        return found.select("path", "size_gb", "modified", F.lit(False).alias("is_version"))
    place = lambda i: F.regexp_extract(_decoded(F.col("_metadata.file_path")),
                                       r"/_current/([^/]+)/([^/]+)/[^/]+$", i)
    log = spark.read.schema("version string").option("recursiveFileLookup", "true").json(pointers) \
        .select(place(1).alias("layer"), place(2).alias("name"), F.col("version").cast("bigint").alias("done"))
    newest = log.groupBy("layer", "name").agg(F.max("done").alias("newest"))
    live = log.filter(F.concat_ws(".", "layer", "name").isin(*added_up)).select(
        "layer", "name", F.col("done").alias("v"), F.lit(True).alias("adds")).distinct()
    return found.join(newest, ["layer", "name"], "left").join(live, ["layer", "name", "v"], "left").select(
        "path", "size_gb", "modified",
        (F.coalesce(F.col("v") < F.col("newest"), F.lit(False)) & F.col("adds").isNull()).alias("is_version"))


# Some 16 million ids a bucket: a task streams them past a hash table of the
# new ids, so a bucket's size costs time, not memory.
BUCKET_ROWS = 1 << 24
MOST_BUCKETS = 1 << 16
# The first run's rows stand for a day's; the table is laid out for a year.
LAID_OUT_RUNS = 365


def buckets_for(rows: int) -> int:
    """Bucket count for a table that shall hold ``rows`` rows, a power of two."""
    return min(MOST_BUCKETS, 1 << (max(0, rows - 1) // BUCKET_ROWS).bit_length())


def bucketed_table(spark: SparkSession, lake: str, layer: str, table: str, schema: T.StructType | None = None,
                   key: str | None = None, buckets: int | None = None) -> str:
    """Catalog name of an appended table that is hash-bucketed by ``key``.

    The files lie under the lake in one partition per ``epoch``; the catalog
    entry only names them, so a session whose catalog forgets it registers it
    again. Key and bucket count are fixed by the first call and kept beside
    the table: every partition must be bucketed alike to be joined without a
    shuffle.
    """
    root = lake.rstrip("/")
    spec_path, name = f"{root}/_spec/{layer}/{table}", f"{layer}_{table}_{hashlib.md5(root.encode()).hexdigest()[:12]}"
    if not path_exists(spark, spec_path):
        if schema is None or key is None or buckets is None:
            raise FileNotFoundError(f"{layer}.{table} has no bucketed table under {lake}")
        spark.createDataFrame([(key, buckets, schema.json())], "key string, buckets int, columns string") \
            .coalesce(1).write.json(spec_path)
    rows = spark.read.schema("key string, buckets int, columns string").json(spec_path).collect()
    if len(rows) != 1 or None in rows[0]:
        raise TableStateError(f"damaged specification of {layer}.{table} under {lake}")
    spec, columns = rows[0], T.StructType.fromJson(json.loads(rows[0]["columns"]))
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        location = f"{root}/{layer}/{table}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({fields}, epoch bigint) USING parquet "
                  f"PARTITIONED BY (epoch) CLUSTERED BY (`{spec['key']}`) SORTED BY (`{spec['key']}`) "
                  f"INTO {spec['buckets']} BUCKETS LOCATION '{location}'")
        if path_exists(spark, f"{root}/{layer}/{table}"):
            spark.sql(f"MSCK REPAIR TABLE `{name}`")
    return name


def bucket_count(spark: SparkSession, lake: str, layer: str, table: str) -> int:
    spec_path = f"{lake.rstrip('/')}/_spec/{layer}/{table}"
    return spark.read.schema("key string, buckets int").json(spec_path).first()["buckets"]


def write_epoch(spark: SparkSession, df: DataFrame, name: str, key: str, buckets: int, epoch: int) -> None:
    """Replace one epoch's partition; a batch that is tried again writes the same rows once more.

    Rows are dealt by the bucket key first, so each task writes one file for each of its buckets.
    """
    columns = [c for c in spark.table(name).columns if c != "epoch"]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        (df.repartition(buckets, key).select(*columns, F.lit(epoch).cast("bigint").alias("epoch"))
         .write.mode("overwrite").insertInto(name))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def read_epochs(spark: SparkSession, lake: str, layer: str, table: str) -> DataFrame:
    """Rows of every published epoch of a bucketed table, still bucketed by its key.

    The published epochs (one number a run) go into the filter as values:
    folders of other epochs are not even listed, so a batch that is written
    anew disturbs no reader, and no join comes between the scan and its
    bucketing. The listing is refreshed, as another session may have written.
    """
    if current_version(spark, lake, layer, table) is None:
        raise FileNotFoundError(f"{layer}.{table} has no version under {lake}")
    epochs = [r["v"] for r in published(spark, lake, layer, table).orderBy("v").collect()]
    name = bucketed_table(spark, lake, layer, table)
    spark.catalog.refreshTable(name)
    return spark.table(name).filter(F.col("epoch").isin(epochs)).drop("epoch")


def expire_versions(spark: SparkSession, lake: str, layer: str, table: str, keep: int) -> list[str]:
    """Delete the folders of all but the newest ``keep`` published versions.

    Only for tables that are rewritten whole; one listing row per version.
    """
    old = [r["version"] for r in _published(spark, lake, layer, table).distinct()
           .orderBy(F.desc("version")).offset(max(1, keep)).collect()]
    gone = []
    for v in old:
        folder = f"{lake.rstrip('/')}/{layer}/{table}/v={v}"
        if path_exists(spark, folder):
            p = spark._jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            gone.append(v)
    return gone


def create_layers(spark: SparkSession, layers=("bronze", "silver", "gold"), catalog: str | None = None) -> None:
    """One database per layer, in the session catalog or a named one."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_qualified(catalog, layer)}")


def _qualified(catalog: str | None, *parts: str) -> str:
    return ".".join(f"`{p}`" for p in ((catalog,) if catalog else ()) + parts)


def save_catalog_table(df: DataFrame, layer: str, table: str, catalog: str | None = None) -> None:
    """S11 for catalog tables."""
    df.write.mode("overwrite").saveAsTable(_qualified(catalog, layer, table))


def read_catalog_table(spark: SparkSession, layer: str, table: str, catalog: str | None = None) -> DataFrame:
    """S9 for catalog tables; ``catalog_table_exists`` tells whether there is one."""
    return spark.table(_qualified(catalog, layer, table))


def catalog_table_exists(spark: SparkSession, layer: str, table: str, catalog: str | None = None) -> bool:
    return spark.catalog.tableExists(_qualified(catalog, layer, table))
