"""End-to-end run: landing check -> Bronze -> Silver -> quality gate -> Gold.

``run_pipeline(spark, landing, lake, as_of)`` is the whole job. Tables are
exchanged between the steps only through the lake (like separate job tasks),
so a step can be re-run on its own and lineage never spans the whole job.
The quality gate sits between Silver and Gold: a failed check raises before
anything is published.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import dq, gold, scd2, silver
from tillroll.plans import semantic
from tillroll.schemas import INGEST_STAMPS, TABLES
from tillroll.sources import binding, files
from tillroll.streaming import file_ingest, realtime, silver_append


@dataclass
class RunSummary:
    landing_rows: dict = field(default_factory=dict)
    bronze_rows: dict = field(default_factory=dict)
    accounting: dict = field(default_factory=dict)
    rejected: dict = field(default_factory=dict)
    silver_versions: dict = field(default_factory=dict)
    gold_versions: dict = field(default_factory=dict)
    dq_failed: int = 0


def write_landing(spark: SparkSession, sf_dir: str, landing: str,
                  tables: list[str] | None = None, overrides: dict | None = None) -> None:
    """Export the bound retail tables as CSV extracts into a landing folder.

    ``overrides`` maps a table name to a DataFrame to export instead (e.g. a
    second customer snapshot). Each call adds a new set of files.
    """
    overrides = overrides or {}
    for t in tables or TABLES:
        df = overrides.get(t)
        if df is None:
            df = binding.RAW_BINDERS[t](spark, sf_dir)
        df.write.mode("append").option("header", True).csv(f"{landing.rstrip('/')}/{t}")


def _silver_read(spark, lake, t):
    """Current rows of a Silver table. Transactions are appended run by run,
    the customer dimension keeps its current rows in a partition of their own."""
    if t == "transactions":
        return files.read_epochs(spark, lake, "silver", t)
    if t == "dim_customer":
        version = files.current_version(spark, lake, "silver", t)
        if version is None:
            raise FileNotFoundError(f"silver.{t} has no version under {lake}")
        return (spark.read.parquet(f"{lake.rstrip('/')}/silver/{t}/v={version}")
                .withColumn("is_current", F.col("is_current").cast("boolean")).filter("is_current"))
    return files.read_table(spark, lake, "silver", t)


def read_dim_customer(spark: SparkSession, lake: str) -> DataFrame:
    """The whole type 2 dimension: current rows plus the rows each published run closed."""
    cur = _silver_read(spark, lake, "dim_customer")
    closed = (files.read_all_versions(spark, lake, "silver", "dim_customer")
              .withColumn("is_current", F.col("is_current").cast("boolean")).filter("NOT is_current"))
    return cur.unionByName(closed.select(*cur.columns))


def _dim_bounds(spark: SparkSession, lake: str) -> dict[str, int]:
    """Proven row bounds of the written dimensions (Parquet footers only):
    dimensions under the broadcast limit are broadcast, larger ones shuffle."""
    return {"customers": _silver_read(spark, lake, "dim_customer").count(),
            "products": _silver_read(spark, lake, "products").count(),
            "stores": _silver_read(spark, lake, "stores").count()}


def run_bronze(spark: SparkSession, landing: str, lake: str,
               landing_minimums: dict | None = None,
               max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> dict:
    """Task 1: landing gate (S8, D20), then drain landing files into Bronze.

    The gate counts the files that are not in Bronze yet, in one scan, so an
    empty second delivery fails however much was delivered before.
    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` drains a large backlog in bounded micro-batches.
    """
    lake = lake.rstrip("/")
    fresh = {t: files.read_new_landing(spark, landing, t, f"{lake}/bronze/{t}") for t in TABLES}
    rows = dq.enforce_landing(dq.landing_row_counts(fresh, landing_minimums))
    return {"landing_rows": {r["table"]: r["rows"] for r in rows},
            "bronze_rows": file_ingest.ingest_all(spark, landing, lake,
                                                  max_files_per_trigger=max_files_per_trigger,
                                                  max_bytes_per_trigger=max_bytes_per_trigger)}


def run_realtime(spark: SparkSession, events: DataFrame, lake: str, continuous_every: str | None = None):
    """Realtime task: a stream of JSON events -> accepted types -> Bronze.

    ``events`` comes from ``realtime.json_source`` or ``realtime.kafka_source``;
    the Silver task takes the folder as ``realtime_bronze``.
    """
    lake = lake.rstrip("/")
    return realtime.run_to_sink(realtime.realtime_leg(events), f"{lake}/bronze/loyalty_realtime",
                                f"{lake}/_checkpoints/loyalty_realtime", continuous_every=continuous_every)


def run_realtime_checked(spark: SparkSession, raw: DataFrame, lake: str, continuous_every: str | None = None):
    """Realtime task with a quarantine: ``raw`` comes from ``realtime.text_source`` or ``realtime.kafka_lines``.

    Kept events land where ``run_realtime`` puts them; refused lines, with the
    reason, in ``<lake>/quarantine/loyalty_realtime``.
    """
    lake = lake.rstrip("/")
    return realtime.run_checked(raw, f"{lake}/bronze/loyalty_realtime", f"{lake}/quarantine/loyalty_realtime",
                                f"{lake}/_checkpoints/loyalty_realtime_checked", continuous_every=continuous_every)


def run_silver(spark: SparkSession, lake: str, as_of: str, *, realtime_bronze: str | None = None,
               pass_rate: float = 0.95, null_safe_scd: bool = False, keep_versions: int = 0,
               buckets: int | None = None, max_bytes_per_batch: str | None = None) -> dict:
    """Task 2: Bronze -> Silver. Returns the reject accounting and versions.

    Transactions are appended, never rewritten: each run takes the Bronze
    files that no run has taken (``silver_append``), in batches of at most
    ``max_bytes_per_batch``. ``keep_versions`` (0: all) is how many versions
    stay of the tables that are rewritten on every run.
    """
    lake = lake.rstrip("/")
    bronze = {t: spark.read.parquet(f"{lake}/bronze/{t}") for t in TABLES}
    v = {}

    # Transactions: a batch is published only when the pass rate holds (Q9),
    # so a failing cleanse is never visible.
    acc, v["transactions"] = silver_append.append_transactions(spark, lake, pass_rate, buckets, max_bytes_per_batch)
    rejected = {t: silver.rejected_rows(bronze[t], t) for t in ("customers", "products", "stores")}
    for t in ("products", "stores"):
        v[t] = files.write_version(spark, silver.conform(bronze[t], t), lake, "silver", t)

    # Customer dimension: first load or type 2 merge (C1-C3), written once.
    # The version holds the current rows and, in a partition of its own, the
    # rows this run closes; earlier closed rows stay in their versions.
    staged = silver.conform(bronze["customers"], "customers").drop(*INGEST_STAMPS)
    if files.table_exists(spark, lake, "silver", "dim_customer"):
        old = _silver_read(spark, lake, "dim_customer")
        dim = scd2.scd2_merge(old, staged, ["customer_id"], ["loyalty_tier"], as_of, null_safe_scd)
    else:
        dim = scd2.scd2_initial(staged, as_of)
    version, _ = files.stage_version(dim, lake, "silver", "dim_customer", ["is_current"])
    files.publish_version(spark, lake, "silver", "dim_customer", version)
    v["dim_customer"] = version

    # Loyalty: batch and realtime feeds, accepted types, known customers.
    rt = spark.read.parquet(realtime_bronze) if realtime_bronze else None
    current = _silver_read(spark, lake, "dim_customer")
    loyalty = silver.silver_loyalty(silver.drop_stamps(bronze["loyalty_events"]),
                                    silver.drop_stamps(rt) if rt is not None else None,
                                    current.select("customer_id"), current.count())
    v["loyalty_events"] = files.write_version(spark, loyalty, lake, "silver", "loyalty_events", ["event_date", "event_id"])
    if keep_versions:
        for t in ("products", "stores", "loyalty_events"):
            files.expire_versions(spark, lake, "silver", t, keep_versions)
    return {"accounting": acc, "rejected": rejected, "versions": v}


def run_quality_gate(spark: SparkSession, lake: str, as_of: str, *, suite_as_of: str | None = None,
                     freshness_days: int = 3650) -> DataFrame:
    """Task 3: the six Silver checks (Q6-Q8, D12), stored, then enforced.

    Results are appended to ``<lake>/dq_results`` with a run id before the
    gate raises, so a failed run still leaves its evidence.
    """
    lake = lake.rstrip("/")
    run_id = f"{int(time.time() * 1000):015d}"
    results = dq.silver_suite(_silver_read(spark, lake, "transactions"), read_dim_customer(spark, lake),
                              _silver_read(spark, lake, "loyalty_events"), suite_as_of or as_of,
                              freshness_days, customer_rows=_dim_bounds(spark, lake)["customers"])
    return dq.enforce(dq.store_results(results, f"{lake}/dq_results", as_of, run_id))


def _gold_order() -> dict:
    """How Gold tables are laid out: reports filter sales by month and read stores by place."""
    return {"sales_by_region_category_month": ["month", "region", "category"],
            "store_performance": [F.desc("revenue"), F.asc("store_id")]}


def run_gold(spark: SparkSession, lake: str, *, export_csv: bool = False) -> dict:
    """Task 4: Silver -> Gold.

    Every fact aggregate comes from one pass over the enriched fact (grouping
    sets), staged once, then split into the Gold tables. The fact is never
    cached, however large it is.
    """
    lake = lake.rstrip("/")
    enriched = gold.enrich(_silver_read(spark, lake, "transactions"), _silver_read(spark, lake, "products"),
                           _silver_read(spark, lake, "stores"), _silver_read(spark, lake, "dim_customer"),
                           _dim_bounds(spark, lake))
    stage = files.write_version(spark, gold.gold_one_pass(enriched), lake, "gold", "one_pass")
    agg = spark.read.parquet(f"{lake}/gold/one_pass/v={stage}")
    outputs = {name: gold.from_one_pass(agg, name) for name in
               ("sales_by_region_category_month", "loyalty_tier_value", "store_performance")}
    outputs["loyalty_points_liability"] = gold.points_liability(_silver_read(spark, lake, "loyalty_events"))
    versions = {}
    for name, df in outputs.items():
        versions[name] = files.write_version(spark, df, lake, "gold", name, _gold_order().get(name))
        if export_csv:
            files.export_csv(files.read_table(spark, lake, "gold", name), f"{lake}/export/{name}")
    return versions


def run_pipeline(spark: SparkSession, landing: str, lake: str, as_of: str, *,
                 suite_as_of: str | None = None, realtime_bronze: str | None = None,
                 freshness_days: int = 3650, pass_rate: float = 0.95,
                 landing_minimums: dict | None = None, export_csv: bool = False,
                 null_safe_scd: bool = False, keep_versions: int = 0) -> RunSummary:
    """Run the whole job once: the four tasks in order. ``as_of`` is the run
    date (SCD2 validity); ``suite_as_of`` the freshness reference date."""
    summary = RunSummary()
    b = run_bronze(spark, landing, lake, landing_minimums)
    summary.landing_rows, summary.bronze_rows = b["landing_rows"], b["bronze_rows"]
    s = run_silver(spark, lake, as_of, realtime_bronze=realtime_bronze, pass_rate=pass_rate,
                   null_safe_scd=null_safe_scd, keep_versions=keep_versions)
    summary.accounting, summary.rejected = s["accounting"], s["rejected"]
    summary.silver_versions = s["versions"]
    try:
        run_quality_gate(spark, lake, as_of, suite_as_of=suite_as_of, freshness_days=freshness_days)
    except dq.DQGateError:
        summary.dq_failed = -1
        raise
    summary.gold_versions = run_gold(spark, lake, export_csv=export_csv)
    return summary


def _dates(spark: SparkSession, lake: str) -> DataFrame:
    bounds = gold.from_one_pass(files.read_table(spark, lake, "gold", "one_pass"), "date_range")
    return semantic.dim_date_between(bounds.select(F.col("first_date").alias("lo"), F.col("last_date").alias("hi")))


def gold_views(spark: SparkSession, lake: str, perspective: str | None = None) -> list[str]:
    """Publish the Gold tables under their fact names, for this session."""
    facts = {fact: files.read_table(spark, lake, "gold", table)
             for fact, table in semantic.FACT_TABLES.items()}
    return semantic.register_views(spark, facts, _dates(spark, lake), perspective)


def publish_catalog(spark: SparkSession, lake: str, database: str = "gold", catalog: str | None = None,
                    perspective: str | None = None) -> list[str]:
    """The facts and dim_date as catalog views that other sessions read by name.

    Run after each ``run_gold``; every view then shows that run's version.
    """
    lake = lake.rstrip("/")
    files.write_version(spark, _dates(spark, lake), lake, "gold", "dim_date")
    tables = semantic.FACT_TABLES | {"dim_date": "dim_date"}
    files.create_layers(spark, (database,), catalog)
    names = [n for n in (semantic.PERSPECTIVES[perspective] if perspective else tables)]
    return [files.publish_view(spark, lake, "gold", tables[n], n, database, catalog) for n in names]


def read_gold(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return files.read_table(spark, lake, "gold", name)
