"""Silver: typing, cleansing, dedupe, integrity and the loyalty feed union.

Order matters in the transaction cleanse: rows are typed and filtered
*before* the dedupe, so a dirty first copy of a transaction can never win
over a clean later copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.exprs import (
    coerce_bool, coerce_date, coerce_decimal, coerce_number, positive, present,
)
from tillroll.functions.joins import bounded_broadcast
from tillroll.schemas import CORRUPT, INGEST_STAMPS, SILVER_TYPES

ACCEPTED_EVENT_TYPES = ["earn", "redeem", "expire"]

KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "stores": ["store_id"],
    "transactions": ["transaction_id"],
    "loyalty_events": ["event_id"],
}


def _typed(name: str, type_name: str) -> Column:
    if type_name in ("int", "bigint"):
        return coerce_number(name, type_name).alias(name)
    if type_name == "double":
        return F.col(name).try_cast("double").alias(name)
    if type_name.startswith("decimal"):
        p, s = type_name[len("decimal("):-1].split(",")
        return coerce_decimal(name, int(p), int(s)).alias(name)
    if type_name == "date":
        return coerce_date(name).alias(name)
    if type_name == "boolean":
        return coerce_bool(name).alias(name)
    return F.col(name).cast(type_name).alias(name)


def type_table(df: DataFrame, table: str) -> DataFrame:
    """Lenient typing of a raw/bronze table to its Silver types.

    Columns not in the registry (ingest stamps and the like) pass through.
    """
    types = SILVER_TYPES[table]
    cols = [_typed(c, types[c]) if c in types else F.col(c) for c in df.columns]
    return df.select(*cols)


def positive_quantity(df: DataFrame, col: str = "quantity") -> DataFrame:
    """Keep quantity > 0; NULL (unparseable) quantities are rejected."""
    return df.filter(positive(col))


def present_key(df: DataFrame, col: str = "customer_id") -> DataFrame:
    """Keep rows whose key is neither NULL nor empty."""
    return df.filter(present(col))


def event_type_in(df: DataFrame, accepted: list[str] | None = None,
                  col: str = "event_type") -> DataFrame:
    """Membership filter on the accepted event types."""
    return df.filter(F.col(col).isin(*(accepted or ACCEPTED_EVENT_TYPES)))


def _order(df: DataFrame, keys: list[str], order: list | None) -> list[Column]:
    if order is not None:
        return [F.col(c) if isinstance(c, str) else c for c in order]
    # A total order over the row content: identical rows are interchangeable,
    # so the survivor is the same on every run.
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]


def dedupe(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row per key, the first under a total order.

    Planned as a window row_number = 1. Spark inserts a partial
    WindowGroupLimit before the shuffle, so each map task forwards at most
    one row per key: a hot key is reduced map-side, not in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def latest_per_key(df: DataFrame, keys: list[str], stamp: str = "_ingested_ts") -> DataFrame:
    """The newest row per key by ingest time (ties by content)."""
    if stamp not in df.columns:
        return dedupe(df, keys)
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c != stamp]
    return dedupe(df, keys, [F.col(stamp).desc_nulls_last(), *rest])


TXN_ORDER = ["transaction_date", "customer_id", "product_id", "store_id",
             "quantity", "amount", "payment_method"]


def cleanse_transactions(bronze: DataFrame, stamp: bool = True) -> DataFrame:
    """Type -> quantity > 0 -> present customer -> dedupe -> stamp."""
    typed = type_table(well_formed(bronze), "transactions")
    order = [F.col(c).asc_nulls_last() for c in TXN_ORDER if c in typed.columns]
    if "_ingested_ts" in typed.columns:
        order = [F.col("_ingested_ts").asc_nulls_last(), *order]
    clean = dedupe(present_key(positive_quantity(typed)), ["transaction_id"], order)
    return clean.withColumn("_cleansed_ts", F.current_timestamp()) if stamp else clean


def reject_accounting(bronze: DataFrame) -> DataFrame:
    """Clean and rejected counts by reason, in one pass over Bronze.

    rejected = bad_quantity + missing_customer + duplicates = total - clean.
    """
    q = coerce_number("quantity", "int")
    qty_ok = F.coalesce(q > 0, F.lit(False))
    cust_ok = present("customer_id")
    # Per transaction id first (map-side combined), then rolled up: a key
    # survives the dedupe when it has at least one passing row (the NULL id
    # is one key, as in the dedupe). No DISTINCT aggregate, no Expand.
    per_id = bronze.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~qty_ok).alias("bad_quantity"),
        F.count_if(qty_ok & ~cust_ok).alias("missing_customer"),
        F.count_if(qty_ok & cust_ok).alias("passing"))
    agg = per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("bad_quantity"), F.lit(0)).alias("bad_quantity"),
        F.coalesce(F.sum("missing_customer"), F.lit(0)).alias("missing_customer"),
        F.coalesce(F.sum("passing"), F.lit(0)).alias("passing"),
        F.count_if(F.col("passing") > 0).alias("clean"),
    )
    return agg.select(
        "total", "clean",
        (F.col("total") - F.col("clean")).alias("rejected"),
        "bad_quantity", "missing_customer",
        (F.col("passing") - F.col("clean")).alias("duplicates"),
        F.coalesce(F.try_divide(F.col("clean"), F.col("total")), F.lit(0.0)).alias("pass_rate"),
    )


def reject_metrics(bronze: DataFrame) -> list[Column]:
    """P12 as plain aggregates over Bronze rows, for one more look (``reject_counts``)
    or for ``observe`` on the pass that cleanses them."""
    qty_ok = F.coalesce(coerce_number("quantity", "int") > 0, F.lit(False))
    cust_ok = F.coalesce(present("customer_id"), F.lit(False))
    bad = malformed() if CORRUPT in bronze.columns else F.lit(False)
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(bad).alias("malformed"),
            F.count_if(~bad & ~qty_ok).alias("bad_quantity"),
            F.count_if(~bad & qty_ok & ~cust_ok).alias("missing_customer"),
            F.count_if(~bad & qty_ok & cust_ok).alias("passing")]


def accounting(metrics: dict, clean_rows: int) -> dict:
    """The reject accounting from the metrics of a batch and the rows it kept."""
    total = metrics["total"]
    return {"total": total, "clean": clean_rows, "rejected": total - clean_rows,
            "malformed": metrics["malformed"], "bad_quantity": metrics["bad_quantity"],
            "missing_customer": metrics["missing_customer"], "duplicates": metrics["passing"] - clean_rows,
            "pass_rate": clean_rows / total if total else 0.0}


def reject_counts(bronze: DataFrame, clean_rows: int) -> dict:
    """P12 without a distinct count: reasons from one plain aggregate over
    Bronze, the clean count from the written Silver table (its footers).

    At scale this avoids shuffling every transaction id a second time just
    to count the survivors of a dedupe that already ran.
    """
    return accounting(bronze.agg(*reject_metrics(bronze)).first().asDict(), clean_rows)


def conform(bronze: DataFrame, table: str) -> DataFrame:
    """Typed passthrough, newest row per key.

    Rows whose business key is NULL or empty are rejected: they match no row
    of an earlier run, so every re-run would add them again. ``rejected_rows``
    counts them.
    """
    usable = all_keys_present(table)
    return latest_per_key(type_table(well_formed(bronze).filter(usable), table), KEYS[table])


def all_keys_present(table: str) -> Column:
    cond = F.lit(True)
    for k in KEYS[table]:
        cond = cond & F.coalesce(present(k), F.lit(False))
    return cond


def malformed() -> Column:
    return F.col(CORRUPT).isNotNull()


def well_formed(bronze: DataFrame) -> DataFrame:
    """Drop lines that did not fit the table's columns, and the column that keeps them."""
    return bronze.filter(~malformed()).drop(CORRUPT) if CORRUPT in bronze.columns else bronze


def rejected_rows(bronze: DataFrame, table: str) -> dict:
    """Malformed lines and rows without a business key, in one aggregate."""
    bad = malformed() if CORRUPT in bronze.columns else F.lit(False)
    return bronze.agg(F.count_if(bad).alias("malformed"),
                      F.count_if(~bad & ~all_keys_present(table)).alias("keyless")).first().asDict()


def integrity_filter(df: DataFrame, valid_keys: DataFrame, col: str = "customer_id",
                     key_col: str | None = None, key_rows: int | None = None) -> DataFrame:
    """Keep rows whose key exists in ``valid_keys`` (left semi join).

    A semi join never fans out when the key side repeats. No broadcast hint:
    the planner broadcasts the key side only when its size is under the
    threshold, and falls back to a shuffle join (with AQE skew splitting)
    beyond it. ``key_rows``, a proven bound on the key rows, lets a key side
    under the broadcast limit be broadcast even when the planner cannot
    estimate its size.
    """
    keys = bounded_broadcast(valid_keys.select(F.col(key_col or col).alias(col)), key_rows)
    return df.join(keys, col, "left_semi")


def union_feeds(batch: DataFrame, realtime: DataFrame, key: str = "event_id") -> DataFrame:
    """Batch and realtime loyalty feeds as one table, once per event.

    When both feeds carry an event, the batch copy wins (it is the system of
    record); ties within a feed go by content.
    """
    b = batch.withColumn("_feed", F.lit(0))
    r = realtime.withColumn("_feed", F.lit(1))
    u = b.unionByName(r, allowMissingColumns=True)
    rest = [F.col(c).asc_nulls_last() for c in u.columns
            if c not in (key, "_feed") and not c.startswith("_")]
    return dedupe(u, [key], [F.col("_feed"), *rest]).drop("_feed")


def silver_loyalty(batch_bronze: DataFrame, realtime_bronze: DataFrame | None,
                   valid_customers: DataFrame, customer_rows: int | None = None) -> DataFrame:
    """Typed, accepted-type, de-duplicated loyalty events of known customers."""
    batch = event_type_in(type_table(well_formed(batch_bronze), "loyalty_events"))
    if realtime_bronze is not None:
        rt = event_type_in(type_table(well_formed(realtime_bronze), "loyalty_events"))
        events = union_feeds(batch, rt)
    else:
        events = dedupe(batch, ["event_id"])
    return integrity_filter(events, valid_customers, "customer_id", key_rows=customer_rows)


def drop_stamps(df: DataFrame) -> DataFrame:
    """Remove clock-valued bookkeeping columns before comparing results."""
    stamps = set(INGEST_STAMPS) | {"_cleansed_ts", "_eventstream_ingested_ts", "_scd_ts", "_batch"}
    return df.drop(*[c for c in df.columns if c in stamps])
