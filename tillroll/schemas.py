"""Fixed schemas per table and layer.

Bronze keeps every source column as text (plus ingest stamps); Silver is
fully typed; Gold is what the aggregates produce and what the semantic model
reads.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


# Raw / landing columns, as the source extracts deliver them.
RAW_COLUMNS = {
    "customers": ["customer_id", "region", "loyalty_tier", "signup_date", "email_opt_in"],
    "products": ["product_id", "category", "unit_price", "cost_price_pct"],
    "stores": ["store_id", "region", "store_format"],
    "transactions": [
        "transaction_id", "customer_id", "product_id", "store_id",
        "transaction_date", "quantity", "amount", "payment_method",
    ],
    "loyalty_events": ["event_id", "customer_id", "event_date", "event_type", "points"],
}

TABLES = list(RAW_COLUMNS)

# The schema registry replaces schema inference for every file source:
# file streams need one, and inference would cost a full extra pass.
RAW_SCHEMAS = {name: _strings(*cols) for name, cols in RAW_COLUMNS.items()}

INGEST_STAMPS = ["_ingested_ts", "_source_file"]

# Lines of a landing file that do not fit its columns are kept here, whole.
CORRUPT = "_corrupt_record"

SILVER_TYPES = {
    "customers": {
        "customer_id": "string", "region": "string", "loyalty_tier": "string",
        "signup_date": "date", "email_opt_in": "boolean",
    },
    "products": {
        "product_id": "string", "category": "string",
        "unit_price": "decimal(18,2)", "cost_price_pct": "decimal(4,3)",
    },
    "stores": {"store_id": "string", "region": "string", "store_format": "string"},
    "transactions": {
        "transaction_id": "string", "customer_id": "string", "product_id": "string",
        "store_id": "string", "transaction_date": "date", "quantity": "int",
        "amount": "decimal(18,2)", "payment_method": "string",
    },
    "loyalty_events": {
        "event_id": "string", "customer_id": "string", "event_date": "date",
        "event_type": "string", "points": "bigint",
    },
}

SCD2_COLUMNS = ["effective_from", "effective_to", "is_current"]

DQ_RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", S, False),
    T.StructField("table", S, False),
    T.StructField("status", S, False),
    T.StructField("metric_value", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("detail", S, True),
    T.StructField("run_ts", T.TimestampType(), True),
])

GOLD_COLUMNS = {
    "sales_by_region_category_month": [
        ("month", "string"), ("region", "string"), ("category", "string"),
        ("revenue", "double"), ("units", "bigint"), ("gross_margin", "double"),
        ("transactions", "bigint"),
    ],
    "loyalty_tier_value": [
        ("loyalty_tier", "string"), ("customers", "bigint"), ("revenue", "double"),
        ("avg_basket", "double"),
    ],
    "store_performance": [
        ("store_id", "string"), ("store_format", "string"), ("region", "string"),
        ("revenue", "double"), ("gross_margin", "double"), ("transactions", "bigint"),
    ],
    "loyalty_points_liability": [("event_type", "string"), ("points", "bigint")],
}

# Operations log tables (the log service names them; we type them).
LOG_SCHEMAS = {
    "ADFPipelineRun": "TimeGenerated timestamp_ntz, PipelineName string, Status string, "
                      "Start timestamp_ntz, End timestamp_ntz",
    "ADFActivityRun": "TimeGenerated timestamp_ntz, PipelineName string, ActivityName string, "
                      "Status string",
    "DatabricksJobs": "TimeGenerated timestamp_ntz, JobName string, DurationMinutes double",
    "StorageBlobLogs": "TimeGenerated timestamp_ntz, Uri string, ResponseBodySize bigint",
    "AzureMetrics": "TimeGenerated timestamp_ntz, ResourceProvider string, MetricName string, "
                    "Total double",
    "ObjectInventory": "path string, modified timestamp_ntz, size_gb double, is_version boolean",
}
