"""Gold: the enriched fact and the business aggregates.

Money is summed as decimal and cast to double last, so totals are exact and
reconcile across tables. Group keys that a left join left NULL are kept as a
NULL group, so revenue always adds up to the fact total.

Join strategy: the dimensions are joined without hints. At the sizes of a
retail dimension the planner's size check picks a broadcast hash join; if a
dimension outgrows the broadcast threshold the same plan becomes a
shuffle join and AQE splits skewed fact partitions (a store that holds a
third of all sales), so nothing is collected into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.exprs import as_money, gross_margin, month_key
from tillroll.functions.joins import bounded_broadcast


# Which dimension gives which column of the enriched fact.
ENRICHED_FROM = {
    "products": ("product_id", ["category", "cost_price_pct"]),
    "stores": ("store_id", ["region", "store_format"]),
    "customers": ("customer_id", ["loyalty_tier"]),
}
# Columns of the enriched fact that each aggregate reads beside the fact's own.
SALES_NEEDS = ["region", "category", "gross_margin", "month"]
STORE_NEEDS = ["region", "store_format", "gross_margin"]
TIER_NEEDS = ["loyalty_tier"]


def enrich(txns: DataFrame, products: DataFrame, stores: DataFrame, customers: DataFrame,
           row_bounds: dict | None = None, need: list[str] | None = None) -> DataFrame:
    """J12 = J2 + J3 + J4 + P7 + P8.

    ``customers`` should be the current rows of the customer dimension.
    ``row_bounds`` may give a proven row bound per dimension ("products",
    "stores", "customers"); a dimension under the broadcast limit is then
    broadcast, otherwise the planner's own size check decides. ``need`` names
    the added columns that the caller reads (default: all): a dimension that
    yields none of them is not joined. The planner cannot drop such a left
    join itself, as it does not know that the dimension's key is unique.
    """
    rb = row_bounds or {}
    want = set(need) if need is not None else {"gross_margin", "month",
                                               *(c for _, cols in ENRICHED_FROM.values() for c in cols)}
    read = want | ({"cost_price_pct"} if "gross_margin" in want else set())
    out = txns
    for name, dim in (("products", products), ("stores", stores), ("customers", customers)):
        key, given = ENRICHED_FROM[name]
        cols = [c for c in given if c in read]
        if cols:
            out = out.join(bounded_broadcast(dim.select(key, *cols), rb.get(name)), key, "left")
    if "gross_margin" in want:
        out = out.withColumn("gross_margin", gross_margin("amount", "cost_price_pct"))
    if "month" in want:
        out = out.withColumn("month", month_key("transaction_date"))
    return out


def sales_by_region_category_month(enriched: DataFrame) -> DataFrame:
    """A1: revenue, units, margin and transactions by month, region, category."""
    return (enriched.groupBy("month", "region", "category")
            .agg(as_money(F.sum("amount")).alias("revenue"),
                 F.sum("quantity").cast("bigint").alias("units"),
                 as_money(F.sum("gross_margin")).alias("gross_margin"),
                 F.count("transaction_id").alias("transactions")))


def loyalty_tier_value(enriched: DataFrame) -> DataFrame:
    """A2: distinct customers, revenue and rounded mean basket per tier.

    Two plain aggregates instead of a DISTINCT aggregate: first per (tier,
    customer) with map-side combine, then per tier over one row per
    customer. Same result as count(DISTINCT customer_id), without the Expand
    that doubles every row before the shuffle; a hot customer collapses
    map-side in the first step.
    """
    per_customer = (enriched.groupBy("loyalty_tier", "customer_id")
                    .agg(F.sum("amount").alias("amount"), F.count("amount").alias("n")))
    mean = F.sum("amount") / F.sum("n")
    return (per_customer.groupBy("loyalty_tier")
            .agg(F.count("customer_id").alias("customers"),
                 as_money(F.sum("amount")).alias("revenue"),
                 as_money(F.round(mean, 2)).alias("avg_basket")))


def store_performance(enriched: DataFrame) -> DataFrame:
    """A3: revenue, margin and transactions per store.

    The table is unordered (D16); use ``leaderboard`` to read it ranked.
    """
    return (enriched.groupBy("store_id", "store_format", "region")
            .agg(as_money(F.sum("amount")).alias("revenue"),
                 as_money(F.sum("gross_margin")).alias("gross_margin"),
                 F.count("transaction_id").alias("transactions")))


def points_liability(loyalty: DataFrame) -> DataFrame:
    """A4: points by event type, as the reference codes it."""
    return loyalty.groupBy("event_type").agg(F.sum("points").cast("bigint").alias("points"))


def points_liability_net(loyalty: DataFrame) -> DataFrame:
    """Points by type plus the net outstanding total as a rollup row.

    ``is_total`` marks the net row (its event_type is NULL).
    """
    return (loyalty.rollup("event_type")
            .agg(F.sum("points").cast("bigint").alias("points"),
                 F.grouping("event_type").cast("boolean").alias("is_total")))


# One-pass Gold: all fact aggregates from a single scan of the enriched fact.
_SETS = {
    "sales": ["month", "region", "category"],
    "store": ["store_id", "store_format", "region"],
    "tier_customer": ["loyalty_tier", "customer_id"],
    "all": [],
}
_SET_COLS = ["month", "region", "category", "store_id", "store_format", "loyalty_tier", "customer_id"]


def _gid(grain: str) -> int:
    """grouping_id of a grain: bit set for every column *not* grouped."""
    cols = _SETS[grain]
    gid = 0
    for c in _SET_COLS:
        gid = (gid << 1) | (0 if c in cols else 1)
    return gid


def gold_one_pass(enriched: DataFrame) -> DataFrame:
    """Every Gold aggregate of the fact in one pass (GROUPING SETS).

    One scan of the enriched fact, one Expand and a map-side partial
    aggregate, one small shuffle. ``grain`` tells the sets apart; split the
    result with ``from_one_pass``. The (tier, customer) set yields one row
    per customer so that distinct customers per tier is a count over it.
    No cache of the fact is needed, however large it is.
    """
    gid = F.grouping_id()
    grain = F.lit(None).cast("string")
    for name in _SETS:
        grain = F.when(gid == _gid(name), F.lit(name)).otherwise(grain)
    return (enriched.groupingSets([_SETS[n] for n in _SETS], *_SET_COLS)
            .agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("units"),
                 F.sum("gross_margin").alias("gross_margin"),
                 F.count("transaction_id").alias("transactions"),
                 F.count("amount").alias("n_amount"),
                 F.min("transaction_date").alias("first_date"),
                 F.max("transaction_date").alias("last_date"),
                 grain.alias("grain")))


def from_one_pass(agg: DataFrame, table: str) -> DataFrame:
    """One Gold table from the one-pass aggregate."""
    g = F.col("grain")
    if table == "sales_by_region_category_month":
        return agg.filter(g == "sales").select(
            "month", "region", "category", as_money(F.col("amount")).alias("revenue"),
            F.col("units").cast("bigint").alias("units"),
            as_money(F.col("gross_margin")).alias("gross_margin"), "transactions")
    if table == "store_performance":
        return agg.filter(g == "store").select(
            "store_id", "store_format", "region", as_money(F.col("amount")).alias("revenue"),
            as_money(F.col("gross_margin")).alias("gross_margin"), "transactions")
    if table == "loyalty_tier_value":
        mean = F.sum("amount") / F.sum("n_amount")
        return (agg.filter(g == "tier_customer").groupBy("loyalty_tier")
                .agg(F.count("customer_id").alias("customers"),
                     as_money(F.sum("amount")).alias("revenue"),
                     as_money(F.round(mean, 2)).alias("avg_basket")))
    if table == "date_range":
        return agg.filter(g == "all").select("first_date", "last_date")
    raise ValueError(table)


def leaderboard(store_perf: DataFrame) -> DataFrame:
    """O1: stores by revenue, highest first; ties by store_id."""
    return store_perf.orderBy(F.desc("revenue"), F.asc("store_id"))


def ranked_stores(store_perf: DataFrame) -> DataFrame:
    """O1 with the place as a column: one row per store, after aggregation."""
    place = F.row_number().over(Window.orderBy(F.desc("revenue"), F.asc("store_id")))
    return store_perf.select(place.cast("bigint").alias("place"), *store_perf.columns)


def top_stores(store_perf: DataFrame, n: int = 5) -> DataFrame:
    """O2: top-n stores by revenue (a TakeOrderedAndProject, no full sort)."""
    return leaderboard(store_perf).limit(n).select("store_id", "region", "revenue")
