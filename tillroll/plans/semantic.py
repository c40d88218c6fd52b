"""Semantic model over Gold: facts, date dimension, measures, perspectives.

A measure is a function of a fact DataFrame and any list of grouping
columns (its filter context). Money columns are re-summed as decimals so a
measure is exact whatever the partitioning; ratios divide once, in double,
and are NULL on a zero or NULL denominator (DIVIDE semantics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import month_start, safe_divide

# Fact name -> Gold table.
FACT_TABLES = {
    "fact_sales": "sales_by_region_category_month",
    "fact_store_performance": "store_performance",
    "fact_loyalty_tier_value": "loyalty_tier_value",
}

# Columns whose default aggregation is sum.
DEFAULT_SUM = {
    "fact_sales": ["revenue", "units", "gross_margin", "transactions"],
    "fact_store_performance": ["revenue", "gross_margin"],
    "fact_loyalty_tier_value": ["customers", "revenue"],
}

# H9: audience perspectives -> tables in view.
PERSPECTIVES = {
    "ExecutiveSummary": ["fact_sales", "fact_loyalty_tier_value"],
    "StoreOperations": ["fact_store_performance", "dim_date"],
}

MONEY = {"revenue", "gross_margin"}


def _sum(col: str) -> Column:
    if col in MONEY:
        return F.sum(F.col(col).cast("decimal(38,2)")).cast("double")
    return F.sum(col).cast("bigint")


def _agg(fact: DataFrame, by: list[str] | None, *aggs: Column) -> DataFrame:
    return fact.groupBy(*(by or [])).agg(*aggs)


def default_summary(fact: DataFrame, fact_name: str, by: list[str] | None = None) -> DataFrame:
    """Every summable column of a fact, summed under ``by``."""
    return _agg(fact, by, *[_sum(c).alias(c) for c in DEFAULT_SUM[fact_name]])


def total_revenue(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H1: SUM(revenue)."""
    return _agg(fact, by, _sum("revenue").alias("total_revenue"))


def gross_margin_pct(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H2: SUM(gross_margin) / SUM(revenue), a ratio of sums."""
    return _agg(fact, by, safe_divide(_sum("gross_margin"), _sum("revenue")).alias("gross_margin_pct"))


def revenue_per_transaction(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H3: SUM(revenue) / SUM(transactions)."""
    return _agg(fact, by, safe_divide(_sum("revenue"), _sum("transactions").cast("double"))
                .alias("revenue_per_transaction"))


def avg_revenue_per_store(store_perf: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H5: AVERAGE(revenue) over stores."""
    return _agg(store_perf, by, safe_divide(_sum("revenue"), F.count("revenue").cast("double"))
                .alias("avg_revenue_per_store"))


def revenue_per_customer(tier_value: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H6: SUM(revenue) / SUM(customers)."""
    return _agg(tier_value, by, safe_divide(_sum("revenue"), _sum("customers").cast("double"))
                .alias("revenue_per_customer"))


def dim_date(dates: DataFrame, col: str = "transaction_date") -> DataFrame:
    """H7: one row per calendar day between the first and last fact date.

    The range comes from one min/max aggregate; the day rows are generated
    by ``explode(sequence(...))`` (a few thousand rows for decades of data).
    Columns: date, year, quarter ('Q1'..), month_name ('January'..) and
    month ('yyyy-MM', the fact's grain; D15).
    """
    bounds = dates.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    return dim_date_between(bounds)


def dim_date_between(bounds: DataFrame) -> DataFrame:
    """H7 from a one-row frame of first (``lo``) and last (``hi``) dates."""
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        "date",
        F.year("date").cast("bigint").alias("year"),
        F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("quarter"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "yyyy-MM").alias("month"),
    )


def month_grain(dates: DataFrame) -> DataFrame:
    """dim_date projected to one row per month (the fact's grain, J10)."""
    return dates.select("month", "year", "quarter", "month_name").distinct()


def dim_date_of_months(fact: DataFrame) -> DataFrame:
    """H7 from a fact's own months: whole months from its first to its last."""
    first = month_start("month")
    return dim_date_between(fact.agg(F.min(first).alias("lo"), F.last_day(F.max(first)).alias("hi")))


def yoy_revenue_growth(fact: DataFrame, dates: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H4: (current - same period last year) / same period last year, per month.

    Every month's revenue counts for its own month and, as the prior year's,
    for the month twelve months on (not a lag, which breaks on gaps); one
    aggregate brings the two together. Months that only have prior revenue
    (growth -1) and months without a prior (NULL) stay; months outside the
    date dimension are dropped.
    """
    by = list(by or [])
    kind = "decimal(38,2)"
    none = F.lit(None).cast(kind)
    later = F.date_format(F.add_months(month_start("month"), 12), "yyyy-MM")
    sides = F.array(F.struct(F.col("month").alias("month"), F.col("rev").alias("cur"), none.alias("prior")),
                    F.struct(later.alias("month"), none.alias("cur"), F.col("rev").alias("prior")))
    both = (fact.select("month", *by, F.col("revenue").cast(kind).alias("rev"))
            .select(*by, F.explode(sides).alias("side")).select("side.*", *by)
            .groupBy("month", *by).agg(F.sum("cur").alias("cur"), F.sum("prior").alias("prior")))
    j = both.join(month_grain(dates).select("month"), "month", "left_semi")
    c = F.coalesce(F.col("cur"), F.lit(0)).cast("double")
    p = F.col("prior").cast("double")
    return j.select("month", *by,
                    c.alias("revenue"), p.alias("prior_year_revenue"),
                    safe_divide(c - p, p).alias("yoy_revenue_growth"))


def calendar_rollup(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """H8: revenue down the Year > Quarter > Month drill path.

    ``level`` is the grouping id: 0 month rows, 1 quarter subtotals,
    3 year subtotals, 7 the grand total. Revenue without a month in the date
    dimension stays under the NULL calendar member, so totals reconcile.
    """
    j = fact.join(month_grain(dates), "month", "left")
    return (j.rollup("year", "quarter", "month")
             .agg(F.sum(F.col("revenue").cast("decimal(38,2)")).cast("double").alias("revenue"),
                  F.grouping_id().cast("bigint").alias("level")))


def executive_summary(sales: DataFrame, tiers: DataFrame) -> DataFrame:
    """H9 ExecutiveSummary: the headline measures as (measure, value) rows."""
    s = sales.agg(_sum("revenue").alias("rev"), _sum("gross_margin").alias("gm"),
                  _sum("transactions").alias("tx"))
    t = tiers.agg(_sum("revenue").alias("rev"), _sum("customers").alias("cust"))

    def measure(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("measure"), value.alias("value"))

    # one aggregate per fact, each giving its measures as rows
    of_sales = F.array(measure("Total Revenue", F.col("rev")), measure("Gross Margin %", safe_divide("gm", "rev")),
                       measure("Revenue per Transaction", safe_divide(F.col("rev"), F.col("tx").cast("double"))))
    of_tiers = F.array(measure("Revenue per Loyalty Customer",
                               safe_divide(F.col("rev"), F.col("cust").cast("double"))))
    return s.select(F.explode(of_sales).alias("m")).select("m.*") \
        .unionByName(t.select(F.explode(of_tiers).alias("m")).select("m.*"))


def store_operations(store_perf: DataFrame) -> DataFrame:
    """H9 StoreOperations: store measures per region and format."""
    return store_perf.groupBy("region", "store_format").agg(
        F.count(F.lit(1)).alias("stores"),
        _sum("revenue").alias("revenue"),
        safe_divide(_sum("revenue"), F.count("revenue").cast("double")).alias("avg_revenue_per_store"),
        safe_divide(_sum("gross_margin"), _sum("revenue")).alias("gross_margin_pct"),
    )


def register_views(spark, facts: dict[str, DataFrame], dates: DataFrame | None = None,
                   perspective: str | None = None) -> list[str]:
    """Publish facts (and dim_date) as temp views, optionally only a
    perspective's tables. Views are zero-copy: they read the Gold data."""
    tables = dict(facts)
    if dates is not None:
        tables["dim_date"] = dates
    names = PERSPECTIVES[perspective] if perspective else list(tables)
    for n in names:
        if n in tables:
            tables[n].createOrReplaceTempView(n)
    return [n for n in names if n in tables]
