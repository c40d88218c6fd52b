"""Data-quality checks, suite and gate.

A check result is one row: check_name, table, status, metric_value,
threshold, detail, run_ts. Shared rules: an empty table scores 0 and fails;
the status compares the unrounded score with ``>=``; the stored metric is
rounded to 4 places. Freshness counts whole days from the newest date to
``as_of`` and passes when that is ``<= max_age_days``.

The texts of ``detail`` are fixed values: reports and alerts match on them.

All checks on one table are evaluated by a single aggregate over it (one
scan), plus one left join per referential-integrity check against the
*distinct* parent keys, so a repeating parent key cannot fan rows out. The
parent keys stay a DataFrame; nothing is collected to the driver except the
final result rows (one per check) when the gate is enforced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import all_present
from tillroll.functions.joins import bounded_broadcast


class DQGateError(RuntimeError):
    """Raised by ``enforce`` when any check failed."""


@dataclass
class Check:
    kind: str                      # completeness | uniqueness | referential_integrity | freshness
    threshold: float
    columns: list[str] = field(default_factory=list)
    key: str | None = None
    valid_keys: DataFrame | None = None
    valid_key_col: str | None = None
    date_col: str | None = None
    key_rows: int | None = None    # proven bound on parent-key rows, if known


def completeness(columns: list[str], threshold: float = 0.98) -> Check:
    return Check("completeness", threshold, columns=list(columns))


def uniqueness(key: str, threshold: float = 0.999) -> Check:
    return Check("uniqueness", threshold, key=key)


def referential_integrity(fk: str, valid_keys: DataFrame, threshold: float = 0.99,
                          valid_key_col: str | None = None, key_rows: int | None = None) -> Check:
    return Check("referential_integrity", threshold, key=fk, valid_keys=valid_keys,
                 valid_key_col=valid_key_col or fk, key_rows=key_rows)


def freshness(date_col: str, max_age_days: int = 7) -> Check:
    return Check("freshness", float(max_age_days), date_col=date_col)


def _num(c: Column) -> Column:
    return F.format_number(c, 0)


def _ratio_row(name: str, table: str, num: Column, den: Column, threshold: float,
               detail_tail: str) -> Column:
    score = F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(table).alias("table"),
        F.when(score >= F.lit(threshold), "PASS").otherwise("FAIL").alias("status"),
        F.round(score, 4).alias("metric_value"),
        F.lit(float(threshold)).alias("threshold"),
        F.concat(_num(num), F.lit("/"), _num(den), F.lit(detail_tail)).alias("detail"),
    )


def evaluate(df: DataFrame, table: str, checks: list[Check], as_of=None) -> DataFrame:
    """Evaluate several checks on one table in one pass; one row per check.

    Each metric is (name, expression, roll-up): counts roll up by sum, the
    newest date by max, a uniqueness check is a distinct count of its key.
    With exactly one uniqueness key the table is aggregated per key first
    and the other metrics rolled up from there, which gives the same numbers
    as one DISTINCT aggregate without the Expand that doubles every row.
    """
    base = df
    specs: list[tuple[str, Column | None, str]] = [("_total", F.count(F.lit(1)), "sum")]
    rows = []
    total = F.col("_total")
    distinct_keys = []
    for i, c in enumerate(checks):
        m = f"_m{i}"
        if c.kind == "completeness":
            specs.append((m, F.count_if(all_present(c.columns)), "sum"))
            tail = f" rows complete across {[str(x) for x in c.columns]}"
            rows.append(_ratio_row("completeness", table, F.col(m), total, c.threshold, tail))
        elif c.kind == "uniqueness":
            specs.append((m, None, "distinct:" + c.key))
            distinct_keys.append(c.key)
            tail = f" unique values for {c.key}"
            rows.append(_ratio_row("uniqueness", table, F.col(m), total, c.threshold, tail))
        elif c.kind == "referential_integrity":
            flag = f"_ok{i}"
            keys = bounded_broadcast(c.valid_keys.select(F.col(c.valid_key_col).alias(f"_vk{i}"))
                                     .distinct().withColumn(flag, F.lit(True)), c.key_rows)
            base = base.join(keys, base[c.key] == keys[f"_vk{i}"], "left").drop(f"_vk{i}")
            specs.append((m, F.count_if(F.col(flag)), "sum"))
            tail = f" rows have a valid {c.key} reference"
            rows.append(_ratio_row("referential_integrity", table, F.col(m), total,
                                   c.threshold, tail))
        elif c.kind == "freshness":
            specs.append((m, F.max(F.to_date(F.col(c.date_col))), "max"))
            age = F.datediff(F.lit(str(as_of)).cast("date"), F.col(m))
            max_age = int(c.threshold)
            rows.append(F.struct(
                F.lit("freshness").alias("check_name"), F.lit(table).alias("table"),
                F.when(age.isNotNull() & (age <= max_age), "PASS").otherwise("FAIL").alias("status"),
                age.cast("double").alias("metric_value"),
                F.lit(float(max_age)).alias("threshold"),
                F.when(total == 0, F.lit("Table is empty"))
                 .when(age.isNull(), F.lit("No dated records"))
                 .otherwise(F.concat(F.lit("Latest record is "), age.cast("string"),
                                     F.lit(f" days old (max allowed: {max_age})"))).alias("detail"),
            ))
        else:
            raise ValueError(f"unknown check kind {c.kind}")

    if len(set(distinct_keys)) == 1:
        key = distinct_keys[0]
        per_key = base.groupBy(key).agg(*[e.alias(n) for n, e, _ in specs if e is not None])
        # a sum over no rows is NULL; counts of an empty table must be 0
        rollup = {"sum": lambda n: F.coalesce(F.sum(n), F.lit(0)), "max": F.max}
        agg = per_key.agg(*[(F.count(F.col(key)) if how.startswith("distinct:") else rollup[how](n)).alias(n)
                            for n, _, how in specs])
    else:
        agg = base.agg(*[(F.count_distinct(how.split(":", 1)[1]) if how.startswith("distinct:") else e).alias(n)
                         for n, e, how in specs])
    return (agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
               .withColumn("run_ts", F.current_timestamp()))


def check_completeness(df, table, required_cols, threshold=0.98):
    """Q1."""
    return evaluate(df, table, [completeness(required_cols, threshold)])


def check_uniqueness(df, table, key_col, threshold=0.999):
    """Q2."""
    return evaluate(df, table, [uniqueness(key_col, threshold)])


def check_referential_integrity(df, table, fk_col, valid_keys, threshold=0.99, valid_key_col=None):
    """Q3."""
    return evaluate(df, table, [referential_integrity(fk_col, valid_keys, threshold, valid_key_col)])


def check_freshness(df, table, date_col, max_age_days=7, as_of=None):
    """Q4."""
    return evaluate(df, table, [freshness(date_col, max_age_days)], as_of=as_of)


def check_pass_rate(accounting: DataFrame, table: str, threshold: float = 0.95) -> DataFrame:
    """Q9: clean/total pass rate of a cleanse (from silver.reject_accounting)."""
    score = F.col("pass_rate")
    return accounting.select(
        F.lit("pass_rate").alias("check_name"), F.lit(table).alias("table"),
        F.when(score >= F.lit(threshold), "PASS").otherwise("FAIL").alias("status"),
        F.round(score, 4).alias("metric_value"), F.lit(float(threshold)).alias("threshold"),
        F.concat(_num(F.col("clean")), F.lit(" clean / "), _num(F.col("total")),
                 F.lit(" total ("), _num(F.col("rejected")), F.lit(" rejected)")).alias("detail"),
        F.current_timestamp().alias("run_ts"),
    )


def run_suite(results: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Q6: all result rows, and the failed ones."""
    all_rows = reduce(lambda a, b: a.unionByName(b), results)
    return all_rows, all_rows.filter(F.col("status") == "FAIL")


def enforce(results: DataFrame) -> DataFrame:
    """Q8: raise when any check failed; otherwise return the results.

    Only the failed result rows (one per check, a bounded handful) reach
    the driver.
    """
    failed = results.filter(F.col("status") == "FAIL").select(
        "table", "check_name", "metric_value", "threshold", "detail").collect()
    if failed:
        lines = [f"{r['table']}.{r['check_name']}: {r['metric_value']} "
                 f"(threshold {r['threshold']}) {r['detail']}" for r in failed]
        raise DQGateError(f"{len(failed)} data-quality check(s) failed:\n" + "\n".join(lines))
    return results


def store_results(results: DataFrame, path: str, run_as_of: str, run_id: str) -> DataFrame:
    """Append one run's check results to the results table; returns them as stored.

    They are written before anything is enforced, so a failed run leaves its evidence.
    """
    (results.withColumn("run_as_of", F.lit(run_as_of)).withColumn("run_id", F.lit(run_id))
     .write.mode("append").parquet(path))
    return results.sparkSession.read.parquet(path).filter(F.col("run_id") == run_id)


def gate_history(stored: DataFrame) -> DataFrame:
    """Q8 over the results table: per run its checks, its failed checks, and whether the gate stopped it."""
    failed = F.count(F.when(F.col("status") == "FAIL", 1))
    return stored.groupBy("run_id", "run_as_of").agg(
        F.count(F.lit(1)).alias("checks"), failed.alias("failed"), (failed > 0).alias("blocked"))


def assert_pass_rate(accounting: DataFrame, table: str, threshold: float = 0.95) -> None:
    """Q9 as an assertion before a Silver write."""
    enforce(check_pass_rate(accounting, table, threshold))


def silver_suite(transactions: DataFrame, dim_customer: DataFrame, loyalty: DataFrame,
                 as_of, freshness_days: int = 3650, customer_rows: int | None = None) -> DataFrame:
    """Q7: the six checks bound to Silver, with the reference thresholds.

    Uniqueness of the customer key is tested on current rows only (D13).
    """
    current = dim_customer.filter(F.col("is_current"))
    valid = current.select("customer_id")
    txn = evaluate(transactions, "transactions", [
        completeness(["customer_id", "product_id", "amount"]),
        uniqueness("transaction_id"),
        referential_integrity("customer_id", valid, key_rows=customer_rows),
        freshness("transaction_date", freshness_days),
    ], as_of=as_of)
    cust = evaluate(current, "dim_customer", [uniqueness("customer_id")])
    loy = evaluate(loyalty, "loyalty_events",
                   [referential_integrity("customer_id", valid, key_rows=customer_rows)])
    return run_suite([txn, cust, loy])[0]


def landing_row_counts(tables: dict[str, DataFrame], minimums: dict[str, int] | None = None,
                       default_minimum: int = 1) -> DataFrame:
    """Row count per landing table against its minimum.

    One count aggregate per table, unioned; ``status`` is FAIL under the
    minimum. Use ``enforce_landing`` to stop the run.
    """
    minimums = minimums or {}
    parts = []
    for name, df in tables.items():
        lo = int(minimums.get(name, default_minimum))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.col("rows"), F.lit(lo).cast("bigint").alias("minimum"),
            F.when(F.col("rows") >= lo, "PASS").otherwise("FAIL").alias("status")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def enforce_landing(counts: DataFrame) -> list:
    """Raise when a table is below its minimum; returns the rows (one per table)."""
    rows = counts.collect()
    bad = [r for r in rows if r["status"] == "FAIL"]
    if bad:
        raise DQGateError("landing zone below minimum: " +
                          ", ".join(f"{r['table']}={r['rows']}<{r['minimum']}" for r in bad))
    return rows
