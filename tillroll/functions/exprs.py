"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def coerce_number(c: ColumnOrName, to: str = "int") -> Column:
    """Lenient numeric cast: junk becomes NULL instead of failing the job.

    Text goes through DOUBLE, so that '2.0' and '2.7' become 2 like a numeric
    coercion would, while 'abc' or an out-of-range value is NULL. A double
    holds every INT exactly; for wider types a whole number is cast directly,
    so that every digit of a large one counts. The direct cast is only tried
    on text of that form: a failing cast costs an exception per row.
    """
    through_double = _c(c).try_cast("double").try_cast(to)
    if to in ("tinyint", "smallint", "int"):
        return through_double
    return F.when(_c(c).cast("string").rlike(WHOLE_NUMBER), _c(c).try_cast(to)).otherwise(through_double)


def coerce_decimal(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    return _c(c).try_cast(f"decimal({precision},{scale})")


def coerce_date(c: ColumnOrName) -> Column:
    return _c(c).try_cast("date")


def coerce_bool(c: ColumnOrName) -> Column:
    return _c(c).try_cast("boolean")


def present(c: ColumnOrName) -> Column:
    """Key is usable: not NULL and not the empty string."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))


def positive(c: ColumnOrName) -> Column:
    """Strictly positive; NULL fails (filter drops NULL predicates)."""
    return _c(c) > 0


def gross_margin(amount: ColumnOrName, cost_pct: ColumnOrName) -> Column:
    """round(amount * (1 - cost_pct), 2) with decimal arithmetic, half-up."""
    return F.round(_c(amount) * (F.lit(1) - _c(cost_pct)), 2)


def month_key(d: ColumnOrName) -> Column:
    """Calendar month as 'yyyy-MM'."""
    return F.date_format(_c(d), "yyyy-MM")


def month_start(month: ColumnOrName) -> Column:
    """First day of a 'yyyy-MM' month key."""
    return F.to_date(F.concat(_c(month), F.lit("-01")))


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """DIVIDE semantics: NULL when the denominator is zero or NULL."""
    return F.try_divide(_c(num), _c(den))


def path_segment(uri: ColumnOrName, index: int) -> Column:
    """Zero-based segment of a '/'-split path; '' when out of range."""
    return F.coalesce(F.get(F.split(_c(uri), "/"), F.lit(index)), F.lit(""))


def as_money(c: ColumnOrName) -> Column:
    """Sum of decimals reported as double (cast last, after exact sums)."""
    return _c(c).cast("double")


def all_present(cols: list[str]) -> Column:
    """Row has a non-NULL value in every listed column."""
    cond = F.lit(True)
    for name in cols:
        cond = cond & F.col(name).isNotNull()
    return cond
