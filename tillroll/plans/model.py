"""Filter context over a star model: relationships, paths, one-directional propagation.

A model holds tables and many-to-one relationships. A measure belongs to one
fact. It is evaluated under a filter context: grouping columns and filters
that may sit on any table, written ``table.column``.

* A filter goes from the one side of a relationship to the many side, along
  every step of the path, never back: a filter on dim_date limits fact_sales,
  a filter on fact_sales does not limit dim_date nor what hangs on it. A
  filter on a table with no path to the measure's fact leaves the measure as
  it is, like a report filter on an unrelated table does.
* Grouping by a column of the one side joins that column to the fact. The
  key of a relationship need not be unique on the one side (a month in a
  table of days); then only the columns that the key determines may group,
  and a filter on a finer column passes on the keys it leaves.
* Fact rows without a partner group under NULL (the blank member), so totals
  reconcile; a filter on the one side removes them.
* Two paths between the same tables are ambiguous and raise, as do unknown
  tables and columns, and grouping by a table with no path.
* A prior-year measure is evaluated twice under the same context: as it is,
  and with the fact moved twelve months on; both sides meet on the groups.
  Only months of the date table count.

Filters become left semi joins of distinct keys and group columns left joins
of distinct (key, columns) rows, so no relationship can fan a fact out. The
fact is aggregated once per measure set; a date table has a row a day, and
the planner broadcasts it under its measured size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import month_start, safe_divide
from tillroll.plans.semantic import PERSPECTIVES, _sum


class ModelError(ValueError):
    """The model has no single meaning for what was asked."""


@dataclass(frozen=True)
class Relationship:
    """``many.column`` -> ``one.column``; filters go from ``one`` to ``many``.

    ``determines`` lists the columns of the one side that its column fixes;
    None: the column is unique there and fixes all.
    """
    many: str
    many_col: str
    one: str
    one_col: str
    determines: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Measure:
    """A value over the aggregates of one fact; ``prior_year`` names its period column."""
    fact: str
    value: Callable[[], Column]
    prior_year: str | None = None


def _ratio(num: str, den: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: safe_divide(_sum(num), den())


MEASURES = {
    "total_revenue": Measure("fact_sales", lambda: _sum("revenue")),
    "gross_margin_pct": Measure("fact_sales", _ratio("gross_margin", lambda: _sum("revenue"))),
    "revenue_per_transaction": Measure("fact_sales", _ratio("revenue", lambda: _sum("transactions").cast("double"))),
    "yoy_revenue_growth": Measure("fact_sales", lambda: _sum("revenue"), prior_year="month"),
    "avg_revenue_per_store": Measure("fact_store_performance",
                                     _ratio("revenue", lambda: F.count("revenue").cast("double"))),
    "revenue_per_customer": Measure("fact_loyalty_tier_value",
                                    _ratio("revenue", lambda: _sum("customers").cast("double"))),
}

# The fact's months meet the date table at month grain.
SALES_TO_DATE = Relationship("fact_sales", "month", "dim_date", "month",
                             ("month", "year", "quarter", "month_name"))


@dataclass
class Model:
    tables: dict[str, DataFrame]
    relationships: list[Relationship] = field(default_factory=lambda: [SALES_TO_DATE])
    measures: dict[str, Measure] = field(default_factory=lambda: dict(MEASURES))

    def view(self, perspective: str) -> Model:
        """H9: the model with a perspective's tables only."""
        seen = set(PERSPECTIVES[perspective])
        return Model({n: t for n, t in self.tables.items() if n in seen},
                     [r for r in self.relationships if {r.many, r.one} <= seen],
                     {n: m for n, m in self.measures.items() if m.fact in seen})

    def _column(self, name: str) -> tuple[str, str]:
        table, _, column = name.partition(".")
        if table not in self.tables or column not in self.tables[table].columns:
            raise ModelError(f"unknown column {name}")
        return table, column

    def path(self, fact: str, table: str) -> list[Relationship] | None:
        """The relationships from a fact up to a table; None when there is no path."""
        found: list[list[Relationship]] = []

        def walk(at: str, steps: list[Relationship]) -> None:
            if at == table:
                found.append(steps)
                return
            for r in self.relationships:
                if r.many == at and r.one in self.tables and r not in steps:
                    walk(r.one, [*steps, r])

        walk(fact, [])
        if len(found) > 1:
            raise ModelError(f"{len(found)} paths from {fact} to {table}")
        return found[0] if found else None

    def _filtered(self, fact: str, rows: DataFrame, where: dict[str, Callable[[Column], Column]]) -> DataFrame:
        """The fact's rows under every filter that reaches it."""
        for name, test in where.items():
            table, column = self._column(name)
            steps = self.path(fact, table)
            if steps is None:
                continue
            if not steps:
                rows = rows.filter(test(F.col(column)))
                continue
            kept = self.tables[table].filter(test(F.col(column)))
            for i in range(len(steps) - 1, -1, -1):
                keys = kept.select(F.col(steps[i].one_col).alias(steps[i].many_col)).distinct()
                below = rows if i == 0 else self.tables[steps[i].many]
                kept = below.join(keys, steps[i].many_col, "left_semi")
            rows = kept
        return rows

    def _grouped(self, fact: str, rows: DataFrame, by: list[str]) -> DataFrame:
        """The fact's rows with each grouping column under its full name."""
        wanted: dict[str, list[str]] = {}
        for name in by:
            table, column = self._column(name)
            wanted.setdefault(table, []).append(column)
        for table, columns in wanted.items():
            steps = self.path(fact, table)
            if steps is None:
                raise ModelError(f"{fact} has no path to {table}: its measures cannot be grouped by it")
            if not steps:
                rows = rows.withColumns({f"{table}.{c}": F.col(c) for c in columns})
                continue
            last = steps[-1]
            loose = [c for c in columns if last.determines is not None and c not in last.determines]
            if loose:
                raise ModelError(f"{last.one_col} does not determine {loose} in {table}")
            members = self.tables[table].select(F.col(last.one_col).alias("_key"), *[
                F.col(c).alias(f"{table}.{c}") for c in columns]).distinct()
            for step, before in zip(reversed(steps), [*reversed(steps[:-1]), None]):
                if before is not None:  # carry the columns down one table
                    below = self.tables[step.many].select(F.col(before.one_col).alias("_next"),
                                                          F.col(step.many_col).alias("_key")).distinct()
                    members = below.join(members, "_key", "left").drop("_key").withColumnRenamed("_next", "_key")
            first = steps[0]
            rows = rows.join(members.filter(F.col("_key").isNotNull()), rows[first.many_col] == F.col("_key"),
                             "left").drop("_key")
        return rows

    def _value(self, fact: str, rows: DataFrame, names: list[str], by: list[str], where) -> DataFrame:
        rows = self._grouped(fact, self._filtered(fact, rows, where), by)
        return rows.groupBy(*[f"`{c}`" for c in by]).agg(*[self.measures[n].value().alias(n) for n in names])

    def _prior_year(self, name: str, by: list[str], where) -> DataFrame:
        """(groups, current and prior revenue, growth): periods without current revenue count as 0."""
        m = self.measures[name]
        fact = self.tables[m.fact]
        step = next((r for r in self.relationships if r.many == m.fact and r.many_col == m.prior_year), None)
        if step is None or step.one not in self.tables:
            raise ModelError(f"{name} needs a date table")
        periods = self.tables[step.one].select(F.col(step.one_col).alias(m.prior_year)).distinct()
        moved = fact.withColumn(m.prior_year, F.date_format(F.add_months(month_start(m.prior_year), 12), "yyyy-MM"))
        sides = [self._value(m.fact, side.join(periods, m.prior_year, "left_semi"), [name], by, where)
                 for side in (fact, moved)]
        current = F.lit(None).cast("double")
        both = sides[0].withColumnRenamed(name, "_cur").withColumn("_prior", current) \
            .unionByName(sides[1].withColumnRenamed(name, "_prior").withColumn("_cur", current))
        # one row a side and group: max picks the one value there is
        both = both.groupBy(*[f"`{c}`" for c in by]).agg(F.max("_cur").alias("_cur"), F.max("_prior").alias("_prior"))
        cur = F.coalesce("_cur", F.lit(0.0))
        return both.select(*[F.col(f"`{c}`") for c in by], cur.alias("revenue"), F.col("_prior").alias(
            "prior_year_revenue"), safe_divide(cur - F.col("_prior"), F.col("_prior")).alias(name))

    def evaluate(self, names: list[str], by: list[str] | None = None,
                 where: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
        """Measures side by side under one filter context; one row per group, columns named by ``table.column``.

        Measures of one fact share one aggregate. Measures of several facts
        meet on the groups (a group without rows in one fact has NULL there).
        """
        by, where = list(by or []), dict(where or {})
        for name in [*by, *where]:
            self._column(name)
        unknown = [n for n in names if n not in self.measures]
        if unknown:
            raise ModelError(f"unknown measures {unknown}")
        parts = [self._prior_year(n, by, where) for n in names if self.measures[n].prior_year]
        facts: dict[str, list[str]] = {}
        for n in names:
            if not self.measures[n].prior_year:
                facts.setdefault(self.measures[n].fact, []).append(n)
        parts += [self._value(fact, self.tables[fact], own, by, where) for fact, own in facts.items()]
        out = parts[0]
        for part in parts[1:]:
            if not by:
                out = out.withColumn("_one", F.lit(1)).join(part.withColumn("_one", F.lit(1)), "_one").drop("_one")
                continue
            side = part.withColumnsRenamed({c: f"_r.{c}" for c in by})
            same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_r.{c}`")) for c in by]
            met = out.join(side, same, "full_outer")
            rest = [F.col(f"`{c}`") for c in [*out.columns, *part.columns] if c not in by]
            out = met.select(*[F.coalesce(F.col(f"`{c}`"), F.col(f"`_r.{c}`")).alias(c) for c in by], *rest)
        return out
