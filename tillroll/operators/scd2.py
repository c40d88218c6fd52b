"""Type 2 slowly changing dimension, as pure DataFrame functions.

There is no MERGE here: the new dimension is rebuilt from the old one and
the staged snapshot by a single full outer join on the business key. Each
joined row emits up to two output rows (the old version, possibly closed,
and a new current version), so the whole merge is one shuffle per side.

Semantics (matching the two-step merge it replaces):
* a current row whose tracked attribute changed is closed:
  ``is_current = false``, ``effective_to = as_of``;
* changed and new keys get a new current row from ``as_of``;
* keys missing from the snapshot stay current (no deletes);
* untracked attributes never version or update an existing row;
* by default NULL to or from a value is not a change (``<>`` semantics);
  ``null_safe=True`` counts it as one.
Re-running the same snapshot changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCD_COLS = ["effective_from", "effective_to", "is_current"]


def _as_date(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def scd2_initial(staged: DataFrame, as_of) -> DataFrame:
    """First load, every row current and open-ended."""
    return (staged.withColumn("effective_from", _as_date(as_of))
                  .withColumn("effective_to", F.lit(None).cast("date"))
                  .withColumn("is_current", F.lit(True)))


def current_rows(dim: DataFrame) -> DataFrame:
    """P5 / C4: the current version of each key."""
    return dim.filter(F.col("is_current"))


def _changed(t: str, s: str, tracked: list[str], null_safe: bool) -> Column:
    parts = []
    for c in tracked:
        tc, sc = F.col(f"{t}.{c}"), F.col(f"{s}.{c}")
        parts.append(~tc.eqNullSafe(sc) if null_safe else F.coalesce(tc != sc, F.lit(False)))
    return reduce(lambda a, b: a | b, parts)


def scd2_merge(dim: DataFrame, staged: DataFrame, keys: list[str], tracked: list[str],
               as_of, null_safe: bool = False) -> DataFrame:
    """C2 + C3: close changed rows, insert new versions and new keys.

    ``staged`` must hold at most one row per key (see silver.latest_per_key)
    and the dimension's business columns.
    """
    as_of = _as_date(as_of)
    biz = [c for c in dim.columns if c not in SCD_COLS]
    history = dim.filter(~F.col("is_current"))
    cur = current_rows(dim).alias("t")
    stg = staged.select(*biz, F.lit(True).alias("_in_s")).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    j = cur.join(stg, cond, "full_outer")

    t_present = F.col("t.is_current").isNotNull()
    s_present = F.col("s._in_s").isNotNull()
    changed = t_present & s_present & _changed("t", "s", tracked, null_safe)

    old = F.struct(
        *[F.col(f"t.{c}").alias(c) for c in biz],
        F.col("t.effective_from").alias("effective_from"),
        F.when(changed, as_of).otherwise(F.col("t.effective_to")).alias("effective_to"),
        F.when(changed, F.lit(False)).otherwise(F.col("t.is_current")).alias("is_current"),
    )
    new = F.struct(
        *[F.col(f"s.{c}").alias(c) for c in biz],
        as_of.alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array(F.when(t_present, old), F.when(s_present & (~t_present | changed), new))
    merged = (j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
               .select("r.*"))
    return history.unionByName(merged.select(*dim.columns))


def new_or_changed(staged: DataFrame, dim: DataFrame, keys: list[str],
                   tracked: list[str], null_safe: bool = False) -> DataFrame:
    """Staged rows that need a new current version (left anti join).

    A staged row is dropped when the dimension has a current row for its
    key whose tracked attributes did not change.
    """
    cur = current_rows(dim).select(*keys, *tracked).alias("t")
    s = staged.alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    cond = cond & ~_changed("t", "s", tracked, null_safe)
    return s.join(cur, cond, "left_anti")


def scd2_backfill(snapshots: DataFrame, keys: list[str], tracked: list[str], as_of: str = "as_of",
                  null_safe: bool = False) -> DataFrame:
    """C1-C3 over a history of snapshots: the dimension that merging them one by one would give.

    ``snapshots`` has one row per key and ``as_of`` date. One shuffle brings a
    key's snapshots together (as many as there are dates); a fold over them in
    date order opens a version where the current one's tracked attributes
    change. A comparison with the snapshot before would not do: with ``<>``
    semantics a NULL changes nothing and the version's own values stay, and a
    version keeps the untracked attributes it began with. Each version ends
    where the next one starts.
    """
    biz = [c for c in snapshots.columns if c != as_of]
    rest = [c for c in biz if c not in keys]
    row = F.struct(F.col(as_of).cast("date").alias("effective_from"), *[F.col(c) for c in rest])
    kind = snapshots.select(row.alias("r")).schema["r"].dataType.simpleString()

    def changed(version: Column, new: Column) -> Column:
        pairs = [(version[c], new[c]) for c in tracked]
        return reduce(lambda a, b: a | b, [~t.eqNullSafe(s) if null_safe else F.coalesce(t != s, F.lit(False))
                                           for t, s in pairs])

    def fold(versions: Column, new: Column) -> Column:
        opens = (F.size(versions) == 0) | changed(F.get(versions, F.size(versions) - 1), new)
        return F.when(opens, F.concat(versions, F.array(new))).otherwise(versions)

    # dates differ within a key, so the first field alone settles the order
    history = F.array_sort(F.collect_list(row), lambda a, b: F.when(a["effective_from"] < b["effective_from"], -1)
                           .when(a["effective_from"] > b["effective_from"], 1).otherwise(0))
    folded = snapshots.groupBy(*keys).agg(history.alias("_history")).select(
        *keys, F.aggregate("_history", F.array().cast(f"array<{kind}>"), fold).alias("_versions"))
    return folded.select(*keys, "_versions", F.posexplode("_versions").alias("_at", "_v")).select(
        *[F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in biz], F.col("_v.effective_from"),
        F.get("_versions", F.col("_at") + 1)["effective_from"].alias("effective_to"),
        (F.col("_at") == F.size("_versions") - 1).alias("is_current"))
