"""References to records that do not exist.

Both sides are change deltas on a key: a referring row adds one reference, an entry adds
one existence when it is loaded and takes it away when it is withdrawn.  Their sums per
key are the state; a key with references and no existence is an orphan.  For the report
as of each row's own time the existence of a key is folded into the spans during which its
count was positive.  Only keys with a positive count of references whose existence is not
positive from the first of them to the last have orphans, and only their rows are looked
at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def entry_deltas(entries: DataFrame, keys: Sequence[str], loaded: str = "loaded_at", withdrawn: str = "withdrawn_at") -> DataFrame:
    """(keys, ts, d): +1 at loading and -1 at withdrawal, summed per key and instant.

    An entry withdrawn no later than it was loaded was never on file and gives no delta;
    one that was never loaded gives none either.
    """
    live = entries.where(F.col(loaded).isNotNull() & (F.col(withdrawn).isNull() | (F.col(withdrawn) > F.col(loaded))))
    signs = F.array(F.struct(F.col(loaded).alias("ts"), F.lit(1).alias("d")), F.struct(F.col(withdrawn).alias("ts"), F.lit(-1).alias("d")))
    return live.select(*keys, F.explode(signs).alias("e")).where("e.ts is not null").groupBy(*keys, F.col("e.ts").alias("ts")).agg(F.sum("e.d").alias("d"))


def running_existence(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``deltas`` with ``n``, the existence count of the key from ``ts`` on.

    A prefix sum in two levels (days, then instants of a day): a key with very many
    entries is not sorted in one task.
    """
    day = F.to_date("ts").alias("_day")
    daily = deltas.groupBy(*keys, day).agg(F.sum("d").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(W.partitionBy(*keys).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    daily = daily.select(*keys, "_day", before.alias("_before"))
    within = F.sum("d").over(W.partitionBy(*keys, "_day").orderBy("ts").rowsBetween(W.unboundedPreceding, 0))
    inside = deltas.withColumn("_day", day).withColumn("_within", within)
    return inside.join(daily, [*keys, "_day"]).select(*keys, "ts", (F.col("_before") + F.col("_within")).alias("n"))


def on_file_spans(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, first_loaded, spans): ``spans`` are the half-open times with a positive existence count; an open end is null."""
    n = running_existence(entry_deltas(entries, keys), keys)
    order = W.partitionBy(*keys).orderBy("ts")
    n = n.withColumn("_on", F.col("n") > 0)
    turns = n.withColumn("_was", F.coalesce(F.lag("_on").over(order), F.lit(False))).where("_on <> _was")
    spans = (
        turns.withColumn("_end", F.lead("ts").over(order)).where("_on")
        .groupBy(*keys).agg(F.collect_list(F.struct(F.col("ts").alias("s"), F.col("_end").alias("e"))).alias("spans"))
    )
    first = entries.groupBy(*keys).agg(F.min("loaded_at").alias("first_loaded"))
    return first.join(spans, list(keys), "left")


def _status(t: Column) -> Column:
    held = F.coalesce(F.exists("spans", lambda x: (x["s"] <= t) & (x["e"].isNull() | (t < x["e"]))), F.lit(False))
    return (
        F.when(F.col("_hit").isNull(), "missing")
        .when(held, F.lit(None).cast("string"))
        .when(F.col("first_loaded") <= t, "deleted")
        .otherwise("late")
    )


def reference_deltas(refs: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """(keys, refs, first, last): the signed references of each key, summed before the shuffle, and the time they span."""
    return refs.groupBy(*keys).agg(F.count(F.lit(1)).alias("refs"), F.min(at).alias("_first"), F.max(at).alias("_last"), F.count_if(F.col(at).isNull()).alias("_timeless"))


def orphan_keys(refs: DataFrame, state: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """(keys, spans, first_loaded, hit): keys with a positive count of references whose existence is not positive from the first of them to the last."""
    d = reference_deltas(refs, keys, at).where("refs > 0").join(state, list(keys), "left")
    whole = F.exists("spans", lambda x: (x["s"] <= F.col("_first")) & (x["e"].isNull() | (F.col("_last") < x["e"])))
    return d.where((F.col("_timeless") > 0) | ~F.coalesce(whole, F.lit(False))).select(*keys, "spans", "first_loaded", "_hit")


def label_orphans(refs: DataFrame, entries: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The rows of ``refs`` for which no entry is on file at ``at``, with ``status``.

    ``missing``: the key has no entry; ``deleted``: some entry was loaded by then; ``late``:
    all were loaded later.  A null key refers to nothing and gives no row.  A row without a
    time finds nothing on file: it is ``missing`` or ``late``.  Repeated entries and
    repeated references are counted as they stand.  The counts have one row per key, so a
    hot key never multiplies rows; the join is left to AQE, which broadcasts the orphan
    keys at run time if they are few and splits skewed keys if not.
    """
    state = on_file_spans(entries, keys).withColumn("_hit", F.lit(1))
    asked = refs
    for k in keys:
        asked = asked.where(F.col(k).isNotNull())
    out = asked.join(orphan_keys(asked, state, keys, at), list(keys)).select(*refs.columns, "spans", "first_loaded", "_hit")
    out = out.withColumn("status", _status(F.col(at)))
    return out.where("status is not null").select(*refs.columns, "status")


def reference_state(refs: DataFrame, entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, refs, present): the state as it stands after all deltas."""
    r = refs.groupBy(*keys).agg(F.count(F.lit(1)).alias("refs")).withColumn("present", F.lit(0).cast("long"))
    e = entry_deltas(entries, keys).groupBy(*keys).agg(F.sum("d").alias("present")).withColumn("refs", F.lit(0).cast("long"))
    return apply_deltas(r, e, keys)


def apply_deltas(state: DataFrame, deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State and signed deltas (keys, refs, present) added up; keys that sum to nothing leave the state."""
    both = state.select(*keys, "refs", "present").unionByName(deltas.select(*keys, "refs", "present"))
    return both.groupBy(*keys).agg(F.sum("refs").alias("refs"), F.sum("present").alias("present")).where("refs <> 0 or present <> 0")


def current_orphans(state: DataFrame) -> DataFrame:
    return state.where("refs > 0 and present <= 0")


# ------------------------------------------------------------------ the two reference tables


def register(initiatives: DataFrame, fy16: DataFrame) -> DataFrame:
    """(fiscal_year, initiative, loaded_at, withdrawn_at): every register entry, 2016 from its own table."""
    cols = ["initiative", "loaded_at", "withdrawn_at"]
    other = initiatives.where("fiscal_year <> 2016").select("fiscal_year", *cols)
    return other.unionByName(fy16.select(F.lit(2016).alias("fiscal_year"), *cols))


def budget_orphans(awards: DataFrame, transparency: DataFrame, initiatives: DataFrame, fy16: DataFrame) -> DataFrame:
    """(table_name, row_id, fiscal_year, status): orphans of awards (by year and initiative) and of transparency (by year)."""
    reg = register(initiatives, fy16)
    a = awards.where("initiative <> ''").select(F.col("award_id").alias("row_id"), "fiscal_year", "initiative", "recorded_at")
    t = transparency.select(F.col("action_id").alias("row_id"), "fiscal_year", "recorded_at")
    found_a = label_orphans(a, reg, ["fiscal_year", "initiative"], "recorded_at")
    found_t = label_orphans(t, reg.drop("initiative"), ["fiscal_year"], "recorded_at")
    pick = lambda d, name: d.select(F.lit(name).alias("table_name"), "row_id", "fiscal_year", "status")
    return pick(found_a, "awards").unionByName(pick(found_t, "transparency"))
