"""Nested histories: the adopting event of a matter, and resumable enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HISTORY = "array<struct<MatterHistoryActionName:string,MatterHistoryActionBodyName:string,MatterHistoryPassedFlag:int,MatterHistoryEventId:bigint,MatterHistoryActionDate:string>>"


def adopting_event(history: Column) -> Column:
    """The first passed approval by the full council that has an event id, as a struct; null if there is none."""
    hit = F.filter(history, lambda h: (h["MatterHistoryActionName"] == "Approved, by Council") & (h["MatterHistoryActionBodyName"] == "City Council") & (h["MatterHistoryPassedFlag"] == 1) & h["MatterHistoryEventId"].isNotNull())
    return F.get(hit, F.lit(0))


def parse_history(c: Column | str) -> Column:
    return F.from_json(c, HISTORY)


def enrich(crosswalk: DataFrame, histories: DataFrame, key: str = "legistar_matter_number") -> DataFrame:
    """``crosswalk`` with adopting_event_id, adopting_body, adopting_action, adopting_datetime.

    Only confirmed rows without an event are looked up; each matter once.  ``histories``
    is (key, history JSON).
    """
    e = adopting_event(parse_history("history"))
    looked = histories.dropDuplicates([key]).select(key, e.alias("_e"))
    todo = (F.col("status") == "confirmed") & F.col("adopting_event_id").isNull()
    j = crosswalk.drop("adopting_body", "adopting_action", "adopting_datetime").join(looked, key, "left")
    return j.select(
        *[c for c in crosswalk.columns if not c.startswith("adopting_")], F.when(todo, F.col("_e.MatterHistoryEventId")).otherwise(F.col("adopting_event_id")).alias("adopting_event_id"),
        F.when(todo, F.col("_e.MatterHistoryActionBodyName")).alias("adopting_body"), F.when(todo, F.col("_e.MatterHistoryActionName")).alias("adopting_action"),
        F.when(todo, F.coalesce("_e.MatterHistoryActionDate", F.lit(""))).alias("adopting_datetime"),
    )


def counters(before: DataFrame, after: DataFrame, key: str = "local_file") -> DataFrame:
    """One row: confirmed, already_done, enriched, no_adopting_event, skipped_status."""
    j = after.join(before.select(key, F.col("adopting_event_id").alias("_was")), key)
    ok = F.col("status") == "confirmed"
    return j.agg(
        F.count_if(ok).alias("confirmed"), F.count_if(ok & F.col("_was").isNotNull()).alias("already_done"),
        F.count_if(ok & F.col("_was").isNull() & F.col("adopting_event_id").isNotNull()).alias("enriched"),
        F.count_if(ok & F.col("_was").isNull() & F.col("adopting_event_id").isNull()).alias("no_adopting_event"), F.count_if(~ok).alias("skipped_status"),
    )
