"""Deliveries and discharges as episodes, each one sampling unit with an anchor date.

Events are reduced to one row per member and day before any window, so a member's
partition is bounded by the days of the years at hand however many lines a day has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: kinds of anchors
DELIVERY, DISCHARGE = "delivery", "discharge"


def _member(order: str):
    return Window.partitionBy("patient_id").orderBy(order)


def _numbered(days: DataFrame, first, order: str) -> DataFrame:
    """Running number of the rows for which ``first`` holds: the episode of each row."""
    running = _member(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("_first", first).withColumn("episode", F.sum(F.when(F.col("_first"), 1).otherwise(0)).over(running).cast("int")).drop("_first")


def delivery_days(events: DataFrame, gap_days: int = 90) -> DataFrame:
    """``events`` (patient_id, visit_id, event_date) by day with the episode of each: patient_id, event_date, episode,
    n_events, visit_id (the smallest of the day). An event more than ``gap_days`` after the one before is another delivery."""
    days = events.filter(F.col("event_date").isNotNull()).groupBy("patient_id", "event_date").agg(F.count(F.lit(1)).alias("n_events"), F.min("visit_id").alias("visit_id"))
    before = F.lag("event_date").over(_member("event_date"))
    return _numbered(days, before.isNull() | (F.datediff("event_date", before) > gap_days), "event_date")


def delivery_episodes(events: DataFrame, gap_days: int = 90) -> DataFrame:
    """One row a delivery: patient_id, episode (1, 2, ... by date), anchor_date (its first day), visit_id (of that day),
    n_days, n_events."""
    days = delivery_days(events, gap_days)
    out = days.groupBy("patient_id", "episode").agg(
        F.min(F.struct("event_date", "visit_id")).alias("_a"), F.count(F.lit(1)).cast("bigint").alias("n_days"), F.sum("n_events").cast("bigint").alias("n_events")
    )
    return out.select("patient_id", "episode", F.col("_a.event_date").alias("anchor_date"), F.col("_a.visit_id").alias("visit_id"), "n_days", "n_events")


def discharge_days(stays: DataFrame, transfer_days: int = 1) -> DataFrame:
    """``stays`` (patient_id, visit_id, admit_date, discharge_date) by day of admission, with the episode of each.
    A stay that begins at most ``transfer_days`` after the member's last discharge so far is a transfer and
    belongs to the same episode; one without a discharge, or discharged before it began, is no stay."""
    s = stays.filter(F.col("admit_date").isNotNull() & (F.col("discharge_date") >= F.col("admit_date")))
    last = F.max(F.struct("discharge_date", (-F.col("visit_id")).alias("_less"))).alias("_last")
    days = s.groupBy("patient_id", "admit_date").agg(F.count(F.lit(1)).alias("n_stays"), last)
    days = days.select("patient_id", "admit_date", "n_stays", F.col("_last.discharge_date").alias("discharge_date"), (-F.col("_last._less")).alias("visit_id"))
    out_by = F.max("discharge_date").over(_member("admit_date").rowsBetween(Window.unboundedPreceding, -1))
    return _numbered(days, out_by.isNull() | (F.datediff("admit_date", out_by) > transfer_days), "admit_date")


def discharge_episodes(stays: DataFrame, transfer_days: int = 1) -> DataFrame:
    """One row a discharge, transfers merged: patient_id, episode, admit_date, anchor_date (the last discharge), visit_id
    (the smallest that it ends), n_stays."""
    last = F.max(F.struct("discharge_date", (-F.col("visit_id")).alias("_less"))).alias("_last")
    out = discharge_days(stays, transfer_days).groupBy("patient_id", "episode").agg(F.min("admit_date").alias("admit_date"), last, F.sum("n_stays").cast("bigint").alias("n_stays"))
    return out.select("patient_id", "episode", "admit_date", F.col("_last.discharge_date").alias("anchor_date"), (-F.col("_last._less")).alias("visit_id"), "n_stays")


def visit_episodes(events: DataFrame | None, stays: DataFrame | None, gap_days: int = 90, transfer_days: int = 1) -> DataFrame:
    """Each visit's episode: anchor (its kind), patient_id, visit_id, unit_visit (the episode's visit), anchor_date.
    A visit of several days counts for its first."""
    parts = []
    if events is not None:
        day = delivery_days(events, gap_days).select("patient_id", "event_date", "episode")
        visit = events.groupBy("patient_id", "visit_id").agg(F.min("event_date").alias("event_date"))
        own = visit.join(day, ["patient_id", "event_date"]).join(delivery_episodes(events, gap_days).withColumnRenamed("visit_id", "unit_visit"), ["patient_id", "episode"])
        parts.append(own.select(F.lit(DELIVERY).alias("anchor"), "patient_id", "visit_id", "unit_visit", "anchor_date"))
    if stays is not None:
        day = discharge_days(stays, transfer_days).select("patient_id", "admit_date", "episode")
        sound = stays.filter(F.col("discharge_date") >= F.col("admit_date"))
        visit = sound.groupBy("patient_id", "visit_id").agg(F.min("admit_date").alias("admit_date"))
        own = visit.join(day, ["patient_id", "admit_date"]).join(discharge_episodes(stays, transfer_days).select("patient_id", "episode", "anchor_date", F.col("visit_id").alias("unit_visit")), ["patient_id", "episode"])
        parts.append(own.select(F.lit(DISCHARGE).alias("anchor"), "patient_id", "visit_id", "unit_visit", "anchor_date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def to_episodes(facts: DataFrame, episodes: DataFrame, anchor_col: str = "anchor") -> DataFrame:
    """Facts of anchored measures on their episode's visit and date, one unit an episode after the grain reduction;
    a fact outside any episode of its measure's kind goes. Facts of other measures stay as they are."""
    e = episodes.select(F.col("anchor").alias("_e_kind"), F.col("patient_id").alias("_e_patient"), F.col("visit_id").alias("_e_visit"), "unit_visit", "anchor_date")
    hit = (F.col(anchor_col) == F.col("_e_kind")) & (F.col("patient_id") == F.col("_e_patient")) & (F.col("visit_id") == F.col("_e_visit"))
    j = facts.join(e, hit, "left").filter(F.col(anchor_col).isNull() | F.col("unit_visit").isNotNull())
    j = j.withColumn("visit_id", F.coalesce("unit_visit", "visit_id")).withColumn("event_date", F.coalesce("anchor_date", "event_date"))
    return j.select(*facts.columns)
