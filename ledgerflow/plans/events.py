"""Queries over the driver's ``events`` stream table.

* ``purchase_last_view``: every purchase event with the user's latest view
  at or before it (backward as-of on timestamps).
* ``duplicate_events``: events with another event of the same user and type
  within 60 seconds (the duplicate-submission rule applied to a stream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.asof import asof_ranges
from ledgerflow.operators.dedup import near_duplicates


def purchase_last_view(events: DataFrame) -> DataFrame:
    purchases = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    views = events.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_event_id"),
        F.col("value").alias("view_value"))
    out = asof_ranges(purchases, views, ["user_id"], "ts", "view_ts", tiebreak=["view_event_id"])
    return out.select("event_id", "user_id", "ts", "value", "view_event_id", "view_ts", "view_value",
                      (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("view_ts").cast("timestamp")))
                      .alias("micros_since_view"))


def duplicate_events(events: DataFrame, seconds: int = 60) -> DataFrame:
    flagged = near_duplicates(events.select("event_id", "ts", "user_id", "event_type"),
                              ["user_id", "event_type"], "ts", seconds)
    return flagged.where("is_near_duplicate").select("event_id", "ts", "user_id", "event_type")
