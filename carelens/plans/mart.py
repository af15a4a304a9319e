"""The daily metrics table as one job.

The same table as ``operators.daily.daily_from_groups``, arranged so that
each event is read once and nothing is joined but profiles:

1. Sleeps, feeds and diapers are each reduced to one row per (subject, day).
   Days hold at most one row per distinct start, so a subject with a third of
   all events is spread over as many tasks as it has days.
2. The three are stacked and sent to their subject: three rows per day at most.
3. Within a subject the days are put in order once. That order gives the
   missing days, the gap into each day's first feed, and the wake windows that
   span two days. How much one task holds is bounded by the calendar, not by
   how many events a subject has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.functions import time as T
from carelens.operators.daily import (
    average_gap,
    average_nap,
    awake_minutes,
    diaper_days,
    feed_days,
    nap_aggregates,
    night_aggregates,
    published,
    waking_aggregates,
    waking_count,
    with_first_gap,
)
from carelens.operators.sleep import by_care_day, is_wake_window, sleep_starts
from carelens.operators.staging import subject_dimension


def sleep_days(sleeps: DataFrame) -> DataFrame:
    """Night, nap and wake-window totals per care day.

    A window opening within the care day lies on its calendar date or, before
    7 am, on the next; ``wake_*`` holds the first sort, ``late_*`` the second.
    """
    closed = F.lead("start_time").over(by_care_day())
    opened = F.col("end_time")
    window = F.when(is_wake_window(opened, F.col("next_start")), F.col("gap"))
    same_day = opened.cast("date") == F.col("care_day")
    rows = (
        sleep_starts(sleeps)
        .withColumn("next_start", closed)
        .withColumn("gap", T.duration_minutes(opened, F.col("next_start")))
        .withColumns({"wake": F.when(same_day, window), "late": F.when(~same_day, window)})
    )
    totals = {
        **night_aggregates(),
        **waking_aggregates(),
        **nap_aggregates(),
        "wake_minutes": F.sum("wake"),
        "wakes": F.count("wake"),
        "wake_max": F.max("wake"),
        "late_minutes": F.sum("late"),
        "lates": F.count("late"),
        "late_max": F.max("late"),
        "first_sleep": F.min("start_time"),
        "last_sleep": F.max("start_time"),
        # The last start of the day is the one without a successor.
        "sleep_end": F.max(F.when(F.col("next_start").isNull(), opened)),
    }
    days = rows.groupBy("baby_id", F.col("care_day").alias("metric_date")).agg(
        *(column.alias(name) for name, column in totals.items())
    )
    return days.withColumns(
        {
            "awake_at_night_minutes": awake_minutes(),
            "night_waking_count": waking_count(),
            "avg_nap_minutes": average_nap(),
            "first_event": F.to_date("first_sleep"),
            "last_event": F.to_date("last_sleep"),
        }
    ).drop("night_begin", "night_end", "night_us", "segments", "last_sleep")


def stacked_days(sleeps: DataFrame, feeds: DataFrame, diapers: DataFrame) -> DataFrame:
    """One row per (subject, day) that has anything to say, placed with its subject."""
    on_its_date = {"first_event": F.col("metric_date"), "last_event": F.col("metric_date")}
    parts = (
        sleep_days(sleeps),
        feed_days(feeds).withColumns(on_its_date),
        diaper_days(diapers).withColumns(on_its_date),
    )
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    key = {"baby_id", "metric_date"}
    merged = {name: F.max for name in stacked.columns if name not in key}
    merged["first_event"] = F.min
    # Grouping after placing by subject costs no second shuffle.
    return (
        stacked.repartition("baby_id")
        .groupBy("baby_id", "metric_date")
        .agg(*(merge(name).alias(name) for name, merge in merged.items()))
    )


def filled_days(days: DataFrame) -> DataFrame:
    """Insert the days between a subject's rows, up to its last event; inserted days are empty."""
    subject = W.partitionBy("baby_id")
    ordered = subject.orderBy("metric_date")
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    known = {"baby_id", "metric_date", "baby_name", "date_of_birth", "first_date", "last_date", "until"}
    spanned = days.withColumns(
        {
            "previous_sleep_end": F.last("sleep_end", ignorenulls=True).over(before),
            "first_date": F.min("first_event").over(subject),
            "last_date": F.max("last_event").over(subject),
            "until": F.date_sub(F.lead("metric_date").over(ordered), 1),
        }
    ).withColumn("until", F.coalesce("until", F.greatest("metric_date", "last_date")))
    values = [name for name in spanned.columns if name not in known]
    return spanned.select(
        "*", F.posexplode(F.sequence("metric_date", "until")).alias("offset", "day")
    ).select(
        "baby_id",
        "baby_name",
        "date_of_birth",
        "first_date",
        F.col("day").alias("metric_date"),
        *(F.expr(f"IF(offset = 0, {name}, NULL) AS {name}") for name in values),
    )


def across_days(days: DataFrame) -> DataFrame:
    """Complete feed intervals and wake windows with what reaches over from the day before.

    Expects gap-free days, so the row before is the day before.
    """
    opened, closed = F.col("previous_sleep_end"), F.col("first_sleep")
    window = F.when(is_wake_window(opened, closed), T.duration_minutes(opened, closed))
    same_day = opened.cast("date") == F.col("metric_date")
    ordered = W.partitionBy("baby_id").orderBy("metric_date")

    def with_entry(prefix: str, minutes: str, count: str, entry: str) -> dict:
        extra = F.col(entry)
        return {
            minutes: F.coalesce(F.col(minutes), F.lit(0)) + F.coalesce(extra, F.lit(0)),
            count: F.coalesce(F.col(count), F.lit(0)) + F.when(extra.isNotNull(), 1).otherwise(0),
            f"{prefix}_max": F.greatest(f"{prefix}_max", entry),
        }

    days = days.withColumns({"entry": F.when(same_day, window), "late_entry": F.when(~same_day, window)})
    days = days.withColumns(
        {
            **with_entry("wake", "wake_minutes", "wakes", "entry"),
            **with_entry("late", "late_minutes", "lates", "late_entry"),
        }
    ).withColumns(
        {
            "yesterday_minutes": F.lag("late_minutes").over(ordered),
            "yesterday_wakes": F.lag("lates").over(ordered),
            "yesterday_max": F.lag("late_max").over(ordered),
            "previous_feed": F.lag("last_feed").over(ordered),
        }
    )
    minutes = F.col("wake_minutes") + F.coalesce("yesterday_minutes", F.lit(0))
    wakes = F.col("wakes") + F.coalesce("yesterday_wakes", F.lit(0))
    return with_first_gap(days, F.col("previous_feed")).withColumns(
        {
            "avg_feed_interval_minutes": average_gap(),
            "avg_wake_window_minutes": F.when(wakes > 0, T.rounded_ratio(minutes, wakes)),
            "max_wake_window_minutes": F.greatest("wake_max", "yesterday_max"),
        }
    )


def mart_daily_metrics(
    profiles: DataFrame, sleeps: DataFrame, feeds: DataFrame, diapers: DataFrame
) -> DataFrame:
    """One row per subject per day between its first and last event."""
    days = stacked_days(sleeps, feeds, diapers).join(subject_dimension(profiles), "baby_id")
    complete = across_days(filled_days(days))
    # Night segments before dawn of the first day belong to a day before the spine.
    return published(complete.where(F.col("metric_date") >= F.col("first_date")))
