"""Night/nap classification and the awake gaps between sleeps.

A subject may own a large share of all rows, so no operator here puts all
sleeps of a subject into one task. Sleeps are first collapsed to one row per
distinct start (a partial aggregate before the shuffle, so copies cost
nothing), neighbours are then found within (subject, care day), and only the
first and last start of each day take part in the search across days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens import constants as K
from carelens.functions import time as T
from carelens.operators.staging import stage_sleeps, with_subject


def fct_sleep_sessions(sleeps: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per staged sleep with its night flag and the date its night began."""
    start = F.col("start_time")
    night = T.is_night(start, F.col("duration_minutes"))
    return stage_sleeps(sleeps, profiles).withColumns(
        {
            "calendar_date": start.cast("date"),
            "is_night": night,
            "night_date": F.when(night, T.care_day(start)),
        }
    )


def valid_sleeps(sleeps: DataFrame) -> DataFrame:
    """Sleeps of positive length with what every sleep metric needs."""
    start, end = F.col("start_time"), F.col("end_time")
    timed = sleeps.where(F.col("baby_id").isNotNull() & (end > start)).select(
        "baby_id", start, end, T.micros_between(start, end).alias("length_us")
    )
    return timed.withColumn("minutes", T.whole_minutes(F.col("length_us"))).withColumns(
        {"care_day": T.care_day(start), "is_night": T.is_night(start, F.col("minutes"))}
    )


def sleep_starts(sleeps: DataFrame) -> DataFrame:
    """One row per (subject, start, night flag) with totals over the sleeps begun then."""
    return (
        valid_sleeps(sleeps)
        .groupBy("baby_id", "care_day", "start_time", "is_night")
        .agg(
            F.count("*").alias("sessions"),
            F.sum("minutes").alias("minutes"),
            F.max("minutes").alias("longest"),
            F.sum("length_us").alias("length_us"),
            F.max("end_time").alias("end_time"),
        )
    )


def by_care_day() -> W:
    return W.partitionBy("baby_id", "care_day").orderBy("start_time", "end_time")


def is_wake_window(opened: Column, closed: Column) -> Column:
    """A daytime gap of sensible length between one sleep's end and the next one's start."""
    return (
        (closed > opened)
        & F.hour(opened).between(K.WAKE_FIRST_HOUR, K.WAKE_LAST_HOUR)
        & T.duration_minutes(opened, closed).between(K.WAKE_MIN_MINUTES, K.WAKE_MAX_MINUTES)
    )


def sleep_neighbours(sleeps: DataFrame) -> DataFrame:
    """Each distinct start, the latest end of the sleeps begun then, and the next later start.

    Sleeps that share a start never open a wake window except the longest of
    them, because for the others the next sleep begins before they end.

    The sleeps are read once. Within a day neighbours follow from a window over the day. Only the last start of
    each day looks further: those rows share one window per subject, where each finds the first start of the
    next day there is; all other rows stay with their day.
    """
    starts = (
        valid_sleeps(sleeps)
        .groupBy("baby_id", "care_day", "start_time")
        .agg(F.max("end_time").alias("end_time"))
    )
    day = by_care_day()
    whole_day = W.partitionBy("baby_id", "care_day")
    marked = starts.select(
        "baby_id",
        "care_day",
        "start_time",
        "end_time",
        F.lead("start_time").over(day).alias("within"),
        F.min("start_time").over(whole_day).alias("day_begins"),
    )
    # NULL for the last start of a day: one row per day in the subject's own group.
    own_day = F.when(F.col("within").isNotNull(), F.col("care_day"))
    days = W.partitionBy("baby_id", "own_day").orderBy("care_day", "start_time")
    across = F.lead("day_begins").over(days)
    return marked.withColumn("own_day", own_day).select(
        "baby_id", "start_time", "end_time", F.coalesce("within", F.when(F.col("own_day").isNull(), across)).alias("next_start")
    )


def fct_wake_windows(sleeps: DataFrame, profiles: DataFrame) -> DataFrame:
    opened, closed = F.col("end_time"), F.col("next_start")
    born = F.col("date_of_birth")
    windows = sleep_neighbours(sleeps).where(is_wake_window(opened, closed))
    return with_subject(windows, profiles).select(
        "baby_id",
        "baby_name",
        opened.alias("wake_start"),
        closed.alias("wake_end"),
        T.duration_minutes(opened, closed).alias("wake_window_minutes"),
        opened.cast("date").alias("calendar_date"),
        T.age_days(opened, born).alias("age_days"),
        T.age_weeks(opened, born).alias("age_weeks"),
    )
