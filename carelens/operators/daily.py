"""Per-day metrics of each subject, one operator per group of columns, and their assembly.

Every operator aggregates the raw events by (subject, day) first and looks at
profiles afterwards, so the only rows joined are already one per day. An event
without a profile disappears with its subject.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens import constants as K
from carelens.functions import time as T
from carelens.operators.sleep import fct_wake_windows, valid_sleeps
from carelens.operators.staging import known_subjects, subject_dimension

KEY = ["baby_id", "metric_date"]
# Columns that read 0 on a day without such events; all others stay NULL.
ZERO_WHEN_MISSING = (
    "night_sleep_minutes",
    "nap_count",
    "total_nap_minutes",
    "feed_count",
    "breast_feed_count",
    "bottle_feed_count",
    "diaper_count",
    "wet_diaper_count",
    "dirty_diaper_count",
)
METRICS = (
    "night_sleep_minutes",
    "night_sleep_segments",
    "longest_night_stretch_minutes",
    "awake_at_night_minutes",
    "night_waking_count",
    "nap_count",
    "total_nap_minutes",
    "avg_nap_minutes",
    "feed_count",
    "breast_feed_count",
    "bottle_feed_count",
    "total_volume_ml",
    "avg_feed_interval_minutes",
    "avg_wake_window_minutes",
    "max_wake_window_minutes",
    "diaper_count",
    "wet_diaper_count",
    "dirty_diaper_count",
)


def event_days(sleeps: DataFrame, feeds: DataFrame, diapers: DataFrame) -> DataFrame:
    """The calendar date of every event that counts, repeats included."""
    dated = (
        valid_sleeps(sleeps).select("baby_id", F.col("start_time").alias("at")),
        feeds.select("baby_id", F.col("start_time").alias("at")),
        diapers.select("baby_id", F.col("timestamp").alias("at")),
    )
    return reduce(DataFrame.unionByName, dated).select("baby_id", F.to_date("at").alias("event_date"))


def event_bounds(profiles: DataFrame, sleeps: DataFrame, feeds: DataFrame, diapers: DataFrame) -> DataFrame:
    bounds = (
        event_days(sleeps, feeds, diapers)
        .groupBy("baby_id")
        .agg(F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))
    )
    return known_subjects(bounds, profiles)


def date_spine(profiles: DataFrame, sleeps: DataFrame, feeds: DataFrame, diapers: DataFrame) -> DataFrame:
    """Every day from a subject's first to its last event, without gaps."""
    bounds = event_bounds(profiles, sleeps, feeds, diapers).join(subject_dimension(profiles), "baby_id")
    return bounds.select(
        "baby_id",
        "baby_name",
        "date_of_birth",
        F.explode(F.sequence("first_date", "last_date")).alias("metric_date"),
    )


def night_aggregates() -> dict[str, Column]:
    """Night totals over ``sleep_starts`` rows of one care day."""
    night = F.col("is_night")
    return {
        "night_sleep_minutes": F.sum(F.when(night, F.col("minutes"))),
        "night_sleep_segments": F.sum(F.when(night, F.col("sessions"))),
        "longest_night_stretch_minutes": F.max(F.when(night, F.col("longest"))),
    }


def waking_aggregates() -> dict[str, Column]:
    """What the awake time of one night follows from.

    Gaps between consecutive segments telescope: their sum is the span from
    the first start to the end of the last segment minus all segment lengths.
    No ordering of the segments is needed, overlaps count as negative gaps.
    """
    night = F.col("is_night")
    return {
        "night_begin": F.min(F.when(night, F.col("start_time"))),
        "night_end": F.max_by(F.col("end_time"), F.when(night, F.col("start_time"))),
        "night_us": F.sum(F.when(night, F.col("length_us"))),
        "segments": F.sum(F.when(night, F.col("sessions"))),
    }


def awake_minutes() -> Column:
    span = T.micros_between(F.col("night_begin"), F.col("night_end"))
    return F.when(F.col("segments") > 1, T.whole_minutes(span - F.col("night_us")))


def waking_count() -> Column:
    return F.when(F.col("segments") > 1, F.col("segments") - 1)


def nap_aggregates() -> dict[str, Column]:
    nap = ~F.col("is_night")
    return {
        "nap_count": F.sum(F.when(nap, F.col("sessions"))),
        "total_nap_minutes": F.sum(F.when(nap, F.col("minutes"))),
    }


def average_nap() -> Column:
    return T.rounded_ratio(F.col("total_nap_minutes"), F.col("nap_count"))


def sleep_days(sleeps: DataFrame) -> DataFrame:
    """All sleep columns of each care day in one aggregate.

    Sums and extremes need no row per start first: copies are absorbed by the partial aggregate.
    """
    each = valid_sleeps(sleeps).withColumns({"sessions": F.lit(1), "longest": F.col("minutes")})
    # Of the sleeps that begin last, the longest ends the night. One number for both keeps the buffer fixed.
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    begun, ended = (T.micros_between(epoch, F.col(c)).cast("decimal(19,0)") for c in ("start_time", "end_time"))
    order = F.when(F.col("is_night"), begun * F.lit(10**18).cast("decimal(19,0)") + ended)
    wakings = waking_aggregates() | {"night_end": F.max_by(F.col("end_time"), order)}
    aggregates = night_aggregates() | wakings | nap_aggregates()
    named = (column.alias(name) for name, column in aggregates.items())
    return each.groupBy("baby_id", F.col("care_day").alias("metric_date")).agg(*named).select(
        *KEY,
        *night_aggregates(),
        awake_minutes().alias("awake_at_night_minutes"),
        waking_count().alias("night_waking_count"),
        *nap_aggregates(),
        average_nap().alias("avg_nap_minutes"),
    )


def _with(days: DataFrame, profiles: DataFrame, key: str, *others: str) -> DataFrame:
    """Columns of the days that have the first of them."""
    return known_subjects(days.where(F.col(key).isNotNull()).select(*KEY, key, *others), profiles)


def night_sleep(profiles: DataFrame, sleeps: DataFrame) -> DataFrame:
    others = ("night_sleep_minutes", "longest_night_stretch_minutes")
    return _with(sleep_days(sleeps), profiles, "night_sleep_segments", *others)


def night_wakings(profiles: DataFrame, sleeps: DataFrame) -> DataFrame:
    return _with(sleep_days(sleeps), profiles, "night_waking_count", "awake_at_night_minutes")


def naps(profiles: DataFrame, sleeps: DataFrame) -> DataFrame:
    return _with(sleep_days(sleeps), profiles, "nap_count", "total_nap_minutes", "avg_nap_minutes")


def feed_starts(feeds: DataFrame) -> DataFrame:
    """One row per (subject, feed start) with totals over the feeds begun then."""
    kind = F.col("feeding_type")
    return (
        feeds.where(F.col("baby_id").isNotNull() & F.col("start_time").isNotNull())
        .groupBy("baby_id", F.to_date("start_time").alias("metric_date"), "start_time")
        .agg(
            F.count("*").alias("feeds"),
            F.count_if(kind == K.BREAST).alias("breast"),
            F.count_if(kind == K.BOTTLE).alias("bottle"),
            F.sum("volume_consumed_ml").alias("volume"),
        )
    )


def counted_gap(earlier: Column, later: Column) -> Column:
    """The gap between two feed starts if it is a real interval, else NULL."""
    gap = T.micros_between(earlier, later)
    shortest, longest = (m * T.MINUTE_US for m in (K.FEED_GAP_MIN_MINUTES, K.FEED_GAP_MAX_MINUTES))
    return F.when(gap.between(shortest, longest), gap)


def feed_days(feeds: DataFrame) -> DataFrame:
    """Feed totals per day plus what the gap from the previous day needs.

    Feeds that start together have a gap of zero, which never counts, so only
    distinct starts matter for intervals.
    """
    day = W.partitionBy(*KEY).orderBy("start_time")
    starts = feed_starts(feeds).withColumn(
        "gap_us", counted_gap(F.lag("start_time").over(day), F.col("start_time"))
    )
    return starts.groupBy(*KEY).agg(
        F.sum("feeds").alias("feed_count"),
        F.sum("breast").alias("breast_feed_count"),
        F.sum("bottle").alias("bottle_feed_count"),
        F.sum("volume").alias("total_volume_ml"),
        F.sum("gap_us").alias("gap_us"),
        F.count("gap_us").alias("gaps"),
        F.min("start_time").alias("first_feed"),
        F.max("start_time").alias("last_feed"),
    )


def with_first_gap(days: DataFrame, previous_feed: Column) -> DataFrame:
    """Add the gap that leads into the first feed of the day."""
    gap = counted_gap(previous_feed, F.col("first_feed"))
    return days.withColumn("entry_us", gap).withColumns(
        {
            "gap_us": F.coalesce("gap_us", F.lit(0)) + F.coalesce("entry_us", F.lit(0)),
            "gaps": F.coalesce("gaps", F.lit(0)) + F.when(F.col("entry_us").isNotNull(), 1).otherwise(0),
        }
    )


def average_gap() -> Column:
    return F.when(
        F.col("gaps") > 0, T.rounded_ratio(F.col("gap_us"), F.col("gaps") * T.MINUTE_US)
    )


def feeds(profiles: DataFrame, feeds: DataFrame) -> DataFrame:
    kind = F.col("feeding_type")
    days = (
        feeds.where(F.col("start_time").isNotNull())
        .groupBy("baby_id", F.to_date("start_time").alias("metric_date"))
        .agg(
            F.count("*").alias("feed_count"),
            F.count_if(kind == K.BREAST).alias("breast_feed_count"),
            F.count_if(kind == K.BOTTLE).alias("bottle_feed_count"),
            F.sum("volume_consumed_ml").alias("total_volume_ml"),
        )
    )
    return known_subjects(days, profiles)


def feed_days_with_intervals(feeds: DataFrame) -> DataFrame:
    """All feed columns of each day."""
    # The window runs over one row per day, never over the feeds themselves.
    days = W.partitionBy("baby_id").orderBy("metric_date")
    previous = feed_days(feeds).withColumn("previous_feed", F.lag("last_feed").over(days))
    return with_first_gap(previous, F.col("previous_feed")).withColumn("avg_feed_interval_minutes", average_gap())


def feed_intervals(profiles: DataFrame, feeds: DataFrame) -> DataFrame:
    return _with(feed_days_with_intervals(feeds), profiles, "avg_feed_interval_minutes")


def daily_wake_windows(profiles: DataFrame, sleeps: DataFrame) -> DataFrame:
    minutes = F.col("wake_window_minutes")
    return (
        fct_wake_windows(sleeps, profiles)
        .groupBy("baby_id", F.col("calendar_date").alias("metric_date"))
        .agg(
            T.rounded_ratio(F.sum(minutes), F.count("*")).alias("avg_wake_window_minutes"),
            F.max(minutes).alias("max_wake_window_minutes"),
        )
    )


def diaper_days(diapers: DataFrame) -> DataFrame:
    return (
        diapers.where(F.col("baby_id").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy("baby_id", F.to_date("timestamp").alias("metric_date"))
        .agg(
            F.count("*").alias("diaper_count"),
            F.count_if("has_urine").alias("wet_diaper_count"),
            F.count_if("has_stool").alias("dirty_diaper_count"),
        )
    )


def nappies(profiles: DataFrame, diapers: DataFrame) -> DataFrame:
    return known_subjects(diaper_days(diapers), profiles)


def published(days: DataFrame) -> DataFrame:
    """The columns of the daily table in order, with age and the zero/NULL policy applied."""
    on, born = F.col("metric_date"), F.col("date_of_birth")
    metrics = (
        F.coalesce(name, F.lit(0)).alias(name) if name in ZERO_WHEN_MISSING else F.col(name)
        for name in METRICS
    )
    return days.select(
        "baby_id",
        "baby_name",
        on,
        T.age_days(on, born).alias("age_days"),
        T.age_weeks(on, born).alias("age_weeks"),
        *metrics,
    )


def assemble(spine: DataFrame, *groups: DataFrame) -> DataFrame:
    """The daily table from a spine and any number of per-day groups of columns.

    All groups share the key, so the left joins reuse the partitioning their
    aggregates already have.
    """
    return published(reduce(lambda days, group: days.join(group, KEY, "left"), groups, spine))


def daily_from_groups(
    profiles: DataFrame, sleeps: DataFrame, feed_rows: DataFrame, diapers: DataFrame
) -> DataFrame:
    """The daily table as a spine and one group of columns per kind of event; each kind is read for its own days
    and for the spine only."""
    feed_columns = ("breast_feed_count", "bottle_feed_count", "total_volume_ml", "avg_feed_interval_minutes")
    return assemble(
        date_spine(profiles, sleeps, feed_rows, diapers),
        sleep_days(sleeps),
        feed_days_with_intervals(feed_rows).select(*KEY, "feed_count", *feed_columns),
        daily_wake_windows(profiles, sleeps),
        diaper_days(diapers),
    )
