"""Typed events with their subject and its age at the time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions import time as T


def subject_dimension(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        F.col("id").alias("baby_id"), F.col("name").alias("baby_name"), F.col("date_of_birth")
    )


def with_subject(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Inner join on ``baby_id``; rows without a profile are dropped.

    No broadcast hint: Spark broadcasts the profiles while they are below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges beyond. Nothing
    after this join relies on its partitioning, so AQE is free to split the
    partition of a subject that owns a large share of the rows.
    """
    return rows.join(subject_dimension(profiles), "baby_id")


def known_subjects(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Keep rows whose subject has a profile, without fetching the profile."""
    return rows.join(profiles.select(F.col("id").alias("baby_id")), "baby_id", "left_semi")


def _age(on: Column) -> tuple[Column, Column]:
    born = F.col("date_of_birth")
    return T.age_days(on, born).alias("age_days"), T.age_weeks(on, born).alias("age_weeks")


def stage_sleeps(sleeps: DataFrame, profiles: DataFrame) -> DataFrame:
    start, end = F.col("start_time"), F.col("end_time")
    return with_subject(sleeps.where(end > start), profiles).select(
        F.col("id").alias("sleep_id"),
        "baby_id",
        "baby_name",
        "date_of_birth",
        start,
        end,
        T.duration_minutes(start, end).alias("duration_minutes"),
        "sleep_type",
        *_age(start),
    )


def stage_feeds(feeds: DataFrame, profiles: DataFrame) -> DataFrame:
    start, end = F.col("start_time"), F.col("end_time")
    left, right = F.col("left_breast_duration"), F.col("right_breast_duration")
    # NULL plus a value is that value here; NULL plus NULL stays NULL.
    both_sides = F.coalesce(left + right, left, right)
    return with_subject(feeds, profiles).select(
        F.col("id").alias("feeding_id"),
        "baby_id",
        "baby_name",
        "date_of_birth",
        start,
        end,
        T.duration_minutes(start, end).alias("duration_minutes"),
        "feeding_type",
        "breast_started",
        left,
        right,
        both_sides.alias("breast_duration_minutes"),
        "volume_offered_ml",
        "volume_consumed_ml",
        *_age(start),
    )


def stage_diapers(diapers: DataFrame, profiles: DataFrame) -> DataFrame:
    when = F.col("event_time")
    rows = diapers.withColumnRenamed("timestamp", "event_time").withColumnRenamed("id", "diaper_id")
    return with_subject(rows, profiles).select(
        "diaper_id",
        "baby_id",
        "baby_name",
        "date_of_birth",
        when,
        "has_urine",
        "has_stool",
        *_age(when),
    )
