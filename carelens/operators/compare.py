"""Age-aligned comparison of subjects on top of the daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.operators.daily import METRICS

SUMMARY_METRICS = ("night_sleep_minutes", "nap_count", "total_nap_minutes", "feed_count", "diaper_count")


def subject_daily(daily: DataFrame, baby_id) -> DataFrame:
    """One subject's daily rows; the filter reaches every branch of a lazy mart."""
    return daily.where(F.col("baby_id") == F.lit(baby_id))


def weekly_summary(daily: DataFrame) -> DataFrame:
    """Averages per subject and completed week of age."""
    return daily.groupBy("baby_id", "baby_name", "age_weeks").agg(
        F.count("*").alias("days"),
        *(F.avg(name).alias(f"avg_{name}") for name in SUMMARY_METRICS),
    )


def weekly_overlap(daily: DataFrame, pairs: DataFrame) -> DataFrame:
    """The weekly summaries of both subjects of each pair, up to the week the younger one has reached.

    What two subjects have in common is no business of a third, so each pair has its own end. A pair of which
    one subject has no days has no rows.
    """
    weeks = pair_sides(pairs).join(weekly_summary(daily), "baby_id")
    pair = W.partitionBy("left_id", "right_id")
    reached = [F.max(F.when(side, F.col("age_weeks"))).over(pair) for side in (F.col("is_left"), ~F.col("is_left"))]
    both = weeks.withColumns({"left_oldest": reached[0], "right_oldest": reached[1]})
    common = (F.col("age_weeks") <= F.col("left_oldest")) & (F.col("age_weeks") <= F.col("right_oldest"))
    return both.where(common).drop("is_left", "left_oldest", "right_oldest")


def pair_sides(pairs: DataFrame) -> DataFrame:
    """One row per (pair, side) from rows of ``left_id`` and ``right_id``."""
    side = F.explode(
        F.array(
            F.struct(F.lit(True).alias("is_left"), F.col("left_id").alias("baby_id")),
            F.struct(F.lit(False).alias("is_left"), F.col("right_id").alias("baby_id")),
        )
    )
    return pairs.select("left_id", "right_id", side.alias("side")).select("left_id", "right_id", "side.*")


def compare(
    daily: DataFrame, pairs: DataFrame, align: str, metrics: tuple[str, ...] = METRICS
) -> DataFrame:
    """Both subjects of each pair side by side at the same age.

    ``align`` is ``age_days`` or ``age_weeks``; several days at one age are
    averaged. Ages beyond what the younger subject has reached are left out.
    An age only one of them has on record keeps NULL for the other.

    Both sides travel as rows and meet in one aggregate, so no join is made
    per age and nothing grows with the number of subjects of the same age.
    """
    if align == "age_days":
        ages = daily.select("baby_id", align, *metrics)
    else:
        ages = daily.groupBy("baby_id", align).agg(*(F.avg(name).alias(name) for name in metrics))
    left, right = F.col("is_left"), ~F.col("is_left")
    # Placed by pair once: the aggregate per age and the window per pair both find their rows together.
    placed = pair_sides(pairs).join(ages, "baby_id").repartition("left_id", "right_id")
    aligned = (
        placed.groupBy("left_id", "right_id", align)
        .agg(
            F.max(F.when(left, F.col(align))).alias("left_age"),
            F.max(F.when(right, F.col(align))).alias("right_age"),
            *(F.max(F.when(left, F.col(name))).alias(f"left_{name}") for name in metrics),
            *(F.max(F.when(right, F.col(name))).alias(f"right_{name}") for name in metrics),
        )
    )
    pair = W.partitionBy("left_id", "right_id")
    return (
        aligned.withColumns(
            {"left_oldest": F.max("left_age").over(pair), "right_oldest": F.max("right_age").over(pair)}
        )
        # Never true, so no rows at all, when one of the two has no days.
        .where((F.col(align) <= F.col("left_oldest")) & (F.col(align) <= F.col("right_oldest")))
        .drop("left_age", "right_age", "left_oldest", "right_oldest")
    )
