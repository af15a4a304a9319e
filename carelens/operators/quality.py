"""Data checks as queries: violations, or one row per check with their number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens import constants as K


def null_counts(rows: DataFrame, relation: str, columns: tuple[str, ...]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = rows.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return counts.unpivot([], list(columns), "column_name", "violations").select(
        F.lit(relation).alias("relation"), "column_name", "violations"
    )


def not_null_report(relations: dict[str, DataFrame]) -> DataFrame:
    parts = (null_counts(relations[name], name, columns) for name, columns in K.NOT_NULL_COLUMNS.items())
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys held by more than one row; counted before the shuffle, so a much repeated key costs little."""
    known = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in key))
    return rows.where(known).groupBy(*key).agg(F.count("*").alias("row_count")).where("row_count > 1")


def unique_report(relations: dict[str, DataFrame]) -> DataFrame:
    parts = (
        duplicate_keys(relations[relation], column)
        .agg(F.count("*").alias("violations"))
        .select(F.lit(relation).alias("relation"), F.lit(column).alias("column_name"), "violations")
        for relation, column in K.UNIQUE_COLUMNS.items()
    )
    return reduce(DataFrame.unionByName, parts)


def unaccepted_values(rows: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Values outside a closed set and how often they occur; NULL is the not-null check's business."""
    return (
        rows.where(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count("*").alias("row_count"))
    )


def accepted_values_report(feeds: DataFrame) -> DataFrame:
    return (
        unaccepted_values(feeds, "feeding_type", (K.BREAST, K.BOTTLE, K.SOLID))
        .agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations"))
        .select(
            F.lit("stg_feeding_sessions").alias("relation"),
            F.lit("feeding_type").alias("column_name"),
            "violations",
        )
    )


def grain_violations(daily: DataFrame) -> DataFrame:
    """Days a subject has more than one row for; rows lacking either key count as well."""
    return daily.groupBy("baby_id", "metric_date").agg(F.count("*").alias("row_count")).where("row_count > 1")


def grain_report(daily: DataFrame) -> DataFrame:
    days = daily.groupBy("baby_id", "metric_date").agg(F.count("*").alias("row_count"))
    return days.agg(
        F.count("*").alias("baby_days"),
        F.sum("row_count").alias("daily_rows"),
        F.count_if(F.col("row_count") > 1).alias("violations"),
    )


def _bounds() -> dict[str, Column]:
    checks = {}
    for name, (low, high) in K.DAILY_BOUNDS.items():
        if low is not None:
            checks[f"{name} < {low}"] = F.col(name) < low
        if high is not None:
            checks[f"{name} > {high}"] = F.col(name) > high
    return checks


def range_violations(daily: DataFrame) -> DataFrame:
    """Daily rows with at least one value no real day has."""
    return daily.where(reduce(lambda a, b: a | b, _bounds().values()))


def range_report(daily: DataFrame) -> DataFrame:
    checks = _bounds()
    counts = daily.agg(*(F.count_if(broken).alias(name) for name, broken in checks.items()))
    quoted = [F.col(f"`{name}`") for name in checks]
    return counts.unpivot([], quoted, "check_name", "violations")


#: Keys whose rows stand together when a relation is written in its published order, so that repeats are seen there.
GRAINS = {"mart_daily_metrics": ("baby_id", "metric_date")}


def row_checks(relation: str) -> dict[str, Column]:
    """What no row of the relation may fulfil, by the name of the check."""
    checks = {f"{name} is null": F.col(name).isNull() for name in K.NOT_NULL_COLUMNS.get(relation, ())}
    if relation == "stg_feeding_sessions":
        checks["feeding_type is not accepted"] = ~F.col("feeding_type").isin(K.BREAST, K.BOTTLE, K.SOLID)
    if relation == "mart_daily_metrics":
        checks |= _bounds()
    return checks


def repeated(columns: tuple[str, ...]) -> str:
    """The name of the check that no two rows have the same values of the columns."""
    return f"{', '.join(columns)} repeats"


def check_names() -> list[str]:
    """The names of all checks on all relations."""
    rows = [check for relation in K.NOT_NULL_COLUMNS for check in row_checks(relation)]
    keys = [(column,) for column in K.UNIQUE_COLUMNS.values()] + list(GRAINS.values())
    return [*rows, *map(repeated, keys)]


def checked(rows: DataFrame, relation: str) -> DataFrame:
    """relation, check_name and violations of all checks on the relation, in one pass over it.

    Rows are counted per key first, which tells repeated keys and carries the counts of the other checks.
    """
    checks, key = row_checks(relation), K.UNIQUE_COLUMNS[relation]
    counts = {f"check_{i}": check for i, check in enumerate(checks.values())}
    per_key = rows.groupBy(key).agg(F.count("*").alias("held"), *(F.count_if(check).alias(c) for c, check in counts.items()))
    names = [*checks, repeated((key,))]
    totals = [F.coalesce(F.sum(c), F.lit(0)) for c in counts] + [F.count_if((F.col("held") > 1) & F.col(key).isNotNull())]
    summed = per_key.agg(*(total.alias(name) for total, name in zip(totals, names, strict=True)))
    wide = summed.unpivot([], [F.col(f"`{name}`") for name in names], "check_name", "violations")
    return wide.select(F.lit(relation).alias("relation"), "check_name", "violations")
