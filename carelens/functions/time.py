"""Wall-clock arithmetic on TIMESTAMP_NTZ, exact and independent of the session zone.

Lengths are whole microseconds (BIGINT) until the last step. Sums of integers
do not depend on the order partitions arrive in, so results are the same on
every run and after every retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelens import constants as K
from carelens.functions.text import strip

MINUTE_US = 60_000_000
DAY_US = 86_400_000_000


def div(a: Column, b: Column | int) -> Column:
    """Integer division truncating towards zero."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def micros_between(start: Column, end: Column) -> Column:
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def whole_minutes(micros: Column) -> Column:
    """Microseconds as minutes, halves away from zero."""
    half = F.when(micros < 0, F.lit(-MINUTE_US // 2)).otherwise(F.lit(MINUTE_US // 2))
    return div(micros + half, MINUTE_US).cast("int")


def rounded_ratio(total: Column, count: Column) -> Column:
    """``total / count`` for a non-negative total, halves up, without floating point."""
    return div(total * 2 + count, count * 2).cast("int")


def duration_minutes(start: Column, end: Column) -> Column:
    return whole_minutes(micros_between(start, end))


def age_days(on: Column, date_of_birth: Column) -> Column:
    return F.datediff(on, date_of_birth)


def age_weeks(on: Column, date_of_birth: Column) -> Column:
    """Completed weeks, truncating towards zero before birth as well."""
    return div(F.datediff(on, date_of_birth), 7).cast("int")


def care_day(start: Column) -> Column:
    """The day a sleep belongs to when days turn over at 7 am instead of midnight.

    For a night segment this is the date the night began; for a nap it is the
    calendar date, because naps never start before 7 am. One key therefore
    serves night totals, night gaps, naps and the search for the next sleep.
    """
    return (start - F.make_dt_interval(hours=F.lit(K.MORNING_HOUR))).cast("date")


def is_night(start: Column, minutes: Column) -> Column:
    hour = F.hour(start)
    return (
        ~hour.between(K.MORNING_HOUR, K.EARLY_EVENING_HOUR)
        | ((hour == K.EARLY_EVENING_HOUR) & (minutes > K.LONG_SLEEP_MINUTES))
    )


def sleep_label(start: Column, minutes: Column) -> Column:
    """The label given at ingest: long sleeps begun in the dark hours are nights."""
    dark = ~F.hour(start).between(K.MORNING_HOUR, K.EVENING_HOUR - 1)
    return F.when(dark & (minutes > K.LONG_SLEEP_MINUTES), F.lit(K.NIGHTTIME)).otherwise(F.lit(K.NAP))


def plus_minutes(start: Column, minutes: Column) -> Column:
    return start + F.make_dt_interval(mins=minutes)


def spark_pattern(fmt: Column) -> Column:
    """A strptime format (a column, so each subject may have its own) as a Spark pattern."""
    for directive, letters in K.DATETIME_DIRECTIVES.items():
        fmt = F.replace(fmt, F.lit(directive), F.lit(letters))
    return fmt


def parse_export_time(text: Column, fmt: Column) -> Column:
    """Export time as TIMESTAMP_NTZ; ``fmt`` is a strptime format column.

    Narrow no-break spaces and letter case are normalised first. Two-digit
    years follow the POSIX pivot, where Spark would put all of them after 2000.
    """
    clean = F.upper(F.replace(strip(text), F.lit("\u202f"), F.lit(" ")))
    # A pattern that is a literal is compiled once, one from a column for every row; almost all rows have a usual one.
    parsed = F.to_timestamp_ntz(clean, spark_pattern(fmt))
    for usual in K.USUAL_FORMATS:
        known = F.to_timestamp_ntz(clean, spark_pattern(F.lit(usual)))
        parsed = F.when(fmt == F.lit(usual), known).otherwise(parsed)
    last_century = F.contains(fmt, F.lit("%y")) & (F.year(parsed) >= 2000 + K.TWO_DIGIT_YEAR_PIVOT)
    return F.when(last_century, parsed - F.make_ym_interval(F.lit(100))).otherwise(parsed)


def format_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
