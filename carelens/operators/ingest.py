"""Export text rows to typed event rows, all subjects in one pass.

Input rows carry the text columns of their kind plus ``row_id``, ``baby_id``
and ``datetime_format``; the format is a column, so subjects that export
day-first and month-first times are parsed together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens import constants as K
from carelens import schemas
from carelens.functions import text as X
from carelens.functions import time as T
from carelens.session import bounded
from carelens.sources.subjects import with_subject_ids


def attach_subjects(rows: DataFrame, subjects: DataFrame) -> DataFrame:
    """Add ``baby_id`` and ``datetime_format``; rows of unregistered subjects go (``left_out`` has them)."""
    return rows.join(_registry(subjects), "subject")


def _registry(subjects: DataFrame) -> DataFrame:
    return bounded(
        with_subject_ids(subjects).select(F.col("name").alias("subject"), "baby_id", "datetime_format")
    )


def left_out(rows: DataFrame, subjects: DataFrame) -> DataFrame:
    """Export rows whose subject is not registered."""
    return rows.join(bounded(subjects.select(F.col("name").alias("subject"))), "subject", "left_anti")


def _event_time() -> Column:
    return T.parse_export_time(F.col("Time"), F.col("datetime_format"))


def _note() -> Column:
    return X.blank_to_null(F.col("Note"))


def _as_table(rows: DataFrame, table: str, at: str, **values: Column) -> DataFrame:
    """The stored columns of ``table``; created/updated are the event's own time."""
    known = {
        "id": F.col("row_id"),
        "baby_id": F.col("baby_id"),
        "notes": _note(),
        "created_at": F.col(at),
        "updated_at": F.col(at),
        "source": F.lit(K.INGESTED),
        **values,
    }
    return schemas.completed(rows, schemas.with_source(schemas.TABLES[table]), known)


def ingest_diapers(rows: DataFrame) -> DataFrame:
    status = F.coalesce(X.strip(F.col("Status")), F.lit(""))
    rows = rows.withColumns(
        {
            "at": _event_time(),
            "urine": status.isin(*K.URINE_STATUSES),
            "stool": status.isin(*K.STOOL_STATUSES),
        }
    )
    stool = F.col("stool")
    return _as_table(
        rows,
        "diaper_events",
        "at",
        timestamp=F.col("at"),
        has_urine=F.col("urine"),
        urine_volume=F.when(F.col("urine"), K.URINE_PRESENT).otherwise(K.URINE_ABSENT),
        has_stool=stool,
        stool_consistency=F.when(stool, K.STOOL_CONSISTENCY),
        stool_color=F.when(stool, K.STOOL_COLOR),
        diaper_type=F.lit(K.DIAPER_TYPE),
    )


def ingest_sleeps(rows: DataFrame) -> DataFrame:
    """Rows without a duration (still running when exported) are left out."""
    minutes = X.parse_int(F.col("Duration (min)"))
    rows = rows.where(X.blank_to_null(F.col("Duration (min)")).isNotNull()).withColumns(
        {"begin": _event_time(), "minutes": minutes}
    )
    return _as_table(
        rows,
        "sleep_sessions",
        "begin",
        start_time=F.col("begin"),
        end_time=T.plus_minutes(F.col("begin"), F.col("minutes")),
        sleep_type=T.sleep_label(F.col("begin"), F.col("minutes")),
        location=F.lit(K.SLEEP_LOCATION),
        wake_reason=F.lit(K.WAKE_REASON),
    )


def _timed_feed(rows: DataFrame, total: str) -> DataFrame:
    """Start, end and side fields shared by nursing and pumping; a blank total lasts 0 minutes."""
    side = X.strip(F.col("Start side"))
    return rows.withColumns(
        {
            "begin": _event_time(),
            "minutes": F.coalesce(X.parse_int(F.col(total)), F.lit(0)),
            "side": F.when(side.isin(*K.START_SIDES), F.upper(side)),
            "left": X.parse_int(F.col("Left duration (min)")),
            "right": X.parse_int(F.col("Right Duration (min)")),
        }
    )


def _sided(rows: DataFrame, **values: Column) -> DataFrame:
    return _as_table(
        rows,
        "feeding_sessions",
        "begin",
        start_time=F.col("begin"),
        end_time=T.plus_minutes(F.col("begin"), F.col("minutes")),
        breast_started=F.col("side"),
        left_breast_duration=F.col("left"),
        right_breast_duration=F.col("right"),
        **values,
    )


def ingest_nursing(rows: DataFrame) -> DataFrame:
    return _sided(_timed_feed(rows, "Total (min)"), feeding_type=F.lit(K.BREAST))


def ingest_pump(rows: DataFrame) -> DataFrame:
    """Pumped milk counts as a bottle: everything offered was consumed."""
    amount = X.parse_int(F.col("Total amount (ml)"))
    return _sided(
        _timed_feed(rows, "Total duration (min)").withColumn("amount", amount),
        feeding_type=F.lit(K.BOTTLE),
        volume_offered_ml=F.col("amount"),
        volume_consumed_ml=F.col("amount"),
    )


def ingest_expressed(rows: DataFrame) -> DataFrame:
    """Expressed milk has an amount but no duration."""
    rows = rows.withColumns({"begin": _event_time(), "amount": X.parse_int(F.col("Amount (ml)"))})
    return _as_table(
        rows,
        "feeding_sessions",
        "begin",
        start_time=F.col("begin"),
        end_time=F.col("begin"),
        feeding_type=F.lit(K.BOTTLE),
        volume_offered_ml=F.col("amount"),
        volume_consumed_ml=F.col("amount"),
    )


def ingest_feeds(nursing: DataFrame, pump: DataFrame, expressed: DataFrame) -> DataFrame:
    """The three feeding kinds as one relation; nothing is deduplicated."""
    return (
        ingest_nursing(nursing)
        .unionByName(ingest_pump(pump))
        .unionByName(ingest_expressed(expressed))
    )


def ingest(exports: dict[str, DataFrame], subjects: DataFrame) -> dict[str, DataFrame]:
    """Export text of every kind to the three event tables."""
    registry = _registry(subjects)
    rows = {kind: frame.join(registry, "subject") for kind, frame in exports.items()}
    return {
        "diaper_events": ingest_diapers(rows["diaper"]),
        "feeding_sessions": ingest_feeds(rows["nursing"], rows["pump"], rows["expressed"]),
        "sleep_sessions": ingest_sleeps(rows["sleep"]),
    }
