"""Schemas of the six source tables and the columns the raw relations expose.

Timestamps are wall-clock times without a zone, so they are TIMESTAMP_NTZ
throughout. JSON payloads are passed through as text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructType,
    TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "DATE": DateType(),
    "DOUBLE": DoubleType(),
    "INT": IntegerType(),
    "BOOLEAN": BooleanType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
}


def columns(spec: str) -> StructType:
    """A schema from ``name TYPE`` pairs; unlike DDL parsing it needs no session."""
    schema = StructType()
    for pair in spec.split(", "):
        name, kind = pair.split()
        schema.add(name, _TYPES[kind])
    return schema


PROFILES = columns(
    "id STRING, name STRING, date_of_birth DATE, birth_weight DOUBLE, birth_length DOUBLE, "
    "birth_head_circumference DOUBLE, gender STRING, timezone STRING, notes STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, is_active BOOLEAN"
)
DIAPERS = columns(
    "id STRING, baby_id STRING, timestamp TIMESTAMP_NTZ, has_urine BOOLEAN, urine_volume STRING, "
    "has_stool BOOLEAN, stool_consistency STRING, stool_color STRING, diaper_type STRING, notes STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
SLEEPS = columns(
    "id STRING, baby_id STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, sleep_type STRING, "
    "location STRING, sleep_quality STRING, sleep_environment STRING, wake_reason STRING, notes STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
FEEDS = columns(
    "id STRING, baby_id STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, feeding_type STRING, "
    "breast_started STRING, left_breast_duration INT, right_breast_duration INT, volume_offered_ml INT, "
    "volume_consumed_ml INT, formula_type STRING, food_items STRING, appetite STRING, notes STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
GROWTH = columns(
    "id STRING, baby_id STRING, measurement_date DATE, weight_kg DOUBLE, length_cm DOUBLE, "
    "head_circumference_cm DOUBLE, measurement_context STRING, measured_by STRING, percentiles STRING, "
    "notes STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
HEALTH = columns(
    "id STRING, baby_id STRING, event_date TIMESTAMP_NTZ, event_type STRING, title STRING, "
    "description STRING, temperature_celsius DOUBLE, symptoms STRING, treatment STRING, "
    "healthcare_provider STRING, follow_up_required BOOLEAN, follow_up_date TIMESTAMP_NTZ, "
    "attachments STRING, notes STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

TABLES: dict[str, StructType] = {
    "baby_profiles": PROFILES,
    "diaper_events": DIAPERS,
    "feeding_sessions": FEEDS,
    "growth_measurements": GROWTH,
    "health_events": HEALTH,
    "sleep_sessions": SLEEPS,
}
# Event tables the loader replaces by tag; profiles are upserted instead.
EVENT_TABLES = ("diaper_events", "feeding_sessions", "sleep_sessions")
LOADED_TABLES = ("baby_profiles", *EVENT_TABLES)


def completed(rows: DataFrame, schema: StructType, known: Mapping[str, Column]) -> DataFrame:
    """All columns of ``schema`` in order; those not known are NULL. Known columns keep their own type."""
    return rows.select(
        *(
            known[f.name].alias(f.name)
            if f.name in known
            else F.expr(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`")
            for f in schema
        )
    )


def with_source(schema: StructType) -> StructType:
    """The stored form of a table: its columns plus the lineage tag."""
    return StructType([*schema.fields]).add("source", "string")
