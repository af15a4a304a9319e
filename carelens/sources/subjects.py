"""The subject registry and the profile rows built from it."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens import constants as K
from carelens import schemas
from carelens.functions.ids import uuid5

REGISTRY = schemas.columns(
    "name STRING, date_of_birth DATE, gender STRING, timezone STRING, datetime_format STRING, "
    "birth_weight DOUBLE, birth_length DOUBLE, birth_head_circumference DOUBLE, notes STRING"
)
REQUIRED = ("name", "date_of_birth", "gender", "timezone")
_DEFAULTS = {"datetime_format": K.DEFAULT_DATETIME_FORMAT, "notes": K.DEFAULT_PROFILE_NOTES}


def registry(spark: SparkSession, subjects: Iterable[dict]) -> DataFrame:
    """A registry from configuration entries; missing required fields raise.

    A registry kept as a table with the same columns works everywhere this one does.
    """
    known = set(REGISTRY.fieldNames())
    rows = []
    for entry in subjects:
        unknown = set(entry) - known
        if unknown:
            raise ValueError(f"unknown subject fields: {sorted(unknown)}")
        missing = [name for name in REQUIRED if not entry.get(name)]
        if missing:
            raise ValueError(f"subject lacks {', '.join(missing)}: {entry}")
        row = {**_DEFAULTS, **entry}
        foreign = set(re.findall("%.?", row["datetime_format"])) - set(K.DATETIME_DIRECTIVES)
        if foreign:
            raise ValueError(f"time format of {row['name']} has {', '.join(sorted(foreign))}, which is not understood")
        if isinstance(row.get("date_of_birth"), str):
            row["date_of_birth"] = date.fromisoformat(row["date_of_birth"])
        rows.append(tuple(row.get(name) for name in REGISTRY.fieldNames()))
    return spark.createDataFrame(rows, REGISTRY)


def with_subject_ids(subjects: DataFrame) -> DataFrame:
    """The same name always has the same id, on every run and in every table."""
    return subjects.withColumn("baby_id", uuid5(K.SUBJECT_NAMESPACE, F.col("name")))


def list_subjects(subjects: DataFrame) -> DataFrame:
    return with_subject_ids(subjects).select("name", "date_of_birth", "baby_id")


def only_subject(subjects: DataFrame, name: str) -> DataFrame:
    """One subject by name, in any letter case; an unknown name raises."""
    found = subjects.where(F.lower("name") == name.lower())
    if found.isEmpty():
        raise LookupError(f"no subject called {name!r} is registered")
    return found


def profiles_from(subjects: DataFrame, as_of: datetime) -> DataFrame:
    """Profile rows as loaded: created at birth, updated ``as_of``, active."""
    values = {
        "id": F.col("baby_id"),
        "created_at": F.col("date_of_birth").cast("timestamp_ntz"),
        "updated_at": F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"),
        "is_active": F.lit(True),
        "source": F.lit(K.INGESTED),
    }
    return with_subject_ids(subjects).select(
        *(
            values.get(f.name, F.col(f.name)).alias(f.name)
            for f in schemas.with_source(schemas.PROFILES)
        )
    )
