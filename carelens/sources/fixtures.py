"""Care-event relations derived from the driver's test tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens import constants as K
from carelens import schemas
from carelens.functions.time import div, plus_minutes, sleep_label


class Fixture:
    """Lazy relations over one scale-factor directory; nothing is read before it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def relations(self) -> dict[str, DataFrame]:
        return {
            "baby_profiles": self.profiles,
            "diaper_events": self.diapers,
            "feeding_sessions": self.feeds,
            "growth_measurements": self.growth,
            "health_events": self.health,
            "sleep_sessions": self.sleeps,
        }

    @cached_property
    def events(self) -> DataFrame:
        second = F.date_trunc("second", "ts").cast("timestamp_ntz")
        return self.table("events").select(
            "event_id",
            div(F.col("user_id"), 3).alias("baby_id"),
            "event_type",
            "ts",
            second.alias("st"),
            F.floor("value").cast("int").alias("mins"),
        )

    @cached_property
    def profiles(self) -> DataFrame:
        born = F.date_add(F.lit("2023-06-01").cast("date"), (F.col("c_custkey") % 200).cast("int"))
        return _complete(
            self.table("customer"),
            "baby_profiles",
            id=F.col("c_custkey"),
            name=F.col("c_name"),
            date_of_birth=born,
            is_active=F.lit(True),
        )

    @cached_property
    def sleeps(self) -> DataFrame:
        rows = self.events.where(F.col("event_type").isin("view", "error"))
        return _complete(
            rows,
            "sleep_sessions",
            id=F.col("event_id"),
            baby_id=F.col("baby_id"),
            start_time=F.col("st"),
            end_time=plus_minutes(F.col("st"), F.col("mins")),
            sleep_type=sleep_label(F.col("st"), F.col("mins")),
            created_at=F.col("st"),
            updated_at=F.col("st"),
        )

    @cached_property
    def feeds(self) -> DataFrame:
        rows = self.events.where(F.col("event_type").isin("click", "purchase"))
        n, mins, st = F.col("event_id"), F.col("mins"), F.col("st")
        bottle = F.col("event_type") == "purchase"
        solid = ~bottle & (n % 10 == 9)
        breast = ~bottle & ~solid
        even = n % 2 == 0
        left = div(mins, 2).cast("int")
        volume = F.when(bottle & (n % 5 != 0), mins)
        return _complete(
            rows,
            "feeding_sessions",
            id=n,
            baby_id=F.col("baby_id"),
            start_time=st,
            end_time=F.when(bottle & even, st).otherwise(plus_minutes(st, mins)),
            feeding_type=F.when(bottle, K.BOTTLE).when(solid, K.SOLID).otherwise(K.BREAST),
            breast_started=F.when(breast, F.when(even, "LEFT").otherwise("RIGHT")),
            left_breast_duration=F.when(breast & (n % 3 != 0), left),
            right_breast_duration=F.when(breast & (n % 4 != 0), mins - left),
            volume_offered_ml=volume,
            volume_consumed_ml=volume,
            created_at=st,
            updated_at=st,
        )

    @cached_property
    def diapers(self) -> DataFrame:
        rows = self.events.where(F.col("event_type") == "signup")
        kind = F.col("event_id") % 4
        return _complete(
            rows,
            "diaper_events",
            id=F.col("event_id"),
            baby_id=F.col("baby_id"),
            timestamp=F.col("st"),
            has_urine=kind.isin(0, 2),
            has_stool=kind.isin(1, 2),
            created_at=F.col("st"),
            updated_at=F.col("st"),
        )

    @cached_property
    def growth(self) -> DataFrame:
        return _complete(
            self.table("orders"),
            "growth_measurements",
            id=F.col("o_orderkey"),
            baby_id=F.col("o_custkey"),
            measurement_date=F.col("o_orderdate").cast("date"),
            weight_kg=F.col("o_totalprice"),
        )

    @cached_property
    def health(self) -> DataFrame:
        return _complete(
            self.table("orders"),
            "health_events",
            id=F.col("o_orderkey"),
            baby_id=F.col("o_custkey"),
            event_date=F.col("o_orderdate"),
            event_type=F.col("o_orderpriority"),
            temperature_celsius=F.col("o_totalprice"),
        )

    # Export text, as the tracker app would have written it.

    def export_rows(self, kind: str) -> DataFrame:
        """Rows of one export kind as text, plus ``subject`` and ``event_id``.

        Sleeps come from view/error, nursing from click, pump and expressed
        from odd and even purchases, diapers from signup events.
        """
        n = F.col("event_id")
        rows = {
            "sleep": self.events.where(F.col("event_type").isin("view", "error")),
            "nursing": self.events.where(F.col("event_type") == "click"),
            "pump": self.events.where((F.col("event_type") == "purchase") & (n % 2 == 1)),
            "expressed": self.events.where((F.col("event_type") == "purchase") & (n % 2 == 0)),
            "diaper": self.events.where(F.col("event_type") == "signup"),
        }[kind]
        mins = F.col("mins")
        minutes = mins.cast("string")
        amount = F.when(n % 5 != 0, F.format_number(mins * 10, 0))
        left = div(mins, 2)
        status = F.element_at(F.array(*map(F.lit, ("Wet", "Dirty", "Mixed", "Dry"))), (n % 4 + 1).cast("int"))
        text = {
            "Time": export_time(F.col("ts")),
            "Note": F.concat(F.lit("  note "), n.cast("string"), F.lit(" ")),
            "Status": status,
            "Duration (min)": F.when(n % 11 != 0, minutes),
            "Start side": F.when(n % 7 == 0, "").when(n % 2 == 0, "Left").otherwise("Right"),
            "Left duration (min)": F.when(n % 3 != 0, left.cast("string")),
            "Right Duration (min)": F.when(n % 4 != 0, (mins - left).cast("string")),
            "Total (min)": F.when(n % 13 != 0, minutes),
            "Total duration (min)": F.when(n % 13 != 0, minutes),
            "Total amount (ml)": amount,
            "Amount (ml)": amount,
        }
        columns = [text[name].alias(name) for name in K.EXPORT_COLUMNS[kind]]
        subject = F.concat(F.lit("subject-"), F.col("baby_id").cast("string"))
        return rows.select(subject.alias("subject"), "event_id", *columns)

    @cached_property
    def subjects(self) -> DataFrame:
        """The registry: one subject per customer, all exporting day-first times."""
        born = F.date_add(F.lit("2023-06-01").cast("date"), (F.col("c_custkey") % 200).cast("int"))
        return self.table("customer").select(
            F.concat(F.lit("subject-"), F.col("c_custkey").cast("string")).alias("name"),
            born.alias("date_of_birth"),
            F.lit("other").alias("gender"),
            F.lit("UTC").alias("timezone"),
            F.lit("%d/%m/%y %I:%M %p").alias("datetime_format"),
            F.lit(None).cast("double").alias("birth_weight"),
            F.lit(None).cast("double").alias("birth_length"),
            F.lit(None).cast("double").alias("birth_head_circumference"),
            F.lit(K.DEFAULT_PROFILE_NOTES).alias("notes"),
        )


def export_time(ts: Column) -> Column:
    """Day-first, lower case, with a narrow no-break space before am/pm."""
    return F.concat(
        F.date_format(ts, "d/M/yy h:mm"), F.lit("\u202f"), F.lower(F.date_format(ts, "a"))
    )


def _complete(rows: DataFrame, table: str, **known: Column) -> DataFrame:
    return schemas.completed(rows, schemas.TABLES[table], known)
