"""Registered queries and their SQL answers.

Every query reads the whole tables of one scale-factor directory.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries as oracle  # noqa: E402
from carelens import constants as K  # noqa: E402
from carelens import schemas  # noqa: E402
from carelens.functions import text as X  # noqa: E402
from carelens.functions import time as T  # noqa: E402
from carelens.operators import compare, daily, ingest, quality, sleep, staging  # noqa: E402
from carelens.plans import load as loading  # noqa: E402
from carelens.plans.build import PUBLISHED, ChecksFailed, build, ingest_changed, ingest_exports, publish, relations  # noqa: E402
from carelens.plans.mart import mart_daily_metrics  # noqa: E402
from carelens.plans.refresh import refresh_mart  # noqa: E402
from carelens.session import remove, scratch_path  # noqa: E402
from carelens.sources import subjects as registry  # noqa: E402
from carelens.sources.exports import read_all_exports  # noqa: E402
from carelens.sources.fixtures import Fixture, export_time  # noqa: E402
from carelens.sources.tables import create_table, raw, raw_relations, read_text, table_name, write_text  # noqa: E402

try:
    from carelens.llm import queries as corpus  # noqa: E402
except ModuleNotFoundError as missing:  # the corpus operators can be taken out; nothing else needs them
    if not (missing.name or "").startswith(("carelens.llm", "corpus_pipeline")):
        raise
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 2, 1)
DAY_FIRST = "%d/%m/%y %I:%M %p"
COMPARED_SUBJECT = 7


def entry(spark: SparkSession) -> DataFrame:
    """The daily metrics of every subject; ``CARELENS_SF_DIR`` names other tables than the smallest ones."""
    return _mart(Fixture(spark, os.environ.get("CARELENS_SF_DIR", "/root/testdata/sf0.001")))


def _on(build: Callable[[Fixture], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Fixture(spark, sf_dir))


def _mart(fixture: Fixture) -> DataFrame:
    return mart_daily_metrics(fixture.profiles, fixture.sleeps, fixture.feeds, fixture.diapers)


def _raw(table: str) -> Query:
    return _on(lambda f: raw(f.relations()[table], table))


# Ingest: text rendered from the events table, parsed back.


def _export(f: Fixture, kind: str) -> DataFrame:
    """Rows as an export reader returns them; the event's number serves as row id."""
    rows = f.export_rows(kind).withColumnRenamed("event_id", "row_id")
    return ingest.attach_subjects(rows, f.subjects)


def _parsed_times(f: Fixture) -> DataFrame:
    day_first, month_first = F.lit(DAY_FIRST), F.lit(K.DEFAULT_DATETIME_FORMAT)
    odd = F.col("event_id") % 2 == 1
    american = F.date_format("ts", "M/d/yy h:mm a")
    text = F.when(odd, american).otherwise(export_time(F.col("ts")))
    parsed = T.parse_export_time(text, F.when(odd, month_first).otherwise(day_first))
    return f.events.select(
        "event_id", parsed.alias("parsed"), T.format_timestamp(parsed).alias("rendered")
    )


def _parsed_amounts(f: Fixture) -> DataFrame:
    thousandfold = F.col("mins") * 1000
    text = F.concat(F.lit("  "), F.format_number(thousandfold, 0), F.lit(" "))
    blank = F.col("event_id") % 5 == 0
    decimal = F.concat(F.format_number(thousandfold, 0), F.lit(".25"))
    return f.events.select(
        "event_id",
        X.parse_int(F.when(blank, "  ").otherwise(text)).alias("whole"),
        X.parse_float(F.when(blank, "").otherwise(decimal)).alias("fractional"),
    )


def _typed(f: Fixture) -> DataFrame:
    n = F.col("event_id")
    text = f.events.select(
        n.cast("string").alias("id"),
        F.when(n % 2 == 0, "True").otherwise("false").alias("has_urine"),
        F.when(n % 3 == 0, "").otherwise(F.col("mins").cast("string")).alias("volume_offered_ml"),
        F.when(n % 4 == 0, "").otherwise(F.concat(F.col("mins").cast("string"), F.lit(".5"))).alias("weight_kg"),
        F.when(n % 7 == 0, "").otherwise(F.col("event_type")).alias("notes"),
    )
    target = schemas.columns(
        "id STRING, has_urine BOOLEAN, volume_offered_ml INT, weight_kg DOUBLE, notes STRING"
    )
    return X.typed_projection(text, target)


def _subject_ids(f: Fixture) -> DataFrame:
    named = f.table("customer").select(
        F.concat(F.col("c_name"), F.lit(" ü")).alias("name"),
        F.lit("2024-01-01").cast("date").alias("date_of_birth"),
    )
    return registry.list_subjects(named)


def _profiles(f: Fixture) -> DataFrame:
    return registry.profiles_from(f.subjects, AS_OF)


def _write_exports(f: Fixture, folder: str) -> DataFrame:
    """Every kind as export files, one per nation; returns the registry of the nations as subjects."""
    nation = F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"))
    members = f.table("customer").select(
        F.concat(F.lit("subject-"), F.col("c_custkey").cast("string")).alias("subject"), nation.alias("nation")
    )
    for kind in K.EXPORT_KINDS:
        rows = f.export_rows(kind).join(members, "subject").drop("subject", "event_id")
        columns = [c for c in rows.columns if c != "nation"]
        # Files of one kind come in two layouts. Each write adds its own directories to the folder.
        other = F.hash("nation") % 2 == 0
        for part, order in ((rows.where(~other), columns), (rows.where(other), columns[::-1])):
            named = part.select(*order, F.concat(F.col("nation"), F.lit(f"_{kind}.csv")).alias("file"))
            named.hint("rebalance", F.col("file")).write.mode("append").partitionBy("file").option("header", True).csv(folder)
    return f.table("nation").select(
        F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("name"),
        F.date_add(F.lit("2023-06-01").cast("date"), F.col("n_nationkey").cast("int")).alias("date_of_birth"),
        F.lit("other").alias("gender"),
        F.lit("UTC").alias("timezone"),
        F.lit(DAY_FIRST).alias("datetime_format"),
        *(F.lit(None).cast("double").alias(c) for c in ("birth_weight", "birth_length", "birth_head_circumference")),
        F.lit(K.DEFAULT_PROFILE_NOTES).alias("notes"),
    )


def _exports_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every kind as export files, find and parse them again."""
    folder = scratch_path(spark, "exports")
    nations = _write_exports(Fixture(spark, sf_dir), folder)
    return _events(ingest.ingest(read_all_exports(spark, folder), nations))


def _events(tables: dict[str, DataFrame]) -> DataFrame:
    """What ingested tables say of every event, in one relation."""
    shown = {
        "diaper_events": ("timestamp", "timestamp", "urine_volume"),
        "feeding_sessions": ("start_time", "end_time", "feeding_type"),
        "sleep_sessions": ("start_time", "end_time", "sleep_type"),
    }
    parts = (
        tables[name].select(
            F.lit(name).alias("table_name"),
            "baby_id",
            F.col(begin).alias("begins"),
            F.col(end).alias("ends"),
            F.col(label).alias("label"),
            "notes",
            "source",
        )
        for name, (begin, end, label) in shown.items()
    )
    return reduce(DataFrame.unionByName, parts)


def _changed_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of a few subjects loaded, then those of all others once these are registered, then nothing more."""
    folder = scratch_path(spark, "exports")
    nations = _write_exports(Fixture(spark, sf_dir), folder)
    base = _new_base(spark)
    loading.create_tables(spark, base)
    for registered in (nations.where("name < 'nation-2'"), nations, nations):
        ingest_changed(spark, folder, registered, base, AS_OF)
    return _events({table: spark.table(table_name(base, table)) for table in schemas.EVENT_TABLES})


def _one_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of one subject alone, found and loaded."""
    folder = scratch_path(spark, "exports")
    nations = _write_exports(Fixture(spark, sf_dir), folder)
    base = _new_base(spark)
    loading.create_tables(spark, base)
    ingest_exports(spark, folder, nations, base, AS_OF, only="NATION-7")
    return _events({table: spark.table(table_name(base, table)) for table in schemas.EVENT_TABLES})


def _built_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All the way: exports are written, found, loaded and built, and the published table is read."""
    folder = scratch_path(spark, "exports")
    nations = _write_exports(Fixture(spark, sf_dir), folder)
    base = _new_base(spark)
    loading.create_tables(spark, base)
    ingest_exports(spark, folder, nations, base, AS_OF)
    # A nation's events are many subjects' together, so their days go beyond what one subject's may have.
    bounds = [check for check in quality.row_checks("mart_daily_metrics") if not check.endswith("is null")]
    built = build(spark, base, f"built_{uuid.uuid4().hex}", "ci", scratch_path(spark, "marts"), bounds)
    remove(spark, folder)
    spark.sql(f"DROP DATABASE {base} CASCADE")
    return built["mart_daily_metrics"]


def _new_base(spark: SparkSession) -> str:
    """A database of its own in the shared folder."""
    base = f"base_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{scratch_path(spark, 'base')}'")
    return base


def _new_table(spark: SparkSession, table: str, rows: DataFrame) -> str:
    """A table of its own that holds the rows."""
    name = table_name(_new_base(spark), table)
    create_table(spark, name, rows.schema)
    loading.append_rows(rows, name)
    return name


def _text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested feeds written as transformed CSV and read back typed."""
    f, path = Fixture(spark, sf_dir), scratch_path(spark, "feeding_sessions_csv")
    rows = ingest.ingest_feeds(_export(f, "nursing"), _export(f, "pump"), _export(f, "expressed"))
    write_text(rows, "feeding_sessions", path)
    return read_text(spark, "feeding_sessions", path)


# Loads: small histories on stored tables, returning what the table holds afterwards.


def _stored_sleeps(f: Fixture) -> DataFrame:
    """Sleeps as first stored: naps entered in the app, nights loaded from exports."""
    tag = F.when(F.col("sleep_type") == K.NAP, K.APP).otherwise(K.INGESTED)
    return f.sleeps.withColumn("source", tag)


def _tagged_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Fixture(spark, sf_dir)
    name = _new_table(spark, "sleep_sessions", _stored_sleeps(f))
    batch = f.sleeps.withColumn("notes", F.lit("reloaded"))
    loading.tagged_replace(batch, name)
    loading.tagged_replace(batch, name)
    return spark.table(name).select("id", "baby_id", "start_time", "end_time", "sleep_type", "notes", "source")


def _subject_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reload the subjects of one market segment only; all others keep their ingested rows."""
    f = Fixture(spark, sf_dir)
    name = _new_table(spark, "sleep_sessions", _stored_sleeps(f))
    chosen = f.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("baby_id"))
    batch = f.sleeps.join(chosen, "baby_id", "left_semi").select(f.sleeps.columns)
    batch = batch.withColumn("notes", F.lit("reloaded")).withColumn("source", F.lit(K.INGESTED))
    loading.subject_replace(batch, chosen, name)
    return spark.table(name).select("id", "baby_id", "start_time", "end_time", "sleep_type", "notes", "source")


def _profile_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update the profiles of one market segment and add one profile per supplier."""
    f = Fixture(spark, sf_dir)
    stored = f.profiles.withColumn("source", F.lit(K.APP))
    name = _new_table(spark, "baby_profiles", stored)
    changed = f.table("customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("id"), F.concat(F.col("c_name"), F.lit(" renamed")).alias("name")
    )
    added = f.table("supplier").select((-1 - F.col("s_suppkey")).cast("bigint").alias("id"), F.col("s_name").alias("name"))
    batch = stored.limit(0).unionByName(
        changed.unionByName(added).withColumn("source", F.lit(K.INGESTED)), allowMissingColumns=True
    )
    loading.upsert(batch, name)
    return spark.table(name).select("id", "name", "date_of_birth", "is_active", "source")


def _loaded(spark: SparkSession, sf_dir: str, times: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load all exports of the fixture into new tables that already hold app rows."""
    f, base = Fixture(spark, sf_dir), _new_base(spark)
    loading.create_tables(spark, base)
    by_hand = ingest.ingest_diapers(_export(f, "diaper")).withColumn("id", F.col("id").cast("string"))
    loading.append_rows(by_hand.withColumn("source", F.lit(K.APP)), table_name(base, "diaper_events"))
    events = ingest.ingest({kind: f.export_rows(kind).withColumn("row_id", F.col("event_id").cast("string"))
                            for kind in K.EXPORT_KINDS}, f.subjects)
    before = _kept(loading.stored_counts(spark, base))
    for _ in range(times):
        report = loading.load(spark, base, _profiles(f), events)
    return report, before, loading.stored_counts(spark, base)


def _kept(counts: DataFrame) -> DataFrame:
    """A handful of counts as they are now, not as they will be when next read."""
    return counts.sparkSession.createDataFrame(counts.collect(), counts.schema)


# Data checks on relations that the whole tables are broken into, so that each check has something to find.


def _broken_relations(f: Fixture) -> dict[str, DataFrame]:
    """Every checked column NULL in each 97th row or so, told by the row's own number; every 89th row twice."""
    built = {
        "stg_sleep_sessions": (staging.stage_sleeps(f.sleeps, f.profiles), "sleep_id"),
        "stg_feeding_sessions": (staging.stage_feeds(f.feeds, f.profiles), "feeding_id"),
        "stg_diaper_events": (staging.stage_diapers(f.diapers, f.profiles), "diaper_id"),
        "fct_sleep_sessions": (sleep.fct_sleep_sessions(f.sleeps, f.profiles), "sleep_id"),
        "fct_wake_windows": (sleep.fct_wake_windows(f.sleeps, f.profiles), "baby_id"),
        "mart_daily_metrics": (_mart(f), "baby_id"),
    }
    return {name: _broken(rows, key, K.NOT_NULL_COLUMNS[name]) for name, (rows, key) in built.items()}


def _broken(rows: DataFrame, key: str, checked: tuple[str, ...]) -> DataFrame:
    copies = F.when(F.col(key) % 89 == 0, 2).otherwise(1)
    doubled = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    spoiled = {c: F.when(F.col(key) % 97 != i, F.col(c)) for i, c in enumerate(checked, 1)}
    return doubled.withColumns(spoiled)


def _broken_feeds(f: Fixture) -> DataFrame:
    kinds = F.when(F.col("feeding_id") % 83 == 0, F.lower("feeding_type")).otherwise(F.col("feeding_type"))
    return staging.stage_feeds(f.feeds, f.profiles).withColumn("feeding_type", kinds)


def _broken_days(f: Fixture) -> DataFrame:
    """Subject by subject another bound is broken, and every 29th subject has each day twice."""
    days, case = _mart(f), F.col("baby_id") % 11
    beyond = {
        "night_sleep_minutes": F.when(case == 0, -1).when(case == 1, 1081),
        "total_nap_minutes": F.when(case == 2, -1).when(case == 3, 721),
        "nap_count": F.when(case == 4, 16),
        "feed_count": F.when(case == 5, 31),
        "diaper_count": F.when(case == 6, 26),
        "age_days": F.when(case == 7, -1),
    }
    spoiled = {c: F.coalesce(value, F.col(c)).cast(days.schema[c].dataType).alias(c) for c, value in beyond.items()}
    copies = F.when(F.col("baby_id") % 29 == 0, 2).otherwise(1)
    return days.withColumns(spoiled).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


def _refused(f: Fixture) -> tuple[str, list[tuple[str, str, int]]]:
    """Publish the facts and the mart, then try to publish broken ones: the database, and why they were refused."""
    spark, database = f.spark, f"published_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'published')}'")
    sound, broken, found = relations(raw_relations(f.relations())), _broken_relations(f), []
    for name, order in PUBLISHED.items():
        publish(sound[name], database, name, order)
        try:
            publish(broken[name], database, name, order, name)
        except ChecksFailed as failed:
            found += failed.violations
    return database, found


def _refused_report(f: Fixture) -> DataFrame:
    _, found = _refused(f)
    return f.spark.createDataFrame(found, "relation string, check_name string, violations long")


def _refused_mart(f: Fixture) -> DataFrame:
    """What readers find after a broken mart was refused."""
    database, _ = _refused(f)
    return f.spark.table(f"{database}.mart_daily_metrics")


def _checked_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a build from stored tables, whatever they find."""
    f, base = Fixture(spark, sf_dir), _new_base(spark)
    loading.create_tables(spark, base)
    for table in schemas.LOADED_TABLES:
        rows, kinds = f.relations()[table].withColumn("source", F.lit(K.APP)), schemas.with_source(schemas.TABLES[table])
        loading.append_rows(rows.select(*(F.col(k.name).cast(k.dataType).alias(k.name) for k in kinds)), table_name(base, table))
    built = build(spark, base, f"built_{uuid.uuid4().hex}", "ci", scratch_path(spark, "marts"), quality.check_names())
    return built["data_checks"]


def _refreshed_mart(f: Fixture) -> DataFrame:
    """The mart after a first refresh that lacks some subjects' sleeps, a load that brings them, and a second refresh."""
    spark, base = f.spark, _new_base(f.spark)
    late = f.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("baby_id"))
    rows = {table: f.relations()[table].withColumn("source", F.lit(K.INGESTED)) for table in schemas.LOADED_TABLES}
    sleeps = rows["sleep_sessions"]
    rows["sleep_sessions"] = sleeps.join(late, "baby_id", "left_anti").select(sleeps.columns)
    for table, loaded in rows.items():
        create_table(spark, table_name(base, table), loaded.schema)
        loading.append_rows(loaded, table_name(base, table))
    refresh_mart(spark, base, base, quality.check_names())
    loading.subject_replace(sleeps, late, table_name(base, "sleep_sessions"))
    refresh_mart(spark, base, base, quality.check_names())
    return spark.table(table_name(base, "mart_daily_metrics"))


def _named_profiles(f: Fixture) -> DataFrame:
    """The profile of the one subject called for, of a registry with an entry per customer."""
    called = f.table("customer").select(
        F.col("c_name").alias("name"),
        F.lit("2024-01-01").cast("date").alias("date_of_birth"),
        F.lit("other").alias("gender"),
        F.lit("UTC").alias("timezone"),
        F.lit(DAY_FIRST).alias("datetime_format"),
        *(F.lit(None).cast("double").alias(c) for c in ("birth_weight", "birth_length", "birth_head_circumference")),
        F.lit(K.DEFAULT_PROFILE_NOTES).alias("notes"),
    )
    return registry.profiles_from(registry.only_subject(called, "cUsToMeR#000000007"), AS_OF)


def queries() -> dict[str, Query]:
    return _care_queries() | (corpus.queries() if corpus else {})


def _care_queries() -> dict[str, Query]:
    return {
        "raw_profiles": _raw("baby_profiles"),
        "raw_diaper": _raw("diaper_events"),
        "raw_feeding": _raw("feeding_sessions"),
        "raw_growth": _raw("growth_measurements"),
        "raw_health": _raw("health_events"),
        "raw_sleep": _raw("sleep_sessions"),
        "parse_export_time": _on(_parsed_times),
        "parse_amounts": _on(_parsed_amounts),
        "typed_convert": _on(_typed),
        "subject_uuid5": _on(_subject_ids),
        "profiles_from_registry": _on(_profiles),
        "profile_by_name": _on(_named_profiles),
        "ingest_diaper": _on(lambda f: ingest.ingest_diapers(_export(f, "diaper"))),
        "ingest_sleep": _on(lambda f: ingest.ingest_sleeps(_export(f, "sleep"))),
        "ingest_feeding": _on(
            lambda f: ingest.ingest_feeds(_export(f, "nursing"), _export(f, "pump"), _export(f, "expressed"))
        ),
        "exports_roundtrip": _exports_roundtrip,
        "ingest_changed": _changed_exports,
        "ingest_one_subject": _one_subject,
        "transformed_csv": _text_roundtrip,
        "tagged_replace": _tagged_replace,
        "subject_replace": _subject_replace,
        "profile_upsert": _profile_upsert,
        "load_report": lambda spark, sf_dir: _loaded(spark, sf_dir, 1)[0],
        "reload_report": lambda spark, sf_dir: loading.reload_report(*_loaded(spark, sf_dir, 2)[1:]),
        "stg_sleep": _on(lambda f: staging.stage_sleeps(f.sleeps, f.profiles)),
        "stg_feeding": _on(lambda f: staging.stage_feeds(f.feeds, f.profiles)),
        "stg_diaper": _on(lambda f: staging.stage_diapers(f.diapers, f.profiles)),
        "fct_sleep_sessions": _on(lambda f: sleep.fct_sleep_sessions(f.sleeps, f.profiles)),
        "sleep_neighbours": _on(lambda f: sleep.sleep_neighbours(f.sleeps)),
        "fct_wake_windows": _on(lambda f: sleep.fct_wake_windows(f.sleeps, f.profiles)),
        "event_bounds": _on(lambda f: daily.event_bounds(f.profiles, f.sleeps, f.feeds, f.diapers)),
        "date_spine": _on(lambda f: daily.date_spine(f.profiles, f.sleeps, f.feeds, f.diapers)),
        "night_sleep": _on(lambda f: daily.night_sleep(f.profiles, f.sleeps)),
        "night_wakings": _on(lambda f: daily.night_wakings(f.profiles, f.sleeps)),
        "naps": _on(lambda f: daily.naps(f.profiles, f.sleeps)),
        "feeds": _on(lambda f: daily.feeds(f.profiles, f.feeds)),
        "feed_intervals": _on(lambda f: daily.feed_intervals(f.profiles, f.feeds)),
        "daily_wake_windows": _on(lambda f: daily.daily_wake_windows(f.profiles, f.sleeps)),
        "nappies": _on(lambda f: daily.nappies(f.profiles, f.diapers)),
        "mart_daily_metrics": _on(_mart),
        "built_mart": _built_mart,
        "mart_from_groups": _on(lambda f: daily.daily_from_groups(f.profiles, f.sleeps, f.feeds, f.diapers)),
        "compare_age_days": _on(lambda f: compare.compare(_mart(f), _pairs(f), "age_days")),
        "compare_age_weeks": _on(lambda f: compare.compare(_mart(f), _pairs(f), "age_weeks")),
        "weekly_summary": _on(lambda f: compare.weekly_overlap(_mart(f), _pairs(f))),
        "weekly_summary_all_ages": _on(lambda f: compare.weekly_summary(_mart(f))),
        "subject_daily": _on(lambda f: compare.subject_daily(_mart(f), COMPARED_SUBJECT)),
        "dq_not_null": _on(lambda f: quality.not_null_report(relations(raw_relations(f.relations())))),
        "dq_unique": _on(lambda f: quality.unique_report(relations(raw_relations(f.relations())))),
        "dq_accepted_values": _on(lambda f: quality.accepted_values_report(staging.stage_feeds(f.feeds, f.profiles))),
        "dq_grain": _on(lambda f: quality.grain_report(_mart(f))),
        "dq_ranges": _on(lambda f: quality.range_report(_mart(f))),
        "dq_range_rows": _on(lambda f: quality.range_violations(_mart(f))),
        "mart_refreshed": _on(_refreshed_mart),
        "build_checks": _checked_build,
        "publish_refused": _on(_refused_report),
        "publish_keeps_old": _on(_refused_mart),
        "dq_not_null_broken": _on(lambda f: quality.not_null_report(_broken_relations(f))),
        "dq_unique_broken": _on(lambda f: quality.unique_report(_broken_relations(f))),
        "dq_accepted_values_broken": _on(lambda f: quality.accepted_values_report(_broken_feeds(f))),
        "dq_grain_broken": _on(lambda f: quality.grain_report(_broken_days(f))),
        "dq_ranges_broken": _on(lambda f: quality.range_report(_broken_days(f))),
        "dq_range_rows_broken": _on(lambda f: quality.range_violations(_broken_days(f))),
    }


def _pairs(f: Fixture) -> DataFrame:
    """Every subject next to the one registered after it."""
    return f.profiles.select(F.col("id").alias("left_id"), (F.col("id") + 1).alias("right_id"))


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (corpus.oracle_sql() if corpus else {})
