"""What the plans look like: pushdown, pruning, number of shuffles, and hot subjects."""

import re
from datetime import date

import builders as B
import pytest
from pyspark.sql import functions as F

from carelens.operators import compare, daily
from carelens.operators.sleep import fct_wake_windows, sleep_neighbours
from carelens.operators.staging import stage_sleeps
from carelens.plans.mart import mart_daily_metrics
from carelens.sources.fixtures import Fixture


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Relations on disk, so that scans show what is read."""
    base = tmp_path_factory.mktemp("stored")
    day = "2024-01-0{} {:02d}:00:00"
    spans = [("a", day.format(d, h), day.format(d, h + 1)) for d in range(1, 9) for h in (9, 12, 20)]
    relations = {
        "profiles": B.profiles(spark),
        "sleeps": B.sleeps(spark, spans),
        "feeds": B.feeds(spark, [(b, s) for b, s, _ in spans]),
        "diapers": B.diapers(spark, [(b, s, True, False) for b, s, _ in spans]),
    }
    for name, rows in relations.items():
        rows.write.parquet(str(base / name))
    return {name: spark.read.parquet(str(base / name)) for name in relations}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def mart(r):
    return mart_daily_metrics(r["profiles"], r["sleeps"], r["feeds"], r["diapers"])


def test_mart_shuffles_and_reads(stored, no_broadcast):
    text = plan(mart(stored))
    # Two for sleeps, two for feeds, one for diapers, one to place days with subjects, one for profiles.
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 7
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = [{c.split(":")[0] for c in r.split(",")} for r in read]
    assert {"baby_id", "start_time", "end_time"} in columns
    assert {"baby_id", "start_time", "feeding_type", "volume_consumed_ml"} in columns
    assert {"baby_id", "timestamp", "has_urine", "has_stool"} in columns
    assert {"id", "name", "date_of_birth"} in columns


def test_subject_filter_reaches_every_scan(stored):
    text = plan(mart(stored).where("baby_id = 'a'"))
    assert len(re.findall(r"PushedFilters: \[[^\]]*EqualTo\((?:baby_id|id),a\)", text)) == 4


def test_sleep_filter_is_pushed(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    text = plan(stage_sleeps(f.sleeps, f.profiles))
    assert "PushedFilters" in text and "event_type" in re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)


def test_no_window_over_all_events_of_a_subject(stored):
    windows = re.findall(r"windowspecdefinition\(([^()]*)", plan(sleep_neighbours(stored["sleeps"])))
    assert windows and all("care_day" in w or "own_day" in w for w in windows)


@pytest.mark.parametrize("query", [sleep_neighbours, lambda s: fct_wake_windows(s, B.profiles(s.sparkSession))])
def test_wake_windows_read_sleeps_once(stored, query):
    text = plan(query(stored["sleeps"]))
    assert len(re.findall(r"FileScan parquet", text)) == 1
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 3


def test_night_and_nap_columns_take_one_shuffle(stored):
    text = plan(daily.sleep_days(stored["sleeps"]))
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1 and "SortAggregate" not in text


def test_groups_read_each_kind_for_itself_and_the_spine(stored):
    r = stored
    text = plan(daily.daily_from_groups(r["profiles"], r["sleeps"], r["feeds"], r["diapers"]))
    events = [c for c in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "baby_id" in c]
    assert len(events) == 7


def test_pairs_are_placed_once(spark, stored):
    r = stored
    days = mart_daily_metrics(r["profiles"], r["sleeps"], r["feeds"], r["diapers"])
    pairs = spark.createDataFrame([("a", "b")], "left_id string, right_id string")
    text = plan(compare.compare(days, pairs, "age_weeks"))
    assert len(re.findall(r"Exchange hashpartitioning\(left_id", text)) == 1


def test_hot_subject_is_split(spark, tmp_path, no_broadcast):
    """Joining profiles sort-merge splits the partition of a subject that owns most rows."""
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("int"))
    rows = spark.range(200_000, numPartitions=8).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 500)).alias("baby_id"),
        start.alias("start_time"),
        (start + F.make_dt_interval(mins=F.lit(30))).alias("end_time"),
        F.uuid().alias("sleep_type"),
    )
    rows.write.parquet(str(tmp_path / "sleeps"))
    born = {"hot": date(2023, 12, 1)} | {f"b{i}": date(2023, 12, 1) for i in range(500)}
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        staged = stage_sleeps(spark.read.parquet(str(tmp_path / "sleeps")), B.profiles(spark, born))
        assert len(staged.collect()) == 200_000
        assert "skew=true" in plan(staged)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_a_third_of_all_rows_being_copies(spark):
    """Copies collapse before the shuffle and still count in full."""
    start = "2024-01-01 10:00:00"
    copies = spark.range(30_000).select(
        F.col("id").cast("string").alias("id"),
        F.lit("a").alias("baby_id"),
        F.lit(start).cast("timestamp_ntz").alias("start_time"),
        F.lit("2024-01-01 11:00:00").cast("timestamp_ntz").alias("end_time"),
    )
    later = B.sleeps(spark, [("a", "2024-01-01 12:00:00", "2024-01-01 12:30:00")]).select(copies.columns)
    sleeps = copies.unionByName(later)
    row = mart_daily_metrics(B.profiles(spark), sleeps, B.feeds(spark, []), B.diapers(spark, [])).first()
    assert (row.nap_count, row.total_nap_minutes, row.max_wake_window_minutes) == (30_001, 1_800_030, 60)
    assert fct_wake_windows(sleeps, B.profiles(spark)).count() == 1
