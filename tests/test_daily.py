import random
from datetime import date, datetime, timedelta

import builders as B
import pytest

from carelens.operators.daily import METRICS, daily_from_groups, event_bounds
from carelens.plans.mart import mart_daily_metrics

PLANS = (mart_daily_metrics, daily_from_groups)


def build(spark, plan, born, spans=(), feed_rows=(), changes=()):
    return plan(
        B.profiles(spark, born), B.sleeps(spark, spans), B.feeds(spark, feed_rows), B.diapers(spark, changes)
    )


def random_events(seed):
    """Crowded, sparse and overlapping days, copies, orphans, long sleeps, month and leap-year ends."""
    rng = random.Random(seed)
    born = {f"b{i}": date(2024, 2, 25) + timedelta(days=rng.randrange(-20, 5)) for i in range(6)}
    spans, feed_rows, changes = [], [], []
    for baby in [*born, "orphan"]:
        for _ in range(rng.choice((1, 4, 40))):
            start = datetime(2024, 2, 26) + timedelta(seconds=rng.randrange(0, 8 * 86400, rng.choice((1, 60, 1800))))
            spans.append((baby, start, start + timedelta(seconds=rng.choice((0, 600, 5410, 9000, 40000, 200000)))))
        for _ in range(rng.choice((0, 3, 40))):
            start = datetime(2024, 2, 26) + timedelta(seconds=rng.randrange(0, 8 * 86400, rng.choice((1, 30, 3600))))
            feed_rows.append((baby, start, rng.choice(("BREAST", "BOTTLE", "SOLID")), rng.choice((None, 0, 75))))
        for _ in range(rng.choice((0, 2, 10))):
            at = datetime(2024, 2, 25) + timedelta(seconds=rng.randrange(12 * 86400))
            changes.append((baby, at, rng.choice((True, False, None)), rng.random() < 0.5))
    spans += rng.choices(spans, k=10)
    feed_rows += rng.choices(feed_rows, k=5)
    return born, spans, feed_rows, changes


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("seed", range(4))
def test_against_row_by_row_rules(spark, plan, seed):
    events = random_events(seed)
    got = B.as_table(build(spark, plan, *events).collect())
    assert got == B.daily(*events)


@pytest.mark.parametrize("plan", PLANS)
def test_night_before_the_first_date_is_dropped_but_its_wake_window_stays(spark, plan):
    spans = [
        ("a", "2024-01-02 02:00:00", "2024-01-02 06:10:00"),
        ("a", "2024-01-02 06:40:00", "2024-01-02 06:50:00"),
    ]
    (row,) = build(spark, plan, {"a": date(2024, 1, 1)}, spans).collect()
    assert row.metric_date == date(2024, 1, 2)
    assert (row.night_sleep_minutes, row.night_sleep_segments) == (0, None)
    assert (row.avg_wake_window_minutes, row.max_wake_window_minutes) == (30, 30)


@pytest.mark.parametrize("plan", PLANS)
def test_spine_has_no_gaps_and_zero_differs_from_null(spark, plan):
    changes = [("a", "2024-02-27 10:00:00", True, True), ("a", "2024-03-02 10:00:00", False, True)]
    rows = build(spark, plan, {"a": date(2024, 2, 28), "nothing": date(2024, 1, 1)}, (), (), changes).orderBy("metric_date").collect()
    assert [r.metric_date for r in rows] == [date(2024, 2, 27) + timedelta(days=i) for i in range(5)]
    assert rows[2].metric_date == date(2024, 2, 29)
    assert [r.age_days for r in rows] == [-1, 0, 1, 2, 3]
    assert [r.diaper_count for r in rows] == [1, 0, 0, 0, 1]
    assert (rows[0].wet_diaper_count, rows[0].dirty_diaper_count) == (1, 1)
    zero = {"night_sleep_minutes", "nap_count", "total_nap_minutes", "feed_count", "breast_feed_count",
            "bottle_feed_count", "diaper_count", "wet_diaper_count", "dirty_diaper_count"}
    for name in METRICS:
        assert rows[2][name] == (0 if name in zero else None), name


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("seconds,counted", [(0, False), (54, False), (60, True), (720 * 60, True), (720 * 60 + 1, False)])
def test_feed_interval_bounds(spark, plan, seconds, counted):
    first = B.ts("2024-01-01 08:00:00")
    later = first + timedelta(seconds=seconds)
    rows = build(spark, plan, {"a": date(2024, 1, 1)}, (), [("a", first), ("a", later)]).collect()
    expected = B.half_up(B.minutes(first, later)) if counted else None
    assert {r.metric_date: r.avg_feed_interval_minutes for r in rows}[later.date()] == expected


@pytest.mark.parametrize("plan", PLANS)
def test_feed_gap_over_midnight_belongs_to_the_later_day(spark, plan):
    feeds = [("a", "2024-01-01 23:30:00"), ("a", "2024-01-02 00:31:00"), ("a", "2024-01-02 02:31:00")]
    rows = build(spark, plan, {"a": date(2024, 1, 1)}, (), feeds).orderBy("metric_date").collect()
    # 61 and 120 minutes average 90.5, which rounds up.
    assert [r.avg_feed_interval_minutes for r in rows] == [None, 91]


def test_output_types(spark):
    rows = build(spark, mart_daily_metrics, {"a": date(2024, 1, 1)}, [("a", "2024-01-01 10:00:00", "2024-01-01 11:00:00")])
    types = dict(rows.dtypes)
    assert types["metric_date"] == "date"
    whole = {"age_days", "age_weeks", "longest_night_stretch_minutes", "awake_at_night_minutes", "avg_nap_minutes",
             "avg_feed_interval_minutes", "avg_wake_window_minutes", "max_wake_window_minutes"}
    for name in [*METRICS, "age_days", "age_weeks"]:
        assert types[name] == ("int" if name in whole else "bigint"), name
    assert types == dict(build(spark, daily_from_groups, {"a": date(2024, 1, 1)}).dtypes)


def test_bounds_ignore_subjects_without_profile(spark):
    changes = [("a", "2024-01-03 10:00:00", True, True), ("orphan", "2024-01-01 10:00:00", True, True)]
    rows = event_bounds(B.profiles(spark), B.sleeps(spark, []), B.feeds(spark, []), B.diapers(spark, changes)).collect()
    assert [tuple(r) for r in rows] == [("a", date(2024, 1, 3), date(2024, 1, 3))]


def test_session_zone_does_not_matter(spark):
    events = random_events(9)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        got = B.as_table(build(spark, mart_daily_metrics, *events).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == B.daily(*events)
