from datetime import date, datetime, timedelta

import pytest
from builders import profiles, sleeps, ts, wake_windows

from carelens.operators.daily import night_wakings
from carelens.operators.sleep import fct_sleep_sessions, fct_wake_windows
from carelens.operators.staging import stage_sleeps


@pytest.mark.parametrize("hour,minute", [(5, 59), (6, 59), (7, 0), (17, 59), (18, 0), (18, 59), (19, 0), (23, 59), (0, 0)])
def test_night_and_its_date(spark, hour, minute):
    start = datetime(2024, 3, 1, hour, minute)
    spans = [("a", start, start + timedelta(minutes=m)) for m in (180, 181)]
    rows = fct_sleep_sessions(sleeps(spark, spans), profiles(spark)).orderBy("end_time").collect()
    for row, length in zip(rows, (180, 181)):
        expected = hour < 7 or hour >= 19 or (hour == 18 and length > 180)
        assert row.is_night is expected
        night_of = date(2024, 2, 29) if hour < 7 else date(2024, 3, 1)
        assert row.night_date == (night_of if expected else None)
        assert row.calendar_date == date(2024, 3, 1)


def test_staging_drops_what_cannot_be_a_sleep(spark):
    at = "2024-01-01 10:00:00"
    rows = sleeps(
        spark,
        [
            ("a", at, "2024-01-01 11:00:00"),
            ("a", at, at),
            ("a", at, "2024-01-01 09:00:00"),
            ("a", at, None),
            ("orphan", at, "2024-01-01 11:00:00"),
            (None, at, "2024-01-01 11:00:00"),
        ],
    )
    assert [r.sleep_id for r in stage_sleeps(rows, profiles(spark)).collect()] == ["s0"]


@pytest.mark.parametrize("days,weeks", [(0, 0), (6, 0), (7, 1), (-6, 0), (-7, -1), (-8, -1)])
def test_age_truncates_towards_zero(spark, days, weeks):
    start = datetime(2024, 1, 10, 12) + timedelta(days=days)
    row = stage_sleeps(
        sleeps(spark, [("a", start, start + timedelta(hours=1))]), profiles(spark, {"a": date(2024, 1, 10)})
    ).first()
    assert (row.age_days, row.age_weeks) == (days, weeks)


def test_duration_rounds_halves_away_from_zero(spark):
    base = datetime(2024, 1, 1, 10)
    lengths = [29.999999, 30, 89.5, 90, 150]
    spans = [("a", base, base + timedelta(seconds=s)) for s in lengths]
    rows = stage_sleeps(sleeps(spark, spans), profiles(spark)).orderBy("end_time").collect()
    assert [r.duration_minutes for r in rows] == [0, 1, 1, 2, 3]


def _windows(spark, spans):
    spans = [(b, ts(s) if isinstance(s, str) else s, ts(e) if isinstance(e, str) else e) for b, s, e in spans]
    got = fct_wake_windows(sleeps(spark, spans), profiles(spark)).collect()
    found = sorted((r.baby_id, r.wake_start, r.wake_end, r.wake_window_minutes) for r in got)
    assert found == sorted(wake_windows(spans))
    return [r[3] for r in found]


@pytest.mark.parametrize(
    "end,kept",
    [("05:59:59", False), ("06:00:00", True), ("20:59:59", True), ("21:00:00", False)],
)
def test_window_must_open_in_daytime(spark, end, kept):
    opened = ts(f"2024-01-05 {end}")
    spans = [("a", opened - timedelta(hours=1), opened), ("a", opened + timedelta(hours=1), opened + timedelta(hours=2))]
    assert _windows(spark, spans) == ([60] if kept else [])


@pytest.mark.parametrize("seconds,kept", [(269, False), (270, True), (360 * 60 + 29, True), (360 * 60 + 30, False)])
def test_window_bounds_apply_to_rounded_minutes(spark, seconds, kept):
    opened = ts("2024-01-05 10:00:00")
    later = opened + timedelta(seconds=seconds)
    assert len(_windows(spark, [("a", opened - timedelta(hours=1), opened), ("a", later, later + timedelta(hours=1))])) == kept


def test_overlap_ties_and_copies(spark):
    spans = [
        ("a", "2024-01-01 09:00:00", "2024-01-01 11:00:00"),
        ("a", "2024-01-01 10:00:00", "2024-01-01 10:30:00"),  # overlaps: opens the window instead
        ("a", "2024-01-01 12:00:00", "2024-01-01 12:30:00"),  # same start, shorter
        ("a", "2024-01-01 12:00:00", "2024-01-01 13:00:00"),
        ("a", "2024-01-01 12:00:00", "2024-01-01 13:00:00"),  # copy
        ("a", "2024-01-01 14:00:00", "2024-01-01 14:10:00"),  # last
    ]
    assert _windows(spark, spans) == [90, 60]


def test_windows_across_days_and_long_sleeps(spark):
    spans = [
        ("a", "2024-01-01 06:10:00", "2024-01-01 06:20:00"),  # before 7 am: previous care day
        ("a", "2024-01-01 06:40:00", "2024-01-01 06:50:00"),
        ("a", "2024-01-01 08:00:00", "2024-01-04 08:00:00"),  # three days
        ("a", "2024-01-04 09:00:00", "2024-01-04 20:30:00"),
        ("a", "2024-01-05 01:00:00", "2024-01-05 06:30:00"),
        ("a", "2024-01-05 06:45:00", "2024-01-05 06:50:00"),
        ("a", "2024-01-05 07:00:00", "2024-01-05 07:30:00"),
    ]
    assert _windows(spark, spans) == [20, 70, 60, 270, 15, 10]


def test_night_wakings(spark):
    spans = [
        ("one", "2024-01-01 20:00:00", "2024-01-01 23:00:00"),
        ("two", "2024-01-01 20:00:00", "2024-01-01 23:00:00"),
        ("two", "2024-01-02 00:30:00", "2024-01-02 05:00:00"),
        ("over", "2024-01-01 20:00:00", "2024-01-01 23:00:00"),
        ("over", "2024-01-01 22:00:00", "2024-01-01 22:30:00"),
        ("three", "2024-01-01 19:00:00", "2024-01-01 21:00:10"),
        ("three", "2024-01-01 21:00:40", "2024-01-02 03:00:00"),
        ("three", "2024-01-02 03:01:00", "2024-01-02 08:00:00"),
    ]
    babies = profiles(spark, {b: date(2024, 1, 1) for b, *_ in spans})
    got = {r.baby_id: (r.awake_at_night_minutes, r.night_waking_count, r.metric_date) for r in night_wakings(babies, sleeps(spark, spans)).collect()}
    first = date(2024, 1, 1)
    assert got == {"two": (90, 1, first), "over": (-60, 1, first), "three": (2, 2, first)}
