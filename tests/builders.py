"""Small hand-written relations, and a row-by-row rendering of the rules to check against."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from carelens import schemas


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, table, rows, **defaults):
    """A relation from dicts; columns not given are NULL."""
    schema = schemas.TABLES[table]
    data = [tuple({**defaults, **row}.get(name) for name in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(data, schema)


def profiles(spark, born=None):
    born = born or {"a": date(2023, 6, 1)}
    return frame(
        spark, "baby_profiles", [{"id": k, "name": k.upper(), "date_of_birth": d} for k, d in born.items()]
    )


def sleeps(spark, spans):
    """``spans`` are (baby, start, end); times are ISO text, datetimes or None."""
    rows = [
        {"id": f"s{i}", "baby_id": b, "start_time": _at(s), "end_time": _at(e), "sleep_type": "NAP"}
        for i, (b, s, e) in enumerate(spans)
    ]
    return frame(spark, "sleep_sessions", rows)


def feeds(spark, starts):
    """``starts`` are (baby, start[, type[, volume]])."""
    rows = []
    for i, (baby, start, *rest) in enumerate(starts):
        kind, volume = (*rest, "BREAST", None)[:2] if rest else ("BREAST", None)
        if len(rest) == 1:
            volume = None
        rows.append(
            {"id": f"f{i}", "baby_id": baby, "start_time": _at(start), "end_time": _at(start),
             "feeding_type": kind, "volume_consumed_ml": volume}
        )
    return frame(spark, "feeding_sessions", rows)


def diapers(spark, changes):
    """``changes`` are (baby, time, wet, dirty)."""
    rows = [
        {"id": f"d{i}", "baby_id": b, "timestamp": _at(t), "has_urine": u, "has_stool": s}
        for i, (b, t, u, s) in enumerate(changes)
    ]
    return frame(spark, "diaper_events", rows)


def _at(value):
    return ts(value) if isinstance(value, str) else value


# The rules, one subject and one row at a time.


def half_up(value: Fraction) -> int:
    exact = Decimal(value.numerator) / Decimal(value.denominator)
    rounded = int(abs(exact).quantize(Decimal(1), ROUND_HALF_UP))
    return rounded if value >= 0 else -rounded


def minutes(start, end) -> Fraction:
    delta = end - start
    return Fraction(delta // timedelta(microseconds=1), 60_000_000)


def is_night(start, length: int) -> bool:
    return start.hour < 7 or start.hour >= 19 or (start.hour >= 18 and length > 180)


def wake_windows(spans):
    """(baby, open, close, minutes) of one list of (baby, start, end)."""
    found = []
    for baby in {b for b, *_ in spans}:
        own = sorted((s, e) for b, s, e in spans if b == baby and s and e and e > s)
        for (_, end), (following, _) in zip(own, own[1:]):
            if following > end and 6 <= end.hour <= 20:
                length = half_up(minutes(end, following))
                if 5 <= length <= 360:
                    found.append((baby, end, following, length))
    return found


def daily(born, spans, feed_rows, changes):
    """The daily table as {(baby, day): {column: value}}."""
    table = {}
    windows = wake_windows(spans)
    for baby, birthday in born.items():
        own = sorted((s, e) for b, s, e in spans if b == baby and s and e and e > s)
        eaten = sorted([r for r in feed_rows if r[0] == baby], key=lambda r: r[1])
        changed = [r for r in changes if r[0] == baby]
        dates = [s.date() for s, _ in own] + [r[1].date() for r in eaten] + [r[1].date() for r in changed]
        if not dates:
            continue
        nights, napped, gaps, wakes = (defaultdict(list) for _ in range(4))
        for s, e in own:
            length = half_up(minutes(s, e))
            if is_night(s, length):
                nights[s.date() - timedelta(days=s.hour < 7)].append((s, e, length))
            else:
                napped[s.date()].append(length)
        for earlier, later in zip(eaten, eaten[1:]):
            gap = minutes(earlier[1], later[1])
            if 1 <= gap <= 720:
                gaps[later[1].date()].append(gap)
        for b, opened, _, length in windows:
            if b == baby:
                wakes[opened.date()].append(length)
        day = min(dates)
        while day <= max(dates):
            night = nights.get(day, [])
            naps_, meals = napped.get(day, []), [r for r in eaten if r[1].date() == day]
            nappies = [r for r in changed if r[1].date() == day]
            awake = [minutes(e, s2) for (_, e, _), (s2, _, _) in zip(night, night[1:])]
            volumes = [r[3] for r in meals if len(r) > 3 and r[3] is not None]
            mean = lambda xs: half_up(Fraction(sum(xs)) / len(xs)) if xs else None
            table[baby, day] = {
                "age_days": (day - birthday).days,
                "age_weeks": int((day - birthday).days / 7),
                "night_sleep_minutes": sum(n[2] for n in night),
                "night_sleep_segments": len(night) or None,
                "longest_night_stretch_minutes": max((n[2] for n in night), default=None),
                "awake_at_night_minutes": half_up(sum(awake, Fraction(0))) if awake else None,
                "night_waking_count": len(awake) or None,
                "nap_count": len(naps_),
                "total_nap_minutes": sum(naps_),
                "avg_nap_minutes": mean(naps_),
                "feed_count": len(meals),
                "breast_feed_count": sum((r[2] if len(r) > 2 else "BREAST") == "BREAST" for r in meals),
                "bottle_feed_count": sum(len(r) > 2 and r[2] == "BOTTLE" for r in meals),
                "total_volume_ml": sum(volumes) if volumes else None,
                "avg_feed_interval_minutes": mean(gaps.get(day, [])),
                "avg_wake_window_minutes": mean(wakes.get(day, [])),
                "max_wake_window_minutes": max(wakes.get(day, []), default=None),
                "diaper_count": len(nappies),
                "wet_diaper_count": sum(bool(r[2]) for r in nappies),
                "dirty_diaper_count": sum(bool(r[3]) for r in nappies),
            }
            day += timedelta(days=1)
    return table


def as_table(rows):
    return {
        (r["baby_id"], r["metric_date"]): {
            k: v for k, v in r.asDict().items() if k not in ("baby_id", "metric_date", "baby_name")
        }
        for r in rows
    }
