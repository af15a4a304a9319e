from datetime import date

import builders as B
import pytest
from pyspark.sql import functions as F

from carelens import schemas
from carelens.plans import load as loading
from carelens.plans import refresh
from carelens.plans.build import ChecksFailed
from carelens.plans.mart import mart_daily_metrics
from carelens.sources.tables import create_table, partitions, table_name

BABIES = [f"b{i}" for i in range(40)]


def tagged(rows, tag="ingested"):
    return rows.withColumn("source", F.lit(tag))


@pytest.fixture
def base(spark, tmp_path):
    base = f"base_{tmp_path.name}".lower().replace("-", "_")[:100]
    loading.create_tables(spark, base, str(tmp_path / "base"))
    loading.append_rows(tagged(B.profiles(spark, {b: date(2024, 1, 1) for b in BABIES})), table_name(base, "baby_profiles"))
    days = [(b, d) for i, b in enumerate(BABIES) for d in range(1, 4 + i % 3)]
    sleeps = [x for b, d in days for x in ((b, f"2024-03-0{d} 20:00:00", f"2024-03-0{d} 23:30:00"), (b, f"2024-03-0{d} 13:00:00", f"2024-03-0{d} 14:00:00"))]
    loading.append_rows(tagged(B.sleeps(spark, sleeps)), table_name(base, "sleep_sessions"))
    loading.append_rows(tagged(B.feeds(spark, [(b, f"2024-03-0{d} 09:00:00") for b, d in days])), table_name(base, "feeding_sessions"))
    loading.append_rows(tagged(B.diapers(spark, [(b, f"2024-03-0{d} 09:30:00", True, False) for b, d in days])), table_name(base, "diaper_events"))
    yield base
    spark.sql(f"DROP DATABASE {base} CASCADE")


def full(spark, base):
    names = ("baby_profiles", "sleep_sessions", "feeding_sessions", "diaper_events")
    rows = mart_daily_metrics(*(spark.table(table_name(base, n)).drop("source") for n in names))
    return sorted(map(repr, rows.collect()))


def mart(spark, base):
    return sorted(map(repr, spark.table(table_name(base, refresh.MART)).collect()))


def parts(spark, base):
    return set(partitions(spark, table_name(base, refresh.STORED)))


def test_one_subject_rewrites_its_bucket(spark, base):
    """Before its calendar, after it and within: neighbours in other days are right, other buckets are not touched."""
    done = refresh.refresh_mart(spark, base, base)
    assert len(done.stale) == done.buckets > 10 and mart(spark, base) == full(spark, base)
    before = parts(spark, base)
    changed = [("b7", "2024-02-20 13:00:00", "2024-02-20 14:00:00"), ("b7", "2024-03-02 23:00:00", "2024-03-03 04:30:00"),
               ("b7", "2024-03-09 01:00:00", "2024-03-09 02:00:00")]
    rows = B.sleeps(spark, changed)
    loading.subject_replace(rows, rows.select("baby_id"), table_name(base, "sleep_sessions"))
    done = refresh.refresh_mart(spark, base, base)
    assert len(done.stale) == 1 and mart(spark, base) == full(spark, base)
    assert {(tag, bucket) for tag, bucket, _ in parts(spark, base) ^ before} == {("built", next(iter(done.stale)))}


def test_nothing_changed(spark, base):
    refresh.refresh_mart(spark, base, base)
    before = parts(spark, base)
    done = refresh.refresh_mart(spark, base, base)
    assert done.stale == set() and done.rows == 0 and parts(spark, base) == before


def test_profiles_count_too(spark, base):
    refresh.refresh_mart(spark, base, base)
    renamed = tagged(B.profiles(spark, {"b3": date(2023, 12, 1)})).withColumn("name", F.lit("renamed"))
    loading.upsert(renamed, table_name(base, "baby_profiles"))
    done = refresh.refresh_mart(spark, base, base)
    assert len(done.stale) == 1 and mart(spark, base) == full(spark, base)
    assert {r.baby_name for r in spark.table(table_name(base, refresh.MART)).where("baby_id = 'b3'").collect()} == {"renamed"}


def test_what_is_gone_goes(spark, base):
    refresh.refresh_mart(spark, base, base)
    for table in schemas.EVENT_TABLES:
        rows = spark.table(table_name(base, table))
        loading.tagged_replace(rows.where("baby_id IN ('b1', 'b2')").drop("source"), table_name(base, table))
    done = refresh.refresh_mart(spark, base, base)
    assert len(done.stale) > 10 and mart(spark, base) == full(spark, base)
    assert spark.table(table_name(base, refresh.MART)).select("baby_id").distinct().count() == 2


def test_only_stale_buckets_are_read(spark, base):
    refresh.refresh_mart(spark, base, base)
    live = refresh.shown(spark, table_name(base, "sleep_sessions")).live
    bucket = next(iter(live))[1]
    rows = refresh._source(spark, base, "sleep_sessions", live, {bucket})
    assert rows.select(F.input_file_name()).distinct().count() <= len({p for p in live if p[1] == bucket})


def test_a_violation_keeps_the_old_mart(spark, base):
    refresh.refresh_mart(spark, base, base)
    before = mart(spark, base)
    many = B.diapers(spark, [("b5", f"2024-03-02 1{i % 10}:{i:02}:00", True, True) for i in range(26)])
    loading.append_rows(tagged(many), table_name(base, "diaper_events"))
    with pytest.raises(ChecksFailed, match="diaper_count > 25"):
        refresh.refresh_mart(spark, base, base)
    assert mart(spark, base) == before
    done = refresh.refresh_mart(spark, base, base, ["diaper_count > 25"])
    assert len(done.stale) == 1 and mart(spark, base) == full(spark, base) != before


def test_tables_with_other_numbers_of_buckets(spark, tmp_path):
    base = f"odd_{tmp_path.name}".lower()[:90]
    spark.sql(f"CREATE DATABASE {base} LOCATION '{tmp_path / 'odd'}'")
    rows = {
        "baby_profiles": B.profiles(spark, {b: date(2024, 1, 1) for b in BABIES}),
        "sleep_sessions": B.sleeps(spark, [(b, "2024-03-01 13:00:00", "2024-03-01 14:00:00") for b in BABIES]),
        "feeding_sessions": B.feeds(spark, [(b, "2024-03-01 09:00:00") for b in BABIES]),
        "diaper_events": B.diapers(spark, [(b, "2024-03-02 09:00:00", True, False) for b in BABIES]),
    }
    for i, (table, frame) in enumerate(rows.items()):
        create_table(spark, table_name(base, table), tagged(frame).schema)
        loading.append_rows(tagged(frame), table_name(base, table), 3 + i)
    refresh.refresh_mart(spark, base, base)
    assert mart(spark, base) == full(spark, base)
    assert refresh.refresh_mart(spark, base, base).rows == 0
    loading.tagged_replace(rows["diaper_events"].limit(3), table_name(base, "diaper_events"))
    refresh.refresh_mart(spark, base, base)
    assert mart(spark, base) == full(spark, base)
    spark.sql(f"DROP DATABASE {base} CASCADE")
