from datetime import date, datetime
from pathlib import Path

import builders as B
import pytest
from pyspark.sql import functions as F

from carelens import schemas, session
from carelens.operators import quality
from carelens.operators.staging import stage_feeds
from carelens.plans import build as plans
from carelens.plans import load as loading
from carelens.sources import subjects, tables
from carelens.sources.tables import create_table, open_tables, partitions, raw_relations, read_text, require_tables, table_name, write_text

FORMAT = "%d/%m/%y %I:%M %p"


def tagged(frame, tag):
    return frame.withColumn("source", F.lit(tag))


def stored(spark, name):
    return sorted((r.id, r.baby_id, r.source) for r in spark.table(name).collect())


@pytest.fixture
def base(spark, tmp_path):
    """A new database in a folder of its own."""
    base = f"base_{tmp_path.name}".lower().replace("-", "_")[:100]
    spark.sql(f"CREATE DATABASE {base} LOCATION '{tmp_path / 'base'}'")
    yield base
    spark.sql(f"DROP DATABASE {base} CASCADE")


@pytest.fixture
def empty(spark, base):
    name = f"{base}.diaper_events"
    create_table(spark, name, schemas.with_source(schemas.DIAPERS))
    return name


@pytest.fixture
def nobody(spark, base):
    name = f"{base}.baby_profiles"
    create_table(spark, name, schemas.with_source(schemas.PROFILES))
    return name


@pytest.fixture
def table(spark, empty):
    rows = B.diapers(spark, [("a", "2024-01-01 10:00:00", True, True), ("b", "2024-01-01 10:00:00", True, True)])
    loading.append_rows(tagged(rows, "app"), empty)
    loading.append_rows(tagged(rows, "ingested"), empty)
    return empty


def files(spark, name):
    """Files that the rows come from."""
    return {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}


def batch(spark, *babies):
    return B.diapers(spark, [(b, "2024-01-02 10:00:00", True, True) for b in babies]).withColumn("id", F.concat(F.lit("new-"), "baby_id"))


APP = [("d0", "a", "app"), ("d1", "b", "app")]


def test_tagged_replace_keeps_other_tags_and_can_be_repeated(spark, table):
    for _ in range(2):
        assert loading.tagged_replace(batch(spark, "a", "c"), table) == 2
        assert stored(spark, table) == APP + [("new-a", "a", "ingested"), ("new-c", "c", "ingested")]


def test_an_empty_batch_still_clears(spark, table):
    assert loading.tagged_replace(batch(spark, "a").limit(0), table) == 0
    assert stored(spark, table) == APP


def test_subject_replace_keeps_other_subjects(spark, table):
    rows = tagged(batch(spark, "a"), "ingested")
    for _ in range(2):
        loading.subject_replace(rows, rows.select("baby_id"), table)
        assert stored(spark, table) == sorted([*APP, ("d1", "b", "ingested"), ("new-a", "a", "ingested")])
    loading.subject_replace(rows.limit(0), rows.select("baby_id"), table)
    assert stored(spark, table) == sorted([*APP, ("d1", "b", "ingested")])


def people_with_diapers(spark, count):
    return B.diapers(spark, [(f"b{i}", "2024-01-01 10:00:00", True, True) for i in range(count)])


def buckets_written_anew(before, after):
    return {(tag, bucket) for tag, bucket, _ in set(before) ^ set(after)}


def test_subject_replace_writes_only_their_buckets(spark, empty):
    loading.append_rows(tagged(people_with_diapers(spark, 300), "ingested"), empty)
    before = partitions(spark, empty)
    assert len(before) == loading.BUCKETS and all(bucket.endswith("-of-16") for _, bucket, _ in before)
    one = B.diapers(spark, [("b7", "2024-01-02 10:00:00", True, True), ("b8", "2024-01-02 10:00:00", True, True)])
    assert loading.subject_replace(one, one.where("baby_id = 'b7'"), empty) == 1
    assert len(buckets_written_anew(before, partitions(spark, empty))) == 1
    got = stored(spark, empty)
    assert len(got) == 300 and ("d0", "b7", "ingested") in got and ("d8", "b8", "ingested") in got


def test_a_smaller_reload_leaves_no_old_bucket(spark, empty):
    many = people_with_diapers(spark, 300)
    loading.append_rows(tagged(many, "ingested"), empty)
    assert loading.tagged_replace(many.where("baby_id = 'b7'"), empty) == 1
    assert stored(spark, empty) == [("d7", "b7", "ingested")]


@pytest.mark.parametrize("buckets", [100, 200])
def test_any_number_of_buckets_is_kept_by_the_table(spark, empty, buckets):
    many = people_with_diapers(spark, 300)
    loading.append_rows(tagged(many, "ingested"), empty, buckets)
    assert loading.tagged_replace(many, empty) == 300
    assert len(stored(spark, empty)) == 300
    assert loading.bucket_count(tables.shown(spark, empty).live) == buckets


def test_a_reader_sees_the_old_rows_until_the_view_turns(spark, table, monkeypatch):
    """Between the write and the turn, and with a plan from before the turn also after it; in another session as well."""
    other = spark.newSession()
    old = stored(spark, table)
    early = spark.table(table)
    seen, written = [], loading.show

    def between(*arguments):
        seen.extend([stored(spark, table), stored(other, table)])
        written(*arguments)

    monkeypatch.setattr(loading, "show", between)
    loading.tagged_replace(batch(spark, "a", "c"), table)
    assert seen == [old, old]
    assert stored(other, table) == APP + [("new-a", "a", "ingested"), ("new-c", "c", "ingested")]
    assert sorted((r.id, r.baby_id, r.source) for r in early.collect()) == old


def test_readers_write_nothing(spark, base):
    loading.create_tables(spark, base)
    loading.append_rows(tagged(people_with_diapers(spark, 30), "app"), table_name(base, "diaper_events"))
    location = spark.sql(f"DESCRIBE DATABASE {base}").where("info_name = 'Location'").first().info_value.removeprefix("file:")

    def listing():
        return sorted((str(p), p.stat().st_mtime_ns) for p in Path(location).rglob("*"))

    before = listing()
    assert open_tables(spark, base)["diaper_events"].count() == 30
    assert loading.stored_counts(spark, base).count() == 1
    assert listing() == before


def test_a_load_that_dies_half_way_is_not_seen(spark, empty, monkeypatch):
    """What it wrote is dropped by the next change."""
    loading.append_rows(tagged(people_with_diapers(spark, 30), "ingested"), empty)
    new = B.diapers(spark, [("b7", "2024-01-02 10:00:00", True, True)]).withColumn("id", F.lit("new"))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(loading, "show", die)
        with pytest.raises(KeyboardInterrupt):
            loading.tagged_replace(new, empty)
    left = {load for _, _, load in partitions(spark, empty)}
    assert len(left) == 2 and len(stored(spark, empty)) == 30
    loading.tagged_replace(new, empty)
    assert stored(spark, empty) == [("new", "b7", "ingested")]
    assert len({load for _, _, load in partitions(spark, empty)} & left) == 1  # the rows before, for readers still at them
    loading.tagged_replace(new, empty)
    assert not {load for _, _, load in partitions(spark, empty)} & left


def test_a_change_that_was_overtaken_is_refused(spark, table):
    late = loading.prepare_tagged_replace(batch(spark, "c"), table)
    loading.tagged_replace(batch(spark, "a"), table)
    with pytest.raises(loading.Overtaken):
        late.turn()
    assert stored(spark, table) == APP + [("new-a", "a", "ingested")]
    assert late.load not in {load for _, _, load in partitions(spark, table)}


def test_a_batch_is_evaluated_once(spark, empty):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for part in batches:
            calls.add(part.num_rows)
            yield part

    rows = people_with_diapers(spark, 40)
    for replace in (loading.tagged_replace, lambda r, n: loading.subject_replace(r, rows.select("baby_id"), n)):
        before = calls.value
        assert replace(rows.mapInArrow(counted, rows.schema), empty) == 40
        assert calls.value - before == 40


def test_only_partitions_that_count_are_read(spark, table):
    loading.tagged_replace(batch(spark, "a", "c"), table)
    assert files(spark, table) < files(spark, tables.rows_name(table))
    plan = spark.table(table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws(/, source" in plan


def test_upsert_rewrites_only_the_buckets_of_its_rows(spark, nobody):
    loading.append_rows(people(spark, "app", *(f"p{i}" for i in range(100))), nobody)
    before = partitions(spark, nobody)
    assert loading.upsert(people(spark, "app", "p3", "new"), nobody) == 2
    assert len(buckets_written_anew(before, partitions(spark, nobody))) <= 2
    assert len(named(spark, nobody)) == 101


def test_a_wrong_base_raises_and_publishes_nothing(spark):
    with pytest.raises(LookupError, match="baby_profiles"):
        plans.build(spark, "nowhere")
    with pytest.raises(LookupError, match="sleep_sessions"):
        open_tables(spark, "nowhere")


def test_publishing_keeps_the_old_rows_until_the_new_are_complete(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shown LOCATION '{tmp_path}/shown'")
    days = spark.range(5000).selectExpr("concat('b', id % 500) AS baby_id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS metric_date")
    order = ("baby_id", "metric_date")
    plans.publish(days, "shown", "mart", order)
    assert spark.table("shown.mart").count() == 5000
    broken = days.withColumn("x", F.when(F.col("baby_id") == "b7", F.raise_error("bad row")))
    with pytest.raises(Exception, match="bad row"):
        plans.publish(broken, "shown", "mart", order)
    assert spark.table("shown.mart").count() == 5000
    for n in (1, 2, 3):
        plans.publish(days.limit(n), "shown", "mart", order)
        assert spark.table("shown.mart").count() == n
    complete = [t.name for t in spark.catalog.listTables("shown") if t.name.startswith("mart__")]
    assert len(complete) <= 3
    spark.sql("DROP DATABASE shown CASCADE")


def test_a_violated_check_keeps_the_old_rows(spark, tmp_path):
    """What is written anew is counted while it is written, judged, and dropped."""
    spark.sql(f"CREATE DATABASE shown LOCATION '{tmp_path}/shown'")
    days = spark.range(50).selectExpr("concat('b', id % 5) AS baby_id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS metric_date",
        "'x' AS baby_name", "1 AS age_days", "0 AS age_weeks", "60 AS night_sleep_minutes", "0 AS total_nap_minutes", "0 AS nap_count",
        "0 AS feed_count", "0 AS diaper_count")
    order = ("baby_id", "metric_date")
    plans.publish(days, "shown", "mart_daily_metrics", order, "mart_daily_metrics")
    bad = days.unionByName(days.where("metric_date < '2024-01-04'")).withColumn(
        "nap_count", F.when(F.col("metric_date") == "2024-02-01", 16).otherwise(0)
    )
    with pytest.raises(plans.ChecksFailed) as failed:
        plans.publish(bad, "shown", "mart_daily_metrics", order, "mart_daily_metrics")
    assert failed.value.violations == [
        ("mart_daily_metrics", "nap_count > 15", 1), ("mart_daily_metrics", "baby_id, metric_date repeats", 3)
    ]
    assert spark.table("shown.mart_daily_metrics").count() == 50
    assert len([t for t in spark.catalog.listTables("shown") if t.name.startswith("mart_daily_metrics__")]) == 1
    with pytest.raises(plans.ChecksFailed, match="nap_count > 15"):
        plans.publish(bad, "shown", "mart_daily_metrics", order, "mart_daily_metrics", ["baby_id, metric_date repeats"])
    plans.publish(bad, "shown", "mart_daily_metrics", order, "mart_daily_metrics", ["baby_id, metric_date repeats", "nap_count > 15"])
    assert spark.table("shown.mart_daily_metrics").count() == 53
    spark.sql("DROP DATABASE shown CASCADE")


def test_checks_of_a_relation_in_one_pass(spark):
    rows = B.feeds(spark, [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 11:00:00", "TEA")])
    staged = stage_feeds(rows.unionByName(rows.where("feeding_type = 'TEA'")), B.profiles(spark))
    report = quality.checked(staged.withColumn("age_days", F.lit(None).cast("int")), "stg_feeding_sessions")
    found = {r.check_name: r.violations for r in report.collect() if r.violations}
    assert found == {"age_days is null": 3, "feeding_type is not accepted": 2, "feeding_id repeats": 1}
    assert report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 4


def test_a_build_with_a_violation_turns_no_view(spark, base):
    loading.create_tables(spark, base)
    loading.append_rows(people(spark, "app", "a"), table_name(base, "baby_profiles"))
    sleeps = [("a", f"2024-03-0{d} 13:00:00", f"2024-03-0{d} 14:00:00") for d in range(1, 6)]
    loading.append_rows(tagged(B.sleeps(spark, sleeps), "app"), table_name(base, "sleep_sessions"))
    built = plans.build(spark, base, base, "ci")
    assert sum(r.violations for r in built["data_checks"].collect()) == 0
    mart = f"{base}_marts.mart_daily_metrics"
    before = sorted(map(tuple, spark.table(mart).collect()))
    many = B.diapers(spark, [("a", f"2024-03-02 1{i % 10}:{i:02}:00", True, True) for i in range(26)])
    loading.append_rows(tagged(many, "app"), table_name(base, "diaper_events"))
    with pytest.raises(plans.ChecksFailed, match="mart_daily_metrics: diaper_count > 25 .1."):
        plans.build(spark, base, base, "ci")
    assert sorted(map(tuple, spark.table(mart).collect())) == before
    names = [t.name for t in spark.catalog.listTables(f"{base}_marts") if "__" in t.name]
    assert len(names) == 3  # one version each
    plans.build(spark, base, base, "ci", tolerated=["diaper_count > 25"])
    assert max(r.diaper_count for r in spark.table(mart).collect()) == 26
    spark.sql(f"DROP DATABASE {base}_marts CASCADE")


def test_checks_cost_no_exchange(spark, tmp_path):
    """Repeats of the grain are seen where rows are written: one exchange, by range."""
    days = spark.range(9).selectExpr("concat('b', id) AS baby_id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS metric_date")
    order = ("baby_id", "metric_date")
    plan = plans.in_order(days, order, plans.GRAINS["mart_daily_metrics"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_a_subject_filter_skips_files_of_published_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shown LOCATION '{tmp_path}/shown'")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        days = spark.range(5000).selectExpr("format_string('b%05d', id) AS baby_id", "DATE'2024-01-01' AS metric_date")
        plans.publish(days, "shown", "mart", ("baby_id", "metric_date"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    version = next(t.name for t in spark.catalog.listTables("shown") if t.name.startswith("mart__"))
    files = spark.table(f"shown.{version}").groupBy("_metadata.file_path").agg(F.min("baby_id"), F.max("baby_id")).collect()
    spans = sorted((low, high) for _, low, high in files)
    assert len(spans) == 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    one = spark.table("shown.mart").where("baby_id = 'b00042'")
    assert "PushedFilters: [IsNotNull(baby_id), EqualTo(baby_id,b00042)]" in one._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP DATABASE shown CASCADE")


def test_text_form(spark, tmp_path):
    rows = tagged(B.diapers(spark, [("a", "2024-01-01 10:00:00", True, False), ("b", "2024-01-01 10:00:00", None, True)]), "app")
    rows = rows.withColumn("notes", F.when(F.col("baby_id") == "a", 'two\nlines, "quoted"'))
    write_text(rows, "diaper_events", str(tmp_path / "csv"))
    back = read_text(spark, "diaper_events", str(tmp_path / "csv"))
    assert back.schema == schemas.with_source(schemas.DIAPERS)
    assert sorted(back.collect(), key=lambda r: r.id) == sorted(rows.collect(), key=lambda r: r.id)


def test_a_failed_batch_changes_nothing(spark, table):
    before = stored(spark, table)
    broken = batch(spark, "a", "c").withColumn("notes", F.when(F.col("baby_id") == "c", F.raise_error("bad row")))
    with pytest.raises(Exception, match="bad row"):
        loading.tagged_replace(broken, table)
    assert stored(spark, table) == before


def people(spark, tag, *names):
    born = {n: date(2024, 1, 1) for n in names}
    return tagged(B.profiles(spark, born), tag)


def named(spark, name):
    return sorted((r.id, r.name, r.source) for r in spark.table(name).collect())


def test_upsert(spark, nobody):
    loading.append_rows(people(spark, "app", "a", "b"), nobody)
    changed = people(spark, "ingested", "b", "c").withColumn("name", F.lit("new"))
    for _ in range(2):
        assert loading.upsert(changed, nobody) == 2
        assert named(spark, nobody) == [("a", "A", "app"), ("b", "new", "ingested"), ("c", "new", "ingested")]


def test_upsert_can_empty_a_tag(spark, nobody):
    loading.append_rows(people(spark, "app", "a", "b"), nobody)
    loading.upsert(people(spark, "ingested", "a", "b"), nobody)
    assert named(spark, nobody) == [("a", "A", "ingested"), ("b", "B", "ingested")]


def test_upsert_refuses_repeated_keys(spark, nobody):
    loading.append_rows(people(spark, "app", "a"), nobody)
    twice = people(spark, "ingested", "a").unionByName(people(spark, "ingested", "a"))
    with pytest.raises(ValueError, match="repeats id"):
        loading.upsert(twice, nobody)
    assert named(spark, nobody) == [("a", "A", "app")]


def test_missing_tables_are_listed(spark, base):
    with pytest.raises(LookupError, match="baby_profiles, diaper_events"):
        require_tables(spark, base, ("baby_profiles", "diaper_events"))


@pytest.mark.parametrize(
    "target,custom,expected",
    [("local", None, "base"), ("local", " marts ", "marts"), ("ci", "marts", "base_marts"), ("ci", None, "base")],
)
def test_namespace(target, custom, expected):
    assert plans.namespace("base", target, custom) == expected


def exports(folder):
    def write(name, text):
        (folder / name).write_text(text, encoding="utf-8")

    write("Ann_diaper.csv", "Time,Status,Note\n1/2/24 7:05 am,Wet,\n2/2/24 7:05 am,Mixed,x\n")
    write("Ann_sleep.csv", "Baby,Time,Duration (min),Note\nAnn,1/2/24 8:00 pm,600,\nAnn,2/2/24 9:00 am,60,\nAnn,2/2/24 2:00 pm,,\n")
    write("Ann_nursing.csv", "Time,Start side,Left duration (min),Right Duration (min),Total (min),Note\n1/2/24 7:00 am,Left,5,4,9,\n")
    write("Bob_expressed.csv", 'Baby,Time,Amount (ml),Note\nBob,1/2/24 7:00 am,"1,090",\nBob,1/2/24 9:00 am,80,\n')


def test_unchanged_exports_are_not_opened(spark, tmp_path, base, monkeypatch):
    """A listing tells what is new, changed or gone; only the files of those subjects are read and rewritten."""
    folder = tmp_path / "exports"
    folder.mkdir()
    exports(folder)
    entry = {"date_of_birth": "2024-01-01", "gender": "other", "timezone": "UTC", "datetime_format": FORMAT}
    ann, both = (subjects.registry(spark, [{"name": n, **entry} for n in names]) for names in (("Ann",), ("Ann", "Bob")))
    loading.create_tables(spark, base)
    read, reader = [], plans.read_all_exports
    monkeypatch.setattr(plans, "read_all_exports", lambda *a, **k: read.append(k["files"]) or reader(*a, **k))

    def ingest(registered, **more):
        report = plans.ingest_changed(spark, str(folder), registered, base, datetime(2024, 3, 1), **more)
        return {r.table_name: r.rows for r in report.collect()}

    def counts():
        return [spark.table(table_name(base, t)).count() for t in schemas.LOADED_TABLES]

    assert ingest(ann)[None] == 1 + 2 + 2 + 1 and counts() == [1, 2, 1, 2]
    assert ingest(ann)[None] == 0 and len(read) == 1  # nothing changed, nothing read
    assert ingest(both)[None] == 1 + 2 and counts() == [2, 2, 3, 2]  # Bob is registered now
    assert [f.rpartition("/")[2] for f in read[-1]] == ["Bob_expressed.csv"]
    before = partitions(spark, table_name(base, "diaper_events"))
    (folder / "Ann_diaper.csv").write_text("Time,Status,Note\n1/2/24 7:05 am,Wet,\n2/2/24 7:05 am,Wet,\n3/2/24 7:05 am,Wet,\n", encoding="utf-8")
    assert ingest(both)["diaper_events"] == 3 and counts() == [2, 3, 3, 2]
    assert sorted(f.rpartition("/")[2] for f in read[-1]) == ["Ann_diaper.csv", "Ann_nursing.csv", "Ann_sleep.csv"]
    assert partitions(spark, table_name(base, "diaper_events")) != before
    (folder / "Bob_expressed.csv").unlink()
    with pytest.raises(loading.RowsLost, match="feeding_sessions from 2 to 0"):
        ingest(both)
    assert counts() == [2, 3, 3, 2]
    ingest(both, accept_fewer=True)
    assert counts() == [2, 3, 1, 2] and len(read) == 5
    assert ingest(both)[None] == 0 and len(read) == 5
    with pytest.raises(FileNotFoundError):
        plans.ingest_changed(spark, str(tmp_path / "nowhere"), both, base, datetime(2024, 3, 1))


def test_a_refused_load_changes_no_table(spark, base):
    loading.create_tables(spark, base)
    events = {"diaper_events": people_with_diapers(spark, 5), "sleep_sessions": B.sleeps(spark, []), "feeding_sessions": B.feeds(spark, [])}
    loading.load(spark, base, people(spark, "ingested", "a"), events)
    fewer = events | {"diaper_events": people_with_diapers(spark, 4)}
    with pytest.raises(loading.RowsLost, match="diaper_events from 5 to 4"):
        loading.load(spark, base, people(spark, "ingested", "a", "b"), fewer)
    assert named(spark, table_name(base, "baby_profiles")) == [("a", "A", "ingested")]
    loads = {load for _, _, load in partitions(spark, table_name(base, "baby_profiles"))}
    assert len(loads) == 1  # nothing of the refused load is left


def test_from_exports_to_tables(spark, tmp_path, base):
    folder = tmp_path / "exports"
    folder.mkdir()
    exports(folder)
    known = subjects.registry(
        spark,
        [{"name": n, "date_of_birth": "2024-01-01", "gender": "other", "timezone": "UTC", "datetime_format": FORMAT} for n in ("Ann", "Bob")],
    )
    as_of = datetime(2024, 3, 1)
    loading.create_tables(spark, base)
    loading.append_rows(tagged(B.diapers(spark, [("x", "2024-01-01 10:00:00", True, True)]), "app"), table_name(base, "diaper_events"))
    counts = []
    for _ in range(2):
        report = plans.ingest_exports(spark, str(folder), known, base, as_of)
        counts.append({r.table_name: r.rows for r in report.collect()})
    assert counts[0] == counts[1] == {"baby_profiles": 2, "diaper_events": 2, "feeding_sessions": 3, "sleep_sessions": 2, None: 9}

    first = loading.stored_counts(spark, base)
    first = spark.createDataFrame(first.collect(), first.schema)
    assert loading.ingested_rows(open_tables(spark, base)["diaper_events"]) == 2
    (folder / "Ann_diaper.csv").write_text("Time,Status,Note\n1/2/24 7:05 am,Wet,\n", encoding="utf-8")
    with pytest.raises(loading.RowsLost, match="diaper_events from 2 to 1"):
        plans.ingest_exports(spark, str(folder), known, base, as_of, only="ann")
    assert loading.ingested_rows(open_tables(spark, base)["diaper_events"]) == 2
    (folder / "Stranger_diaper.csv").write_text("Time,Status,Note\n1/2/24 7:05 am,Wet,\n", encoding="utf-8")
    plans.ingest_exports(spark, str(folder), known, base, as_of, only="ann", accept_fewer=True)
    report = loading.reload_report(first, loading.stored_counts(spark, base)).collect()
    moved = {(r.table_name, r.source): (r.rows_before, r.rows_after) for r in report}
    assert moved["diaper_events", "ingested"] == (2, 1)
    assert moved["diaper_events", "app"] == (1, 1)
    assert moved["feeding_sessions", "ingested"] == (3, 3)
    assert [r.table_name for r in report if r.unexpected_change] == ["diaper_events"]
    whole = plans.ingest_exports(spark, str(folder), known, base, as_of)
    assert {r.table_name: r.rows for r in whole.collect()}["not registered: diaper"] == 1

    built = plans.build(spark, base, "unused", "local")
    mart = {(r.baby_name, r.metric_date): r for r in spark.table("marts.mart_daily_metrics").collect()}
    assert set(mart) == {("Ann", date(2024, 2, 1)), ("Ann", date(2024, 2, 2)), ("Bob", date(2024, 2, 1))}
    ann = mart["Ann", date(2024, 2, 1)]
    assert (ann.night_sleep_minutes, ann.feed_count, ann.wet_diaper_count, ann.age_days) == (600, 1, 1, 31)
    assert mart["Ann", date(2024, 2, 2)].avg_wake_window_minutes == 180
    bob = mart["Bob", date(2024, 2, 1)]
    assert (bob.total_volume_ml, bob.avg_feed_interval_minutes) == (1170, 120)
    assert spark.table("stg_sleep_sessions").count() == built["fct_sleep_sessions"].count() == 2
    assert "source" not in spark.table("raw_diaper_events").columns
    assert set(raw_relations(open_tables(spark, base))) == set(schemas.TABLES)
    spark.sql("DROP DATABASE marts CASCADE")


def test_keys_of_a_large_batch_are_shuffled_not_copied(spark, tmp_path, monkeypatch):
    target = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1), (None, 1)], "id string, n int")
    spark.createDataFrame([("a", 2), ("c", 2), ("d", 2)], "id string, n int").write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    for copied in (3, 2):
        monkeypatch.setattr(session, "COPIED", copied)
        for rows in (loading.upserted(target, batch, "id"), loading.upserted(target, batch, "id", 3)):
            assert ("BroadcastHashJoin" in rows._jdf.queryExecution().sparkPlan().toString()) == (copied == 3)
            assert sorted(map(tuple, rows.collect()), key=repr) == [("a", 2), ("b", 1), ("c", 2), ("d", 2), (None, 1)]


def test_changed_subjects_are_found_once(spark, tmp_path, base, monkeypatch):
    """What is loaded reads the chosen subjects, not the comparison of listings that chose them, over and over."""
    folder, plans_of, loaded = tmp_path / "exports", [], plans._loaded
    folder.mkdir()
    exports(folder)
    entry = {"date_of_birth": "2024-01-01", "gender": "other", "timezone": "UTC", "datetime_format": FORMAT}
    both = subjects.registry(spark, [{"name": n, **entry} for n in ("Ann", "Bob")])
    loading.create_tables(spark, base)

    def seen(spark, texts, chosen, *rest):
        plans_of.append(chosen._jdf.queryExecution().optimizedPlan().toString())
        return loaded(spark, texts, chosen, *rest)

    monkeypatch.setattr(plans, "_loaded", seen)
    plans.ingest_changed(spark, str(folder), both, base, datetime(2024, 3, 1))
    assert len(plans_of) == 1 and plans_of[0].startswith("Relation") and "Join" not in plans_of[0]


def test_held_rows_are_those_not_carried_over(spark, empty):
    """Without a second read of what was replaced; rows of nobody, and rows that come twice, are counted as they are."""
    days = [{"id": f"d{i}", "baby_id": baby} for i, baby in enumerate(("a", "a", "b", None, "c"))]
    rows = B.frame(spark, "diaper_events", days)
    loading.append_rows(tagged(rows.unionByName(rows.where("id = 'd0'")), loading.K.INGESTED), empty, 1)
    chosen = spark.createDataFrame([("a",), ("a",), ("x",)], "baby_id string")
    change = loading.prepare_subject_replace(rows.where("id = 'd1'"), chosen, empty)
    assert (change.held, change.size) == (3, 1)
    change.turn()
    assert [x[0] for x in stored(spark, empty)] == ["d1", "d2", "d3", "d4"]
