import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from carelens import constants as K
from carelens import session
from carelens.functions import ids
from carelens.functions import text as X
from carelens.functions import time as T
from carelens.operators import ingest
from carelens.sources import exports, subjects
from carelens.sources.exports import ExportFolder, export_schema, read_all_exports, read_exports

DAY_FIRST = "%d/%m/%y %I:%M %p"


def values(spark, column, texts, kind="string"):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def rows_of(spark, kind, *rows, fmt=DAY_FIRST):
    names = export_schema(kind).fieldNames()
    data = [tuple({"row_id": str(i), "subject": "S", **row}.get(n) for n in names) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(data, export_schema(kind))
    return frame.withColumn("baby_id", F.lit("b")).withColumn("datetime_format", F.lit(fmt))


@pytest.mark.parametrize("fmt", [DAY_FIRST, K.DEFAULT_DATETIME_FORMAT, "%d/%m/%Y %H:%M", "%Y-%m-%d %H:%M:%S"])
def test_times_parse_like_strptime(spark, fmt):
    moments = [datetime(2024, 2, 29, 0, 5), datetime(2023, 12, 3, 12, 0), datetime(2024, 1, 9, 23, 59), datetime(1999, 7, 4, 7, 30)]
    texts = []
    for m in moments:
        full = m.strftime(fmt)
        texts += [full, f" {full.lower()}\t", full.replace("/0", "/").replace(" PM", "\u202fpm").replace(" AM", "\u202fam")]
    expected = [datetime.strptime(t.strip().replace("\u202f", " ").upper(), fmt) for t in texts]
    assert values(spark, T.parse_export_time(F.col("t"), F.lit(fmt)), texts) == expected


def test_format_is_a_column(spark):
    rows = spark.createDataFrame([("3/2/24 7:05 PM", DAY_FIRST), ("3/2/24 7:05 PM", "%m/%d/%y %I:%M %p")], "t string, f string")
    got = rows.select(T.parse_export_time(F.col("t"), F.col("f"))).collect()
    assert [r[0] for r in got] == [datetime(2024, 2, 3, 19, 5), datetime(2024, 3, 2, 19, 5)]


def test_malformed_time_raises(spark):
    with pytest.raises(Exception, match="(?i)parse|CANNOT"):
        values(spark, T.parse_export_time(F.col("t"), F.lit(DAY_FIRST)), ["1/24/24 7:05 PM"])


def test_numbers(spark):
    texts = ["1,357", " 7 ", "", "  ", None, "-3", "1,234,567"]
    assert values(spark, X.parse_int(F.col("t")), texts) == [1357, 7, None, None, None, -3, 1234567]
    assert values(spark, X.parse_float(F.col("t")), ["1,000.5", "", None]) == [1000.5, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, X.parse_int(F.col("t")), ["7.5"])


def test_strip_matches_python(spark):
    texts = ["\u202f a b\u00a0", "\t\r\nx\x1f", "\u2003", "plain"]
    assert values(spark, X.strip(F.col("t")), texts) == [t.strip() for t in texts]


def test_uuid5_matches_python(spark):
    names = ["Ann", "Zoë", "", "名前", "a" * 200]
    space = uuid.UUID(K.SUBJECT_NAMESPACE)
    assert values(spark, ids.uuid5(K.SUBJECT_NAMESPACE, F.col("t")), names) == [str(uuid.uuid5(space, n)) for n in names]


def test_diaper_statuses(spark):
    statuses = ["Wet", "Dirty", " Mixed ", "wet", None, "Dry"]
    rows = ingest.ingest_diapers(rows_of(spark, "diaper", *({"Time": "1/2/24 7:05 am", "Status": s} for s in statuses)))
    got = [(r.has_urine, r.has_stool, r.urine_volume, r.stool_consistency, r.stool_color) for r in rows.orderBy("id").collect()]
    wet, dry = (True, False, "MODERATE", None, None), (False, False, "NONE", None, None)
    assert got == [wet, (False, True, "NONE", "SOFT", "YELLOW"), (True, True, "MODERATE", "SOFT", "YELLOW"), dry, dry, dry]


def test_sleeps(spark):
    rows = ingest.ingest_sleeps(
        rows_of(
            spark,
            "sleep",
            {"Time": "1/2/24 7:00\u202fpm", "Duration (min)": "181", "Note": " x "},
            {"Time": "1/2/24 7:00 pm", "Duration (min)": "180", "Note": "  "},
            {"Time": "not a time", "Duration (min)": " "},
            {"Time": "1/2/24 6:59 am", "Duration (min)": "1,000"},
            {"Time": "1/2/24 7:00 am", "Duration (min)": "0"},
        )
    ).orderBy("id").collect()
    assert [r.sleep_type for r in rows] == ["NIGHTTIME", "NAP", "NIGHTTIME", "NAP"]
    assert rows[0].end_time == datetime(2024, 2, 1, 22, 1)
    assert [r.notes for r in rows[:2]] == ["x", None]
    assert rows[3].end_time == rows[3].start_time
    assert {(r.location, r.wake_reason, r.source) for r in rows} == {("CRIB", "NATURAL", "ingested")}


def test_feeds(spark):
    at = {"Time": "1/2/24 7:00 am"}
    nursing = rows_of(
        spark, "nursing",
        {**at, "Start side": "Left", "Left duration (min)": "4", "Right Duration (min)": "", "Total (min)": "4"},
        {**at, "Start side": "left", "Total (min)": ""},
    )
    pump = rows_of(spark, "pump", {**at, "Start side": "Right", "Total duration (min)": "20", "Total amount (ml)": "1,357", "Right Duration (min)": "20"})
    expressed = rows_of(spark, "expressed", {**at, "Amount (ml)": "90"}, {**at, "Amount (ml)": None})
    rows = ingest.ingest_feeds(nursing, pump, expressed).collect()
    got = sorted(
        (r.feeding_type, str(r.breast_started), r.left_breast_duration or 0, r.right_breast_duration or 0,
         r.volume_consumed_ml or 0, (r.end_time - r.start_time).seconds // 60, r.volume_offered_ml == r.volume_consumed_ml)
        for r in rows
    )
    assert got == [
        ("BOTTLE", "None", 0, 0, 0, 0, True),
        ("BOTTLE", "None", 0, 0, 90, 0, True),
        ("BOTTLE", "RIGHT", 0, 20, 1357, 20, True),
        ("BREAST", "LEFT", 4, 0, 0, 4, True),
        ("BREAST", "None", 0, 0, 0, 0, True),
    ]


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8", newline="")


def test_export_files(spark, tmp_path):
    write(tmp_path, "A b#1_sleep.csv", 'Baby,Time,Duration (min),Note\r\nx,1/2/24 7:05 am,"1,357",hi\r\n\r\nx,,,\r\n')
    write(tmp_path, "Zoë+q_sleep.csv", '\ufeffTime,Note,Duration (min)\n"3/2/24 7:05 PM","a ""q""\nline, x",9\n')
    write(tmp_path, "empty_sleep.csv", "")
    write(tmp_path, "other_activity.csv", "Time\n1/1/24\n")
    (tmp_path / "old").mkdir()
    write(tmp_path / "old", "Ann_sleep.csv", "Time,Duration (min),Note\n1/1/24 7:05 am,1,archived\n")
    got = {(r.subject, r["Duration (min)"], r.Note) for r in read_exports(spark, str(tmp_path), "sleep").collect()}
    assert got == {("A b#1", "1,357", "hi"), ("A b#1", None, None), ("Zoë+q", "9", 'a "q"\nline, x')}


def test_missing_files_and_columns(spark, tmp_path):
    nothing = read_exports(spark, str(tmp_path), "nursing")
    assert nothing.schema == export_schema("nursing") and nothing.isEmpty()
    write(tmp_path, "A_nursing.csv", "When,Note\nx,y\n")
    with pytest.raises(ValueError, match="Time"):
        read_exports(spark, str(tmp_path), "nursing")


def test_alias_replaces_the_regular_file(spark, tmp_path):
    header = "Time,Start side,Total amount (ml)\n"
    write(tmp_path, "pump.csv", header + '1/2/24 7:05 PM,Left,"1,357"\n' * 2)
    write(tmp_path, "Eve_pump.csv", header + "1/2/24 7:05 PM,Left,5\n")
    write(tmp_path, "Abe_pump.csv", header + "1/2/24 7:05 PM,Left,6\n")
    rows = read_exports(spark, str(tmp_path), "pump", {"pump.csv": "Eve"}).collect()
    assert sorted((r.subject, r["Total amount (ml)"]) for r in rows) == [("Abe", "6"), ("Eve", "1,357"), ("Eve", "1,357")]
    assert len({r.row_id for r in rows}) == 3


def test_row_ids_do_not_depend_on_splits_or_other_files(spark, tmp_path):
    lines = "".join(f"1/2/24 7:05 PM,{i},note {i}\n" for i in range(5000))
    write(tmp_path, "Big_sleep.csv", "Time,Duration (min),Note\n" + lines + "1/2/24 7:05 PM,0,note 0\n")
    read = lambda: {(r.row_id, r.Note) for r in read_exports(spark, str(tmp_path), "sleep").where("subject = 'Big'").collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = read()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        source = ExportFolder(str(tmp_path))
        assert exports.lines_of(spark, source, ("sleep",)).rdd.getNumPartitions() > 4
        split = read()
        write(tmp_path, "Also_sleep.csv", "Note,Time,Duration (min)\nx,1/2/24 7:05 PM,5\n")
        assert whole == split == read()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({i for i, _ in whole}) == 5001 and len({n for _, n in whole}) == 5000


def test_files_of_one_kind_may_differ_in_layout(spark, tmp_path):
    write(tmp_path, "A_diaper.csv", "Time,Status,Note\n1/2/24 7:05 am,Wet,a\n")
    write(tmp_path, "B_diaper.csv", '"Note","Extra, one",Status,Time\n"two\nlines",x,Dirty,1/2/24 7:06 am\n')
    write(tmp_path, "C_diaper.csv", "\nStatus,Time,Status\nMixed,1/2/24 7:07 am,Wet\n")
    rows = read_exports(spark, str(tmp_path), "diaper").collect()
    got = {(r.subject, r.Time, r.Status, r.Note) for r in rows}
    assert got == {("A", "1/2/24 7:05 am", "Wet", "a"), ("B", "1/2/24 7:06 am", "Dirty", "two\nlines"), ("C", "1/2/24 7:07 am", "Mixed", None)}


def test_a_missing_folder_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        read_all_exports(spark, str(tmp_path / "nowhere"))


def test_layouts_are_found_without_sorting_or_matching_lines(spark, tmp_path):
    write(tmp_path, "A_diaper.csv", "Time,Status,Note\n1/2/24 7:05 am,Wet,a\n")
    lines = exports.lines_of(spark, ExportFolder(str(tmp_path)), K.EXPORT_KINDS)
    text = exports.layouts(lines)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "regexp" not in text.lower() and "rlike" not in text.lower() and "url_decode" not in text.lower()


def test_one_subject_leaves_the_files_of_others_unread(spark, tmp_path):
    for name in ("Ann", "Bob", "Joann"):
        write(tmp_path, f"{name}_diaper.csv", "Time,Status,Note\n1/2/24 7:05 am,Wet,\n")
    rows = read_all_exports(spark, str(tmp_path), only="ANN")["diaper"]
    assert [r.subject for r in rows.collect()] == ["Ann"]
    lines = exports.lines_of(spark, ExportFolder(str(tmp_path), only="bob"), ("diaper",))
    assert lines.select("file").distinct().count() == 1


def test_registry(spark):
    entries = [
        {"name": "Ann", "date_of_birth": "2024-01-01", "gender": "female", "timezone": "UTC", "datetime_format": DAY_FIRST},
        {"name": "Bob", "date_of_birth": date(2023, 5, 5), "gender": "male", "timezone": "UTC", "birth_weight": 3.5},
    ]
    known = subjects.registry(spark, entries)
    assert [r.name for r in subjects.only_subject(known, "aNN").collect()] == ["Ann"]
    with pytest.raises(LookupError, match="Zed"):
        subjects.only_subject(known, "Zed")
    with pytest.raises(ValueError, match="timezone"):
        subjects.registry(spark, [{"name": "X", "date_of_birth": "2024-01-01", "gender": "other"}])
    with pytest.raises(ValueError, match="%j"):
        subjects.registry(spark, [{**entries[0], "datetime_format": "%j %H:%M"}])
    rows = {r.name: r for r in subjects.profiles_from(known, datetime(2024, 3, 1, 12)).collect()}
    assert rows["Ann"].id == str(uuid.uuid5(uuid.UUID(K.SUBJECT_NAMESPACE), "Ann"))
    assert rows["Bob"].created_at == datetime(2023, 5, 5)
    assert rows["Bob"].updated_at == datetime(2024, 3, 1, 12)
    assert (rows["Bob"].birth_weight, rows["Ann"].birth_weight) == (3.5, None)
    assert {r.notes for r in rows.values()} == {K.DEFAULT_PROFILE_NOTES}
    assert {(r.is_active, r.source) for r in rows.values()} == {(True, "ingested")}
    assert subjects.list_subjects(known).columns == ["name", "date_of_birth", "baby_id"]


def test_only_registered_subjects_are_ingested(spark, tmp_path):
    for name in ("Ann", "Stranger"):
        write(tmp_path, f"{name}_diaper.csv", "Time,Status,Note\n1/2/24 7:05 am,Wet,\n")
    known = subjects.registry(spark, [{"name": "Ann", "date_of_birth": "2024-01-01", "gender": "female", "timezone": "UTC"}])
    tables = ingest.ingest(read_all_exports(spark, str(tmp_path)), known)
    assert [t.count() for t in tables.values()] == [1, 0, 0]


def test_large_registry_is_shuffled_not_copied(spark, tmp_path, monkeypatch):
    """Whatever Spark guesses of its size; a small one is left to Spark, and rows are the same either way."""
    born = {"date_of_birth": "2024-01-01", "gender": "other", "timezone": "UTC"}
    path = str(tmp_path / "registry")
    subjects.registry(spark, [{"name": name, **born} for name in "abc"]).write.parquet(path)
    registry = spark.read.parquet(path)
    rows = spark.createDataFrame([("a",), ("a",), ("c",), ("x",), (None,)], "subject string")
    exports = {kind: spark.createDataFrame([], export_schema(kind)) for kind in K.EXPORT_KINDS}
    found = []
    for copied in (3, 2):
        monkeypatch.setattr(session, "COPIED", copied)
        frames = [ingest.attach_subjects(rows, registry), ingest.left_out(rows, registry), *ingest.ingest(exports, registry).values()]
        plans = [frame._jdf.queryExecution().sparkPlan().toString() for frame in frames]
        assert all(("BroadcastHashJoin" in plan) == (copied == 3) for plan in plans)
        found.append([sorted(r.subject or "" for r in frame.collect()) for frame in frames[:2]])
    assert found == [[["a", "a", "c"], ["", "x"]]] * 2
