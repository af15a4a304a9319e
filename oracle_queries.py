"""Plain SQL answers for the registered queries, written for DuckDB.

Each statement starts from the same derivation of care events from the test
tables and then follows the textbook formulation (row-wise gaps, one window
per subject), not the shape the Spark jobs use.
"""

from __future__ import annotations

PARTS: dict[str, str] = {
    "ev": """
        SELECT event_id, user_id // 3 AS baby_id, event_type, ts, date_trunc('second', ts) AS st,
               CAST(floor(value) AS INTEGER) AS mins
        FROM events""",
    "kid": """
        SELECT c_custkey AS baby_id, c_name AS baby_name,
               DATE '2023-06-01' + CAST(c_custkey % 200 AS INTEGER) AS date_of_birth
        FROM customer""",
    "slp": """
        SELECT event_id AS id, baby_id, st AS start_time, st + to_minutes(mins) AS end_time,
               CASE WHEN (hour(st) >= 19 OR hour(st) < 7) AND mins > 180 THEN 'NIGHTTIME' ELSE 'NAP' END AS sleep_type
        FROM ev WHERE event_type IN ('view', 'error')""",
    "fed": """
        SELECT event_id AS id, baby_id, st AS start_time,
               CASE WHEN kind = 'BOTTLE' AND event_id % 2 = 0 THEN st ELSE st + to_minutes(mins) END AS end_time,
               kind AS feeding_type,
               CASE WHEN kind = 'BREAST' THEN CASE event_id % 2 WHEN 0 THEN 'LEFT' ELSE 'RIGHT' END END AS breast_started,
               CASE WHEN kind = 'BREAST' AND event_id % 3 <> 0 THEN mins // 2 END AS left_min,
               CASE WHEN kind = 'BREAST' AND event_id % 4 <> 0 THEN mins - mins // 2 END AS right_min,
               CASE WHEN kind = 'BOTTLE' AND event_id % 5 <> 0 THEN mins END AS ml
        FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN 'BOTTLE'
                             WHEN event_id % 10 = 9 THEN 'SOLID' ELSE 'BREAST' END AS kind
              FROM ev WHERE event_type IN ('click', 'purchase'))""",
    "dia": """
        SELECT event_id AS id, baby_id, st AS event_time,
               event_id % 4 IN (0, 2) AS has_urine, event_id % 4 IN (1, 2) AS has_stool
        FROM ev WHERE event_type = 'signup'""",
    "sleep": """
        SELECT id AS sleep_id, baby_id, baby_name, date_of_birth, start_time, end_time,
               CAST(round((epoch_us(end_time) - epoch_us(start_time)) / CAST(60000000 AS DOUBLE)) AS INTEGER)
                   AS duration_minutes,
               sleep_type,
               CAST(date_diff('day', date_of_birth, CAST(start_time AS DATE)) AS INTEGER) AS age_days,
               CAST(date_diff('day', date_of_birth, CAST(start_time AS DATE)) // 7 AS INTEGER) AS age_weeks
        FROM slp JOIN kid USING (baby_id) WHERE end_time > start_time""",
    "feed": """
        SELECT id AS feeding_id, baby_id, baby_name, date_of_birth, start_time, end_time,
               CAST(round((epoch_us(end_time) - epoch_us(start_time)) / CAST(60000000 AS DOUBLE)) AS INTEGER)
                   AS duration_minutes,
               feeding_type, breast_started, left_min AS left_breast_duration, right_min AS right_breast_duration,
               CASE WHEN NOT (left_min IS NULL AND right_min IS NULL)
                    THEN ifnull(left_min, 0) + ifnull(right_min, 0) END AS breast_duration_minutes,
               ml AS volume_offered_ml, ml AS volume_consumed_ml,
               CAST(date_diff('day', date_of_birth, CAST(start_time AS DATE)) AS INTEGER) AS age_days,
               CAST(date_diff('day', date_of_birth, CAST(start_time AS DATE)) // 7 AS INTEGER) AS age_weeks
        FROM fed JOIN kid USING (baby_id)""",
    "diaper": """
        SELECT id AS diaper_id, baby_id, baby_name, date_of_birth, event_time, has_urine, has_stool,
               CAST(date_diff('day', date_of_birth, CAST(event_time AS DATE)) AS INTEGER) AS age_days,
               CAST(date_diff('day', date_of_birth, CAST(event_time AS DATE)) // 7 AS INTEGER) AS age_weeks
        FROM dia JOIN kid USING (baby_id)""",
    # Sleeps with the part of the day they belong to. A night's date is the date seven hours before it began.
    "rest": """
        SELECT *, CAST(start_time AS DATE) AS calendar_date,
               CASE WHEN is_night THEN CAST(start_time - INTERVAL 7 HOUR AS DATE) END AS night_date
        FROM (SELECT *, clock < 420 OR clock >= 1140 OR (clock >= 1080 AND duration_minutes > 180) AS is_night
              FROM (SELECT *, 60 * hour(start_time) + minute(start_time) AS clock FROM sleep))""",
    # The nearest later start of each start. Of sleeps begun together only the one that lasts longest can
    # be followed by an awake gap; the others are still covered by it.
    "wake": """
        SELECT baby_id, baby_name, wake_start, wake_end, minutes AS wake_window_minutes,
               CAST(wake_start AS DATE) AS calendar_date,
               CAST(date_diff('day', date_of_birth, CAST(wake_start AS DATE)) AS INTEGER) AS age_days,
               CAST(date_diff('day', date_of_birth, CAST(wake_start AS DATE)) // 7 AS INTEGER) AS age_weeks
        FROM (SELECT a.baby_id, a.until AS wake_start, b.since AS wake_end,
                     CAST(round(date_diff('microsecond', a.until, b.since) / CAST(6e7 AS DOUBLE)) AS INTEGER) AS minutes
              FROM begun a ASOF JOIN begun b ON a.baby_id = b.baby_id AND a.since < b.since
              WHERE b.since > a.until)
        JOIN kid USING (baby_id)
        WHERE minutes >= 5 AND minutes <= 360 AND extract('hour' FROM wake_start) NOT IN (21, 22, 23, 0, 1, 2, 3, 4, 5)""",
    "begun": """
        SELECT baby_id, start_time AS since, max(end_time) AS until FROM sleep GROUP BY baby_id, start_time""",
    # Everything that counts toward a day, one row per contribution; ``seen`` is set where it is an event of its own.
    "share": """
        SELECT baby_id, coalesce(night_date, calendar_date) AS day, if(is_night, 'night', 'nap') AS what,
               CAST(duration_minutes AS BIGINT) AS amount, calendar_date AS seen FROM rest
        UNION ALL
        SELECT baby_id, night_date, 'awake', date_diff('microsecond', row_[i].until, row_[i + 1].since), NULL
        FROM (SELECT baby_id, night_date, unnest(range(1, len(row_))) AS i, row_
              FROM (SELECT baby_id, night_date,
                           list({'since': start_time, 'until': end_time} ORDER BY start_time, end_time, sleep_id) AS row_
                    FROM rest WHERE is_night GROUP BY baby_id, night_date))
        UNION ALL
        SELECT baby_id, CAST(start_time AS DATE), feeding_type, volume_consumed_ml, CAST(start_time AS DATE) FROM feed
        UNION ALL
        SELECT b.baby_id, CAST(b.begun_at AS DATE), 'pause', date_diff('microsecond', a.begun_at, b.begun_at), NULL
        FROM (SELECT DISTINCT baby_id, start_time AS begun_at FROM feed) b
        ASOF JOIN (SELECT DISTINCT baby_id, start_time AS begun_at FROM feed) a ON a.baby_id = b.baby_id AND a.begun_at < b.begun_at
        WHERE date_diff('microsecond', a.begun_at, b.begun_at) BETWEEN 60000000 AND 43200000000
        UNION ALL
        SELECT baby_id, calendar_date, 'window', wake_window_minutes, NULL FROM wake
        UNION ALL
        SELECT baby_id, CAST(event_time AS DATE), 'diaper', CAST(has_urine AS INTEGER) + 2 * CAST(has_stool AS INTEGER),
               CAST(event_time AS DATE) FROM diaper""",
    "tally": """
        SELECT baby_id, day AS metric_date,
               CAST(sum(amount) FILTER (WHERE what = 'night') AS BIGINT) AS night_sleep_minutes,
               nullif(count(*) FILTER (WHERE what = 'night'), 0) AS night_sleep_segments,
               CAST(max(amount) FILTER (WHERE what = 'night') AS INTEGER) AS longest_night_stretch_minutes,
               CAST(round(CAST(sum(amount) FILTER (WHERE what = 'awake') AS DOUBLE) / 60000000) AS INTEGER)
                   AS awake_at_night_minutes,
               nullif(count(*) FILTER (WHERE what = 'awake'), 0) AS night_waking_count,
               nullif(count(*) FILTER (WHERE what = 'nap'), 0) AS nap_count,
               CAST(sum(amount) FILTER (WHERE what = 'nap') AS BIGINT) AS total_nap_minutes,
               CAST(round(avg(amount) FILTER (WHERE what = 'nap')) AS INTEGER) AS avg_nap_minutes,
               nullif(count(*) FILTER (WHERE what IN ('BREAST', 'BOTTLE', 'SOLID')), 0) AS feed_count,
               count(*) FILTER (WHERE what = 'BREAST') AS breast_feed_count,
               count(*) FILTER (WHERE what = 'BOTTLE') AS bottle_feed_count,
               CAST(sum(amount) FILTER (WHERE what IN ('BREAST', 'BOTTLE', 'SOLID')) AS BIGINT) AS total_volume_ml,
               CAST(round(avg(amount) FILTER (WHERE what = 'pause') / 60000000) AS INTEGER) AS avg_feed_interval_minutes,
               CAST(round(avg(amount) FILTER (WHERE what = 'window')) AS INTEGER) AS avg_wake_window_minutes,
               CAST(max(amount) FILTER (WHERE what = 'window') AS INTEGER) AS max_wake_window_minutes,
               nullif(count(*) FILTER (WHERE what = 'diaper'), 0) AS diaper_count,
               count(*) FILTER (WHERE what = 'diaper' AND amount IN (1, 3)) AS wet_diaper_count,
               count(*) FILTER (WHERE what = 'diaper' AND amount IN (2, 3)) AS dirty_diaper_count
        FROM share GROUP BY baby_id, day""",
    "life": """
        SELECT baby_id, min(seen) AS first_date, max(seen) AS last_date FROM share WHERE seen IS NOT NULL GROUP BY baby_id""",
    "days": """
        SELECT baby_id, baby_name, date_of_birth, first_date + CAST(n AS INTEGER) AS metric_date
        FROM (SELECT *, unnest(range(0, last_date - first_date + 1)) AS n FROM life JOIN kid USING (baby_id))""",
    "daily": """
        SELECT d.baby_id, d.baby_name, d.metric_date,
               CAST(date_diff('day', d.date_of_birth, d.metric_date) AS INTEGER) AS age_days,
               CAST(date_diff('day', d.date_of_birth, d.metric_date) // 7 AS INTEGER) AS age_weeks,
               t.* EXCLUDE (baby_id, metric_date) REPLACE (
                   ifnull(night_sleep_minutes, 0) AS night_sleep_minutes, ifnull(nap_count, 0) AS nap_count,
                   ifnull(total_nap_minutes, 0) AS total_nap_minutes, ifnull(feed_count, 0) AS feed_count,
                   ifnull(breast_feed_count, 0) AS breast_feed_count, ifnull(bottle_feed_count, 0) AS bottle_feed_count,
                   ifnull(diaper_count, 0) AS diaper_count, ifnull(wet_diaper_count, 0) AS wet_diaper_count,
                   ifnull(dirty_diaper_count, 0) AS dirty_diaper_count)
        FROM days d LEFT JOIN tally t ON t.baby_id = d.baby_id AND t.metric_date = d.metric_date""",
}

_TREE = {
    "ev": (), "kid": (), "slp": ("ev",), "fed": ("ev",), "dia": ("ev",),
    "sleep": ("slp", "kid"), "feed": ("fed", "kid"), "diaper": ("dia", "kid"),
    "rest": ("sleep",), "begun": ("sleep",), "wake": ("begun", "kid"),
    "share": ("rest", "feed", "wake", "diaper"), "tally": ("share",), "life": ("share",), "days": ("life", "kid"),
    "daily": ("days", "tally"),
}


def sql(body: str, *needs: str, **replaced: str) -> str:
    """``body`` preceded by the parts it needs, in dependency order; ``replaced`` has other definitions of some."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in ("ev",) if name in replaced else _TREE[name]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{name} AS ({(PARTS | replaced)[name]})" for name in order)
    return f"WITH {parts}\n{body}"


def whole(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)


NAMESPACE_HEX = "a1b2c3d4e5f67890abcdef1234567890"

METRICS = (
    "night_sleep_minutes", "night_sleep_segments", "longest_night_stretch_minutes", "awake_at_night_minutes",
    "night_waking_count", "nap_count", "total_nap_minutes", "avg_nap_minutes", "feed_count",
    "breast_feed_count", "bottle_feed_count", "total_volume_ml", "avg_feed_interval_minutes",
    "avg_wake_window_minutes", "max_wake_window_minutes", "diaper_count", "wet_diaper_count",
    "dirty_diaper_count",
)
SUMMARY = ("night_sleep_minutes", "nap_count", "total_nap_minutes", "feed_count", "diaper_count")


def uuid5(name: str) -> str:
    """A version 5 UUID of the SQL expression ``name``."""
    digest = f"sha1(unhex('{NAMESPACE_HEX}') || encode({name}))"
    nibble = f"CAST('0x' || substr({digest}, 17, 1) AS INTEGER)"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"printf('%x', ({nibble} & 3) | 8) || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


def _nulls(*names_and_types: str) -> str:
    pairs = (item.split() for item in names_and_types)
    return ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in pairs)


def _raw() -> dict[str, str]:
    stamps = "st AS created_at, st AS updated_at"
    return {
        "raw_profiles": sql(
            f"""SELECT baby_id AS id, baby_name AS name, date_of_birth, true AS is_active,
            {_nulls('birth_weight DOUBLE', 'birth_length DOUBLE', 'birth_head_circumference DOUBLE', 'gender VARCHAR',
                    'timezone VARCHAR', 'notes VARCHAR', 'created_at TIMESTAMP', 'updated_at TIMESTAMP')}
            FROM kid""",
            "kid",
        ),
        "raw_diaper": sql(
            f"""SELECT id, dia.baby_id, dia.event_time AS "timestamp", has_urine, has_stool, {stamps},
            {_nulls('urine_volume VARCHAR', 'stool_consistency VARCHAR', 'stool_color VARCHAR',
                    'diaper_type VARCHAR', 'notes VARCHAR')}
            FROM dia JOIN ev ON ev.event_id = dia.id""",
            "dia",
        ),
        "raw_feeding": sql(
            f"""SELECT id, fed.baby_id, start_time, end_time, feeding_type, breast_started,
            left_min AS left_breast_duration, right_min AS right_breast_duration, ml AS volume_offered_ml,
            ml AS volume_consumed_ml, {stamps},
            {_nulls('formula_type VARCHAR', 'food_items VARCHAR', 'appetite VARCHAR', 'notes VARCHAR')}
            FROM fed JOIN ev ON ev.event_id = fed.id""",
            "fed",
        ),
        "raw_sleep": sql(
            f"""SELECT id, slp.baby_id, start_time, end_time, sleep_type, {stamps},
            {_nulls('location VARCHAR', 'sleep_quality VARCHAR', 'sleep_environment VARCHAR', 'wake_reason VARCHAR',
                    'notes VARCHAR')}
            FROM slp JOIN ev ON ev.event_id = slp.id""",
            "slp",
        ),
        "raw_growth": f"""SELECT o_orderkey AS id, o_custkey AS baby_id, CAST(o_orderdate AS DATE) AS measurement_date,
            o_totalprice AS weight_kg,
            {_nulls('length_cm DOUBLE', 'head_circumference_cm DOUBLE', 'measurement_context VARCHAR',
                    'measured_by VARCHAR', 'percentiles VARCHAR', 'notes VARCHAR', 'created_at TIMESTAMP',
                    'updated_at TIMESTAMP')}
            FROM orders""",
        "raw_health": f"""SELECT o_orderkey AS id, o_custkey AS baby_id, o_orderdate AS event_date,
            o_orderpriority AS event_type, o_totalprice AS temperature_celsius,
            {_nulls('title VARCHAR', 'description VARCHAR', 'symptoms VARCHAR', 'treatment VARCHAR',
                    'healthcare_provider VARCHAR', 'follow_up_required BOOLEAN', 'follow_up_date TIMESTAMP',
                    'attachments VARCHAR', 'notes VARCHAR', 'created_at TIMESTAMP', 'updated_at TIMESTAMP')}
            FROM orders""",
    }


NATION = "'nation-' || c_nationkey"


# What ingest makes of the rendered exports: times to the minute, notes trimmed.
def _ingested(subject: str) -> str:
    return f"""
    SELECT event_id AS n, CAST(event_id AS VARCHAR) AS note_no, event_type, mins,
           date_trunc('minute', ts) AS at_minute, {uuid5(subject)} AS baby
    FROM ev JOIN customer ON c_custkey = ev.baby_id"""


def _ingest() -> dict[str, str]:
    def on_ingested(body: str, subject: str = "'subject-' || c_custkey") -> str:
        return sql(f"SELECT * FROM (WITH x AS ({_ingested(subject)}) {body})", "ev", "kid")

    common = (
        "n AS id, baby AS baby_id, 'note ' || note_no AS notes, at_minute AS created_at, "
        "at_minute AS updated_at, 'ingested' AS source"
    )
    diaper = """SELECT {cols} FROM x WHERE event_type = 'signup'"""
    diaper_cols = f"""{common}, at_minute AS "timestamp", n % 4 IN (0, 2) AS has_urine,
        CASE WHEN n % 4 IN (0, 2) THEN 'MODERATE' ELSE 'NONE' END AS urine_volume, n % 4 IN (1, 2) AS has_stool,
        CASE WHEN n % 4 IN (1, 2) THEN 'SOFT' END AS stool_consistency,
        CASE WHEN n % 4 IN (1, 2) THEN 'YELLOW' END AS stool_color, 'DISPOSABLE' AS diaper_type"""
    sleep = f"""SELECT {common}, at_minute AS start_time, at_minute + to_minutes(mins) AS end_time,
        CASE WHEN mins > 180 AND (hour(at_minute) < 7 OR hour(at_minute) > 18) THEN 'NIGHTTIME' ELSE 'NAP' END
            AS sleep_type,
        'CRIB' AS location, 'NATURAL' AS wake_reason,
        {_nulls('sleep_quality VARCHAR', 'sleep_environment VARCHAR')}
        FROM x WHERE event_type IN ('view', 'error') AND n % 11 <> 0"""
    sided = """event_type = 'click' OR n % 2 = 1"""
    feed = f"""SELECT {common}, at_minute AS start_time,
        CASE WHEN ({sided}) AND n % 13 <> 0 THEN at_minute + to_minutes(mins) ELSE at_minute END AS end_time,
        CASE event_type WHEN 'click' THEN 'BREAST' ELSE 'BOTTLE' END AS feeding_type,
        CASE WHEN ({sided}) AND n % 7 <> 0 THEN CASE n % 2 WHEN 0 THEN 'LEFT' ELSE 'RIGHT' END END AS breast_started,
        CASE WHEN ({sided}) AND n % 3 <> 0 THEN mins // 2 END AS left_breast_duration,
        CASE WHEN ({sided}) AND n % 4 <> 0 THEN mins - mins // 2 END AS right_breast_duration,
        CASE WHEN event_type = 'purchase' AND n % 5 <> 0 THEN mins * 10 END AS volume_offered_ml,
        CASE WHEN event_type = 'purchase' AND n % 5 <> 0 THEN mins * 10 END AS volume_consumed_ml,
        {_nulls('formula_type VARCHAR', 'food_items VARCHAR', 'appetite VARCHAR')}
        FROM x WHERE event_type IN ('click', 'purchase')"""
    shown = "baby_id, {begin} AS begins, {end} AS ends, {label} AS label, notes, source"
    diaper_sql = diaper.format(cols=diaper_cols)
    roundtrip = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {shown.format(begin=b, end=e, label=lab)} FROM ({body})"
        for name, body, b, e, lab in (
            ("diaper_events", diaper_sql, '"timestamp"', '"timestamp"', "urine_volume"),
            ("feeding_sessions", feed, "start_time", "end_time", "feeding_type"),
            ("sleep_sessions", sleep, "start_time", "end_time", "sleep_type"),
        )
    )
    counts = (
        "SELECT 'baby_profiles' AS table_name, count(*) AS \"rows\" FROM kid "
        f"UNION ALL SELECT 'diaper_events', count(*) FROM ({diaper_sql}) "
        f"UNION ALL SELECT 'feeding_sessions', count(*) FROM ({feed}) "
        f"UNION ALL SELECT 'sleep_sessions', count(*) FROM ({sleep})"
    )
    return {
        "parse_export_time": sql(
            """SELECT event_id, date_trunc('minute', ts) AS parsed,
               strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS rendered FROM ev""",
            "ev",
        ),
        "parse_amounts": sql(
            """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN mins * 1000 END AS whole,
               CASE WHEN event_id % 5 <> 0 THEN CAST(mins * 1000 AS DOUBLE) + 0.25 END AS fractional FROM ev""",
            "ev",
        ),
        "typed_convert": sql(
            """SELECT CAST(event_id AS VARCHAR) AS id, event_id % 2 = 0 AS has_urine,
               CASE WHEN event_id % 3 <> 0 THEN mins END AS volume_offered_ml,
               CASE WHEN event_id % 4 <> 0 THEN CAST(mins AS DOUBLE) + 0.5 END AS weight_kg,
               CASE WHEN event_id % 7 <> 0 THEN event_type END AS notes FROM ev""",
            "ev",
        ),
        "subject_uuid5": f"""SELECT c_name || ' ü' AS name, DATE '2024-01-01' AS date_of_birth,
            {uuid5("c_name || ' ü'")} AS baby_id FROM customer""",
        "profiles_from_registry": sql(
            f"""SELECT {uuid5("'subject-' || baby_id")} AS id, 'subject-' || baby_id AS name, date_of_birth,
            'other' AS gender, 'UTC' AS timezone, 'Migrated from seed data' AS notes,
            CAST(date_of_birth AS TIMESTAMP) AS created_at, TIMESTAMP '2024-02-01' AS updated_at,
            true AS is_active, 'ingested' AS source,
            {_nulls('birth_weight DOUBLE', 'birth_length DOUBLE', 'birth_head_circumference DOUBLE')} FROM kid""",
            "kid",
        ),
        "profile_by_name": f"""SELECT {uuid5("c_name")} AS id, c_name AS name, DATE '2024-01-01' AS date_of_birth,
            'other' AS gender, 'UTC' AS timezone, 'Migrated from seed data' AS notes,
            TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-02-01' AS updated_at, true AS is_active,
            'ingested' AS source,
            {_nulls('birth_weight DOUBLE', 'birth_length DOUBLE', 'birth_head_circumference DOUBLE')}
            FROM customer WHERE c_name = 'Customer#000000007'""",
        "ingest_diaper": on_ingested(diaper_sql),
        "ingest_sleep": on_ingested(sleep),
        "ingest_feeding": on_ingested(feed),
        "exports_roundtrip": on_ingested(roundtrip, NATION),
        "ingest_changed": on_ingested(roundtrip, NATION),
        "ingest_one_subject": on_ingested(f"SELECT * FROM ({roundtrip}) WHERE baby_id = {uuid5(chr(39) + 'nation-7' + chr(39))}", NATION),
        "built_mart": sql(
            "SELECT * FROM daily",
            "daily",
            kid="""SELECT {id} AS baby_id, {name} AS baby_name, DATE '2023-06-01' + CAST(n_nationkey AS INTEGER) AS date_of_birth
                   FROM nation""".format(id=uuid5("'nation-' || n_nationkey"), name="'nation-' || n_nationkey"),
            slp=f"WITH x AS ({_ingested(NATION)}) SELECT id, baby_id, start_time, end_time, sleep_type FROM ({sleep})",
            fed=f"""WITH x AS ({_ingested(NATION)}) SELECT id, baby_id, start_time, end_time, feeding_type, breast_started,
                    left_breast_duration AS left_min, right_breast_duration AS right_min, volume_consumed_ml AS ml
                    FROM ({feed})""",
            dia=f"""WITH x AS ({_ingested(NATION)}) SELECT id, baby_id, "timestamp" AS event_time, has_urine, has_stool
                    FROM ({diaper_sql})""",
        ),
        "transformed_csv": on_ingested(f"SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM ({feed})"),
        "load_report": on_ingested(
            f'SELECT table_name, CAST(sum("rows") AS BIGINT) AS "rows" FROM ({counts}) GROUP BY ROLLUP (table_name)'
        ),
        "reload_report": on_ingested(
            f"""SELECT table_name, 'ingested' AS source, 0 AS rows_before, "rows" AS rows_after,
                false AS unexpected_change FROM ({counts})
                UNION ALL SELECT table_name, 'app', "rows", "rows", false FROM ({counts})
                WHERE table_name = 'diaper_events'"""
        ),
    }


def _loads() -> dict[str, str]:
    stored = "SELECT id, slp.baby_id, start_time, end_time, sleep_type, CAST(NULL AS VARCHAR) AS notes"
    building = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
    return {
        "tagged_replace": sql(
            f"""{stored}, 'app' AS source FROM slp WHERE sleep_type = 'NAP'
            UNION ALL SELECT id, baby_id, start_time, end_time, sleep_type, 'reloaded', 'ingested' FROM slp""",
            "slp",
        ),
        "subject_replace": sql(
            f"""{stored}, 'app' AS source FROM slp WHERE sleep_type = 'NAP'
            UNION ALL {stored}, 'ingested' FROM slp WHERE sleep_type = 'NIGHTTIME' AND baby_id NOT IN {building}
            UNION ALL SELECT id, baby_id, start_time, end_time, sleep_type, 'reloaded', 'ingested'
            FROM slp WHERE baby_id IN {building}""",
            "slp",
        ),
        "profile_upsert": sql(
            f"""SELECT baby_id AS id, baby_name AS name, date_of_birth, true AS is_active, 'app' AS source
            FROM kid WHERE baby_id NOT IN {building}
            UNION ALL SELECT c_custkey, c_name || ' renamed', NULL, NULL, 'ingested'
            FROM customer WHERE c_custkey IN {building}
            UNION ALL SELECT -1 - s_suppkey, s_name, NULL, NULL, 'ingested' FROM supplier""",
            "kid",
        ),
    }


def _compare() -> dict[str, str]:
    weekly = "SELECT baby_id, baby_name, age_weeks, count(*) AS days, {means} FROM daily GROUP BY 1, 2, 3".format(
        means=", ".join(f"avg({m}) AS avg_{m}" for m in SUMMARY)
    )
    reached = "SELECT baby_id, max(age_weeks) AS oldest FROM daily GROUP BY baby_id"
    sides = ", ".join(f"l.{m} AS left_{m}, r.{m} AS right_{m}" for m in METRICS)

    def aligned(age: str, values: str) -> str:
        return sql(
            f"""SELECT p.left_id, p.right_id, p.{age}, {sides}
            FROM (SELECT DISTINCT left_id, right_id, {age}
                  FROM (SELECT a.baby_id AS left_id, b.baby_id AS right_id, least(a.top, b.top) AS top
                        FROM (SELECT baby_id, max({age}) AS top FROM daily GROUP BY 1) a
                        JOIN (SELECT baby_id, max({age}) AS top FROM daily GROUP BY 1) b ON b.baby_id = a.baby_id + 1)
                  JOIN daily d ON d.baby_id = left_id OR d.baby_id = right_id
                  WHERE {age} <= top) p
            LEFT JOIN ({values}) l ON l.baby_id = p.left_id AND l.{age} = p.{age}
            LEFT JOIN ({values}) r ON r.baby_id = p.right_id AND r.{age} = p.{age}""",
            "daily",
        )

    means = ", ".join(f"avg({m}) AS {m}" for m in METRICS)
    return {
        "compare_age_days": aligned("age_days", "SELECT * FROM daily"),
        "compare_age_weeks": aligned("age_weeks", f"SELECT baby_id, age_weeks, {means} FROM daily GROUP BY 1, 2"),
        "weekly_summary_all_ages": sql(weekly, "daily"),
        "weekly_summary": sql(
            f"""SELECT a.baby_id AS left_id, b.baby_id AS right_id, w.*
            FROM ({reached}) a JOIN ({reached}) b ON b.baby_id = a.baby_id + 1
            JOIN ({weekly}) w ON w.baby_id IN (a.baby_id, b.baby_id) AND w.age_weeks <= least(a.oldest, b.oldest)""",
            "daily",
        ),
        "subject_daily": sql("SELECT * FROM daily WHERE baby_id = 7", "daily"),
    }


def _quality() -> dict[str, str]:
    needed = {
        "sleep": ("stg_sleep_sessions", "sleep_id baby_id start_time duration_minutes age_days"),
        "feed": ("stg_feeding_sessions", "feeding_id baby_id start_time feeding_type age_days"),
        "diaper": ("stg_diaper_events", "diaper_id baby_id event_time age_days"),
        "rest": ("fct_sleep_sessions", "sleep_id calendar_date is_night"),
        "wake": ("fct_wake_windows", "baby_id wake_window_minutes"),
        "daily": ("mart_daily_metrics", "baby_id baby_name metric_date age_days age_weeks"),
    }
    keys = {"sleep": "sleep_id", "feed": "feeding_id", "diaper": "diaper_id", "rest": "sleep_id"}
    bounds = (
        "night_sleep_minutes < 0", "night_sleep_minutes > 1080", "total_nap_minutes < 0", "total_nap_minutes > 720",
        "nap_count > 15", "feed_count > 30", "diaper_count > 25", "age_days < 0",
    )
    twice = "CASE WHEN {key} % 89 = 0 THEN 2 ELSE 1 END"
    beyond = {
        "night_sleep_minutes": "WHEN 0 THEN -1 WHEN 1 THEN 1081", "total_nap_minutes": "WHEN 2 THEN -1 WHEN 3 THEN 721",
        "nap_count": "WHEN 4 THEN 16", "feed_count": "WHEN 5 THEN 31", "diaper_count": "WHEN 6 THEN 26",
        "age_days": "WHEN 7 THEN -1",
    }
    odd = "(SELECT d.* REPLACE ({cases}) FROM daily d JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR baby_id % 29 = 0)".format(
        cases=", ".join(f"CASE baby_id % 11 {case} ELSE {c} END AS {c}" for c, case in beyond.items())
    )
    row_of = keys | {"wake": "baby_id", "daily": "baby_id"}
    copied = "(SELECT d.* FROM daily d JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR baby_id % 89 = 0)"
    spoiled = {c: f"CASE WHEN baby_id % 97 <> {i} THEN {c} END" for i, c in enumerate(needed["daily"][1].split(), 1)}
    kept = {c: spoiled.get(c, c) for c in [b.split()[0] for b in bounds]}
    refused = " UNION ALL ".join(
        [
            f"""SELECT '{name}' AS relation, '{c} is null' AS check_name,
            CAST(ifnull(sum({twice.format(key=row_of[part])}) FILTER (WHERE {row_of[part]} % 97 = {i} OR {c} IS NULL), 0)
                 AS BIGINT) AS violations FROM {part}"""
            for part, (name, columns) in needed.items()
            if part in ("rest", "wake", "daily")
            for i, c in enumerate(columns.split(), 1)
        ]
        + [
            """SELECT 'fct_sleep_sessions', 'sleep_id repeats',
            count(*) FILTER (WHERE sleep_id % 89 = 0 AND sleep_id % 97 <> 1) FROM rest""",
            f"""SELECT 'mart_daily_metrics', 'baby_id, metric_date repeats', count(*)
            FROM (SELECT count(*) AS n FROM {copied} GROUP BY {spoiled["baby_id"]}, {spoiled["metric_date"]}) WHERE n > 1""",
        ]
        + [f"SELECT 'mart_daily_metrics', '{b}', count(*) FROM {copied} WHERE {kept[b.split()[0]]} {b.split(' ', 1)[1]}" for b in bounds]
    )
    return {
        "dq_not_null_broken": sql(
            " UNION ALL ".join(
                f"""SELECT '{name}' AS relation, '{c}' AS column_name,
                CAST(ifnull(sum({twice.format(key=row_of[part])}) FILTER (WHERE {row_of[part]} % 97 = {i} OR {c} IS NULL), 0)
                     AS BIGINT) AS violations FROM {part}"""
                for part, (name, columns) in needed.items()
                for i, c in enumerate(columns.split(), 1)
            ),
            *needed,
        ),
        "dq_unique_broken": sql(
            " UNION ALL ".join(
                f"""SELECT '{needed[part][0]}' AS relation, '{c}' AS column_name,
                count(*) FILTER (WHERE {c} % 89 = 0 AND {c} % 97 <> 1) AS violations FROM {part}"""
                for part, c in keys.items()
            ),
            *keys,
        ),
        "dq_accepted_values_broken": sql(
            """SELECT 'stg_feeding_sessions' AS relation, 'feeding_type' AS column_name,
               count(*) FILTER (WHERE feeding_id % 83 = 0) AS violations FROM feed""",
            "feed",
        ),
        "dq_grain_broken": sql(
            """SELECT count(*) AS baby_days, CAST(sum(CASE WHEN baby_id % 29 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS daily_rows,
               count(*) FILTER (WHERE baby_id % 29 = 0) AS violations FROM daily""",
            "daily",
        ),
        "dq_ranges_broken": sql(
            " UNION ALL ".join(f"SELECT '{b}' AS check_name, count(*) AS violations FROM {odd} WHERE {b}" for b in bounds),
            "daily",
        ),
        "dq_range_rows_broken": sql(f"SELECT * FROM {odd} WHERE {' OR '.join(bounds)}", "daily"),
        "build_checks": sql(
            " UNION ALL ".join(
                [
                    f"SELECT '{name}' AS relation, '{c} is null' AS check_name, count(*) - count({c}) AS violations FROM {part}"
                    for part, (name, columns) in needed.items()
                    for c in columns.split()
                ]
                + [
                    f"""SELECT '{needed[part][0]}', '{c} repeats', count(*)
                    FROM (SELECT {c} FROM {part} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"""
                    for part, c in keys.items()
                ]
                + [
                    """SELECT 'stg_feeding_sessions', 'feeding_type is not accepted', count(*)
                    FROM feed WHERE feeding_type NOT IN ('BREAST', 'BOTTLE', 'SOLID')""",
                    """SELECT 'mart_daily_metrics', 'baby_id, metric_date repeats', count(*)
                    FROM (SELECT baby_id, metric_date FROM daily GROUP BY ALL HAVING count(*) > 1)""",
                ]
                + [f"SELECT 'mart_daily_metrics', '{b}', count(*) FROM daily WHERE {b}" for b in bounds]
            ),
            *needed,
        ),
        "publish_refused": sql(
            f"SELECT * FROM ({refused}) WHERE violations > 0",
            *(part for part in needed if part in ("rest", "wake", "daily")),
        ),
        "publish_keeps_old": sql("SELECT * FROM daily", "daily"),
        "mart_refreshed": sql("SELECT * FROM daily", "daily"),
        "dq_not_null": sql(
            " UNION ALL ".join(
                f"SELECT '{name}' AS relation, '{c}' AS column_name, count(*) - count({c}) AS violations FROM {part}"
                for part, (name, columns) in needed.items()
                for c in columns.split()
            ),
            *needed,
        ),
        "dq_unique": sql(
            " UNION ALL ".join(
                f"""SELECT '{needed[part][0]}' AS relation, '{c}' AS column_name, count(*) AS violations
                FROM (SELECT {c} FROM {part} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"""
                for part, c in keys.items()
            ),
            *keys,
        ),
        "dq_accepted_values": sql(
            """SELECT 'stg_feeding_sessions' AS relation, 'feeding_type' AS column_name, count(*) AS violations
            FROM feed WHERE feeding_type NOT IN ('BREAST', 'BOTTLE', 'SOLID')""",
            "feed",
        ),
        "dq_grain": sql(
            """SELECT count(*) AS baby_days, CAST(sum(n) AS BIGINT) AS daily_rows,
               count(*) FILTER (WHERE n > 1) AS violations
            FROM (SELECT count(*) AS n FROM daily GROUP BY baby_id, metric_date)""",
            "daily",
        ),
        "dq_ranges": sql(
            " UNION ALL ".join(
                f"SELECT '{b}' AS check_name, count(*) AS violations FROM daily WHERE {b}" for b in bounds
            ),
            "daily",
        ),
        "dq_range_rows": sql(f"SELECT * FROM daily WHERE {' OR '.join(bounds)}", "daily"),
    }


def _of_day(key: str, *others: str) -> str:
    """Columns of the tally for the days that have the first of them."""
    return sql(f"SELECT {', '.join(('baby_id', 'metric_date', key, *others))} FROM tally WHERE {key} IS NOT NULL", "tally")


def statements() -> dict[str, str]:
    return {
        **_raw(),
        **_ingest(),
        **_loads(),
        "stg_sleep": whole("sleep"),
        "stg_feeding": whole("feed"),
        "stg_diaper": whole("diaper"),
        "fct_sleep_sessions": sql("SELECT * EXCLUDE (clock) FROM rest", "rest"),
        "fct_wake_windows": whole("wake"),
        "sleep_neighbours": sql(
            """SELECT baby_id, start_time, max(end_time) AS end_time,
               (SELECT min(later.start_time) FROM slp later
                WHERE later.baby_id = slp.baby_id AND later.end_time > later.start_time
                  AND later.start_time > slp.start_time) AS next_start
            FROM slp WHERE end_time > start_time GROUP BY ALL""",
            "slp",
        ),
        "event_bounds": whole("life"),
        "date_spine": whole("days"),
        "night_sleep": _of_day("night_sleep_segments", "night_sleep_minutes", "longest_night_stretch_minutes"),
        "night_wakings": _of_day("night_waking_count", "awake_at_night_minutes"),
        "naps": _of_day("nap_count", "total_nap_minutes", "avg_nap_minutes"),
        "feeds": _of_day("feed_count", "breast_feed_count", "bottle_feed_count", "total_volume_ml"),
        "feed_intervals": _of_day("avg_feed_interval_minutes"),
        "daily_wake_windows": _of_day("avg_wake_window_minutes", "max_wake_window_minutes"),
        "nappies": _of_day("diaper_count", "wet_diaper_count", "dirty_diaper_count"),
        "mart_daily_metrics": whole("daily"),
        "mart_from_groups": whole("daily"),
        **_compare(),
        **_quality(),
    }
