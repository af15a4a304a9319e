"""Values other systems rely on.

Everything below is a fixed value: changing one changes ids already stored,
the columns consumers read, or which rows count towards a metric.
"""

# Namespace for name-based subject ids (RFC 9562 version 5).
SUBJECT_NAMESPACE = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"

# Lineage tags of the `source` column.
INGESTED = "ingested"
APP = "app"

# Export kinds; a file is called <subject>_<kind>.csv.
EXPORT_KINDS = ("diaper", "sleep", "nursing", "pump", "expressed")

# Export columns read by name, per kind; those in OPTIONAL may be absent.
EXPORT_COLUMNS = {
    "diaper": ("Time", "Status", "Note"),
    "sleep": ("Time", "Duration (min)", "Note"),
    "nursing": ("Time", "Start side", "Left duration (min)", "Right Duration (min)", "Total (min)", "Note"),
    "pump": ("Time", "Start side", "Left duration (min)", "Right Duration (min)", "Total duration (min)",
             "Total amount (ml)", "Note"),
    "expressed": ("Time", "Amount (ml)", "Note"),
}
REQUIRED_COLUMNS = {
    "diaper": ("Time", "Status"),
    "sleep": ("Time",),
    "nursing": ("Time",),
    "pump": ("Time",),
    "expressed": ("Time",),
}

# strptime directive -> Spark pattern letter(s). Single letters accept one or two digits.
DATETIME_DIRECTIVES = {
    "%d": "d",
    "%m": "M",
    "%y": "yy",
    "%Y": "yyyy",
    "%I": "h",
    "%H": "H",
    "%M": "m",
    "%S": "s",
    "%p": "a",
}
DEFAULT_DATETIME_FORMAT = "%m/%d/%y %I:%M %p"
# Formats of the trackers in use; any other of the directives above works as well, only slower.
USUAL_FORMATS = (DEFAULT_DATETIME_FORMAT, "%d/%m/%y %I:%M %p")
# Two-digit years from this one on belong to the 1900s.
TWO_DIGIT_YEAR_PIVOT = 69

# Profile defaults.
DEFAULT_PROFILE_NOTES = "Migrated from seed data"

# Diaper statuses and derived labels.
URINE_STATUSES = ("Wet", "Mixed")
STOOL_STATUSES = ("Dirty", "Mixed")
URINE_PRESENT, URINE_ABSENT = "MODERATE", "NONE"
STOOL_CONSISTENCY, STOOL_COLOR = "SOFT", "YELLOW"
DIAPER_TYPE = "DISPOSABLE"

# Sleep labels and defaults.
NIGHTTIME, NAP = "NIGHTTIME", "NAP"
SLEEP_LOCATION, WAKE_REASON = "CRIB", "NATURAL"

# Feeding labels.
BREAST, BOTTLE, SOLID = "BREAST", "BOTTLE", "SOLID"
START_SIDES = ("Left", "Right")

# Night rules: hours of day and minutes.
MORNING_HOUR = 7
EVENING_HOUR = 19
EARLY_EVENING_HOUR = 18
LONG_SLEEP_MINUTES = 180

# Wake windows: opening hours (inclusive) and length in minutes (inclusive).
WAKE_FIRST_HOUR, WAKE_LAST_HOUR = 6, 20
WAKE_MIN_MINUTES, WAKE_MAX_MINUTES = 5, 360

# Feed intervals: length in minutes (inclusive).
FEED_GAP_MIN_MINUTES, FEED_GAP_MAX_MINUTES = 1, 720

# Sane daily values: column -> (lowest, highest); None leaves a side open.
DAILY_BOUNDS = {
    "night_sleep_minutes": (0, 1080),
    "total_nap_minutes": (0, 720),
    "nap_count": (None, 15),
    "feed_count": (None, 30),
    "diaper_count": (None, 25),
    "age_days": (0, None),
}

# Columns that must never be NULL, per relation.
NOT_NULL_COLUMNS = {
    "stg_sleep_sessions": ("sleep_id", "baby_id", "start_time", "duration_minutes", "age_days"),
    "stg_feeding_sessions": ("feeding_id", "baby_id", "start_time", "feeding_type", "age_days"),
    "stg_diaper_events": ("diaper_id", "baby_id", "event_time", "age_days"),
    "fct_sleep_sessions": ("sleep_id", "calendar_date", "is_night"),
    "fct_wake_windows": ("baby_id", "wake_window_minutes"),
    "mart_daily_metrics": ("baby_id", "baby_name", "metric_date", "age_days", "age_weeks"),
}

# Columns that identify one row, per relation.
UNIQUE_COLUMNS = {
    "stg_sleep_sessions": "sleep_id",
    "stg_feeding_sessions": "feeding_id",
    "stg_diaper_events": "diaper_id",
    "fct_sleep_sessions": "sleep_id",
}
