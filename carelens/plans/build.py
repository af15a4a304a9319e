"""From export files to published tables, which are checked before they are shown."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens import constants as K
from carelens import schemas
from carelens.operators.ingest import ingest, left_out
from carelens.operators.quality import GRAINS, checked, duplicate_keys, repeated, row_checks
from carelens.operators.sleep import fct_sleep_sessions, fct_wake_windows
from carelens.operators.staging import stage_diapers, stage_feeds, stage_sleeps
from carelens.plans.load import load, tagged_replace, with_total
from carelens.plans.mart import mart_daily_metrics
from carelens.session import remove, scratch_path
from carelens.sources.exports import listed, read_all_exports
from carelens.sources.subjects import only_subject, profiles_from, with_subject_ids
from carelens.sources.tables import create_table, open_tables, raw_relations, table_name


#: Begins the report's rows for exports of subjects that are not registered.
LEFT_OUT = "not registered:"


def namespace(target_schema: str, target_name: str, custom: str | None = None) -> str:
    """The namespace a relation is published in.

    Published tables have a name consumers know, except that builds of the
    ``ci`` target stay below their own prefix and cannot overwrite them.
    """
    if custom is None:
        return target_schema
    custom = custom.strip()
    return f"{target_schema}_{custom}" if target_name == "ci" else custom


def ingest_exports(
    spark: SparkSession,
    folder: str,
    subjects: DataFrame,
    base: str,
    as_of: datetime,
    only: str | None = None,
    aliases: Mapping[str, Mapping[str, str]] | None = None,
    accept_fewer: bool = False,
) -> DataFrame:
    """Read, type and load the exports of all subjects, or of the one called ``only``, and report the rows.

    Rows of subjects that are not registered are not loaded; the report has how many there are per kind of export.
    The files are parsed once, into the shared folder.
    """
    chosen = subjects if only is None else only_subject(subjects, only)
    name = None if only is None else chosen.first().name
    ids = None if only is None else with_subject_ids(chosen)
    exports = read_all_exports(spark, folder, aliases, only=name)
    return _loaded(spark, exports, chosen, base, as_of, ids, accept_fewer)


#: The stored relation of export files that have been loaded.
CATALOGUE = "export_files"
CATALOGUE_COLUMNS = schemas.columns("id STRING, kind STRING, subject STRING, modified TIMESTAMP_NTZ, loaded BOOLEAN").add("size", "long")


def ingest_changed(
    spark: SparkSession,
    folder: str,
    subjects: DataFrame,
    base: str,
    as_of: datetime,
    aliases: Mapping[str, Mapping[str, str]] | None = None,
    accept_fewer: bool = False,
) -> DataFrame:
    """Load the exports of subjects any of whose files are new, changed or gone since the last such load; report the rows.

    One listing is compared with the catalogue of files loaded before, by size and time. Subjects whose files are as they
    were are left alone, and if all are, no line is read. A subject's files are loaded together, and so are those of one
    who has been registered since. A file that is gone takes its rows along, so that is refused unless ``accept_fewer``.
    The catalogue follows when the load is done.
    """
    name, tag = table_name(base, CATALOGUE), hashlib.md5(folder.rstrip("/").encode()).hexdigest()
    create_table(spark, name, schemas.with_source(CATALOGUE_COLUMNS))
    registered = with_subject_ids(subjects).select(F.col("name").alias("subject"), F.lit(True).alias("loaded"))
    files = listed(spark, folder, aliases).join(registered, "subject", "left")
    files = files.withColumn("loaded", F.coalesce("loaded", F.lit(False)))
    path = scratch_path(spark, "export-listing")

    def kept(rows: DataFrame, label: str) -> DataFrame:
        """Written down, as each is a small relation that many jobs read."""
        rows.write.parquet(f"{path}/{label}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{label}")

    try:
        files = kept(files, "files")
        before = spark.table(name).where(F.col("source") == tag).select(*files.columns)
        changed = files.exceptAll(before).unionByName(before.exceptAll(files)).select("subject").distinct()
        changed = kept(changed, "changed")
        touched = files.join(changed, "subject", "left_semi").where("loaded")
        # As many paths as files changed; a first load reads the whole folder instead.
        paths = None if before.isEmpty() else [r.id for r in touched.select("id").collect()]
        chosen = kept(subjects.join(changed, subjects["name"] == changed["subject"], "left_semi"), "chosen")
        if chosen.isEmpty():
            report = with_total(spark.createDataFrame([(t, 0) for t in schemas.LOADED_TABLES], "table_name string, rows bigint"))
        else:
            exports = read_all_exports(spark, folder, aliases, files=paths)
            report = _loaded(spark, exports, chosen, base, as_of, with_subject_ids(chosen), accept_fewer)
        if not changed.isEmpty():
            tagged_replace(files.select(*CATALOGUE_COLUMNS.fieldNames()), name, tag)
    finally:
        remove(spark, path)
    return report


def _loaded(
    spark: SparkSession,
    texts: dict[str, DataFrame],
    chosen: DataFrame,
    base: str,
    as_of: datetime,
    ids: DataFrame | None,
    accept_fewer: bool,
) -> DataFrame:
    """Parse exports into the shared folder once, type and load them."""
    exports, parsed = {}, []
    for kind, rows in texts.items():
        path = scratch_path(spark, f"export-{kind}")
        parsed.append(path)
        rows.write.parquet(path)
        exports[kind] = spark.read.schema(rows.schema).parquet(path)
    try:
        # One job counts for all kinds.
        unknown = (left_out(rows, chosen).select(F.lit(kind).alias("kind")) for kind, rows in exports.items())
        left = {r.kind: r["count"] for r in reduce(DataFrame.unionByName, unknown).groupBy("kind").count().collect()}
        report = load(spark, base, profiles_from(chosen, as_of), ingest(exports, chosen), ids, accept_fewer)
    finally:
        for path in parsed:
            remove(spark, path)
    return report.unionByName(spark.createDataFrame([(f"{LEFT_OUT} {kind}", left[kind]) for kind in texts if kind in left], report.schema))


def relations(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every modelled relation by its published name, lazily."""
    profiles, sleeps = raw["baby_profiles"], raw["sleep_sessions"]
    feeds, diapers = raw["feeding_sessions"], raw["diaper_events"]
    return {
        **{f"raw_{name}": rows for name, rows in raw.items()},
        "stg_sleep_sessions": stage_sleeps(sleeps, profiles),
        "stg_feeding_sessions": stage_feeds(feeds, profiles),
        "stg_diaper_events": stage_diapers(diapers, profiles),
        "fct_sleep_sessions": fct_sleep_sessions(sleeps, profiles),
        "fct_wake_windows": fct_wake_windows(sleeps, profiles),
        "mart_daily_metrics": mart_daily_metrics(profiles, sleeps, feeds, diapers),
    }


#: Relations that are checked but not written.
STAGED = ("stg_sleep_sessions", "stg_feeding_sessions", "stg_diaper_events")
#: Published relations and the order of their rows, by which consumers' filters skip files and row groups. The time
#: after the subject lets a subject with many rows spread over files.
PUBLISHED = {
    "fct_sleep_sessions": ("baby_id", "start_time"),
    "fct_wake_windows": ("baby_id", "wake_start"),
    "mart_daily_metrics": ("baby_id", "metric_date"),
}


class ChecksFailed(ValueError):
    """A build whose rows break checks; ``violations`` has relation, check and number of each."""

    def __init__(self, violations: list[tuple[str, str, int]]) -> None:
        super().__init__("; ".join(f"{relation}: {check} ({number})" for relation, check, number in violations))
        self.violations = violations


@dataclass
class Version:
    """A written version of a published relation that no view shows yet, and what its checks found."""

    spark: SparkSession
    database: str
    name: str
    table: str
    found: list[tuple[str, str, int]]

    def turn(self) -> None:
        """Show it. The version before stays until the next one, for readers still at it."""
        spark, database = self.spark, self.database
        known = [t for t in spark.catalog.listTables(f"`{database}`") if not t.isTemporary]
        if any(t.name == self.name and t.tableType != "VIEW" for t in known):
            spark.sql(f"DROP TABLE `{database}`.`{self.name}`")  # published by an earlier release of this package
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{self.name}` AS SELECT * FROM `{database}`.`{self.table}`")
        versions = sorted(t.name for t in known if t.name.startswith(f"{self.name}__"))
        for old in [v for v in versions if v != self.table][:-1]:
            spark.sql(f"DROP TABLE `{database}`.`{old}`")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{self.table}`")


def in_order(rows: DataFrame, order: tuple[str, ...], grain: tuple[str, ...] | None) -> DataFrame:
    """The rows as they are published; with a grain, ``__nth`` numbers the rows of a key. That takes no exchange or sort more."""
    placed = rows.repartitionByRange(*order)
    if grain:
        placed = placed.withColumn("__nth", F.row_number().over(W.partitionBy(*grain).orderBy(*order)))
    return placed.sortWithinPartitions(*order)


def write_version(rows: DataFrame, database: str, name: str, order: tuple[str, ...], relation: str | None = None) -> Version:
    """Write the rows as a table of their own, and count what breaks the checks on ``relation`` while they are written.

    Rows with the same key stand together where they are written, so repeats of a grain are counted there too. Only keys
    that rows are not ordered by are read again, that one column of what was written.
    """
    spark = rows.sparkSession
    table = f"{name}__{datetime.now():%Y%m%d%H%M%S%f}"
    checks, seen, grain = row_checks(relation or ""), Observation(), GRAINS.get(relation or "")
    written = in_order(rows, order, grain)
    if grain:
        checks[repeated(grain)] = F.col("__nth") == 2
    if checks:
        written = written.observe(seen, *(F.count_if(check).alias(check_name) for check_name, check in checks.items()))
    written.drop("__nth").write.format("parquet").saveAsTable(f"`{database}`.`{table}`")
    found = [(relation, check, number) for check, number in seen.get.items()] if checks else []
    key = K.UNIQUE_COLUMNS.get(relation or "")
    if key:
        again = duplicate_keys(spark.table(f"`{database}`.`{table}`"), key).count()
        found.append((relation, repeated((key,)), again))
    return Version(spark, database, name, table, found)


def judge(versions: list[Version], others: list[tuple[str, str, int]] = (), tolerated: Iterable[str] = ()) -> None:
    """Drop all versions and fail if a check that is not tolerated found something in any of them, or in ``others``."""
    found = [*others, *(row for version in versions for row in version.found)]
    broken = [row for row in found if row[2] and row[1] not in set(tolerated)]
    if broken:
        for version in versions:
            version.drop()
        raise ChecksFailed(broken)


def publish(
    rows: DataFrame, database: str, name: str, order: tuple[str, ...], relation: str | None = None, tolerated: Iterable[str] = ()
) -> None:
    """Make the rows what ``database.name`` shows, if they pass the checks on ``relation``.

    They are written as a table of their own and a view is turned to it when that is complete and sound, so readers always
    find the old rows or the new ones.
    """
    version = write_version(rows, database, name, order, relation)
    judge([version], tolerated=tolerated)
    version.turn()


def build(
    spark: SparkSession,
    base: str,
    target_schema: str = "default",
    target_name: str = "local",
    location: str | None = None,
    tolerated: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Register raw and staging relations as views and publish facts and marts; missing tables raise.

    The mart comes from the source tables directly: reading a written fact
    back would cost more than the aggregates it replaces. ``location`` is where a new database keeps its tables.

    Staged relations are checked in a pass each, facts and marts while they are written. If any check finds something, no view
    turns, and ``ChecksFailed`` says what it was; checks named in ``tolerated`` may find something. What all found is
    ``data_checks`` of the result.
    """
    built = relations(raw_relations(open_tables(spark, base)))
    database = namespace(target_schema, target_name, "marts")
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    staged = reduce(DataFrame.unionByName, (checked(built[name], name) for name in STAGED)).collect()
    found = [(r.relation, r.check_name, r.violations) for r in staged]
    versions = [write_version(built[name], database, name, order, name) for name, order in PUBLISHED.items()]
    judge(versions, found, tolerated)
    for version in versions:
        version.turn()
    for name, rows in built.items():
        if name in PUBLISHED:
            built[name] = spark.table(f"`{database}`.`{name}`")
        else:
            rows.createOrReplaceTempView(name)
    found += [row for version in versions for row in version.found]
    built["data_checks"] = spark.createDataFrame(found, "relation string, check_name string, violations long")
    return built
