"""The daily mart kept up to date: only what loads have touched since the last refresh is computed and written anew.

A subject's rows have the same bucket in every stored table, as it is a hash of the subject, and no metric of a day looks
beyond its subject. So a bucket of the mart depends on that bucket of profiles, sleeps, feeds and diapers and on nothing else,
neighbouring days and the ends of the calendar included. The mart's view notes, per bucket, the loads it was built from; a
bucket is stale when they are not the ones its sources show now. A refresh reads the stale buckets' partitions only, and
turns the view when what it has written passes the checks, as a load does.

Tables with different numbers of buckets don't go together like that; then every refresh is a full one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelens import schemas
from carelens.operators.quality import GRAINS, repeated, row_checks
from carelens.plans.build import ChecksFailed
from carelens.plans.load import BUCKETS, Change, bucket_label
from carelens.plans.mart import mart_daily_metrics
from carelens.sources.tables import (
    BUCKET,
    WRITTEN,
    Live,
    condition,
    create_table,
    new_load,
    partitions,
    require_tables,
    rows_name,
    shown,
    table_name,
)

MART = "mart_daily_metrics"
#: The stored form of the mart, below its published view, and the tag of its partitions.
STORED, TAG = "daily_rows", "built"


@dataclass
class Refreshed:
    """Buckets that were computed, buckets there are, and rows written."""

    stale: set[str]
    buckets: int
    rows: int


def built_from(states: dict[str, Live]) -> dict[str, str]:
    """Per bucket, what its sources show: every load of every table and tag."""
    seen: dict[str, list[str]] = {}
    for table, live in states.items():
        for (tag, bucket), loads in live.items():
            seen.setdefault(bucket, []).append(f"{table}/{tag}/{'+'.join(loads)}")
    return {bucket: ",".join(sorted(parts)) for bucket, parts in seen.items()}


def _source(spark: SparkSession, base: str, table: str, live: Live, buckets: set[str]) -> DataFrame:
    """A source's rows of some buckets; partitions of others are not listed."""
    name = table_name(base, table)
    chosen = {place: loads for place, loads in live.items() if place[1] in buckets}
    return spark.table(rows_name(name)).where(condition(chosen)).select(spark.table(name).columns)


def refresh_mart(spark: SparkSession, base: str, database: str, tolerated: Iterable[str] = ()) -> Refreshed:
    """Bring ``database.mart_daily_metrics`` up to the tables of ``base``; fails like a build if checks find something."""
    require_tables(spark, base, schemas.LOADED_TABLES)
    live = {table: shown(spark, table_name(base, table)).live for table in schemas.LOADED_TABLES}
    now = built_from(live)
    counts = {int(bucket.rpartition("-")[2]) for bucket in now}
    aligned = len(counts) <= 1
    buckets = max(counts, default=BUCKETS)

    def rows_of(stale: set[str]) -> DataFrame:
        sources = {t: _source(spark, base, t, live[t], stale) for t in schemas.LOADED_TABLES}
        return mart_daily_metrics(*(sources[t] for t in ("baby_profiles", "sleep_sessions", "feeding_sessions", "diaper_events")))

    name = table_name(database, STORED)
    if not spark.catalog.tableExists(name):
        create_table(spark, name, StructType([*rows_of(set()).schema.fields]).add("source", "string"))
    before = shown(spark, name)
    built = [bucket for _, bucket in before.live]
    if not aligned:
        now = {f"{n}-of-{buckets}": str(sorted(now.items())) for n in range(buckets)}
    stale = {bucket for bucket in {*now, *before.notes, *built} if now.get(bucket) != before.notes.get(bucket)}
    if stale:
        read = stale if aligned else {bucket for states in live.values() for _, bucket in states}
        change, found = _written(rows_of(read), name, buckets, stale)
        broken = [row for row in found if row[2] and row[1] not in set(tolerated)]
        if broken:
            change.drop()
            raise ChecksFailed(broken)
        change.notes = {bucket: note for bucket, note in now.items()}
        change.turn()
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c != "source")
    if not spark.catalog.tableExists(table_name(database, MART)):
        spark.sql(f"CREATE VIEW {table_name(database, MART)} AS SELECT {columns} FROM {name}")
    return Refreshed(stale, len(now), change.size if stale else 0)


def _written(rows: DataFrame, name: str, buckets: int, stale: set[str]) -> tuple[Change, list[tuple[str, str, int]]]:
    """Write the stale buckets as partitions that nobody sees yet; also what the checks found meanwhile."""
    spark, seen = rows.sparkSession, Observation()
    before, load, grain = shown(spark, name), new_load(), GRAINS[MART]
    labelled = rows.withColumns({"source": F.lit(TAG), BUCKET: bucket_label(F.col("baby_id"), buckets), WRITTEN: F.lit(load)})
    # A bucket is one file in the order consumers ask for; that order also shows repeats.
    placed = labelled.repartition(BUCKET).withColumn(
        "__nth", F.row_number().over(W.partitionBy(BUCKET, *grain).orderBy(BUCKET, *grain))
    )
    checks = row_checks(MART) | {repeated(grain): F.col("__nth") == 2}
    counted = placed.sortWithinPartitions(BUCKET, *grain).observe(
        seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(check).alias(check_name) for check_name, check in checks.items())
    )
    counted.select(spark.table(rows_name(name)).columns).write.insertInto(rows_name(name))
    found = dict(seen.get)
    added = {(tag, bucket): [load] for tag, bucket, _ in partitions(spark, name, load)}
    kept = {place: loads for place, loads in before.live.items() if place[1] not in stale}
    change = Change(spark, name, load, before, kept | added, found.pop("rows"))
    return change, [(MART, check, number) for check, number in found.items()]
