"""Loading typed rows into stored tables, so that running a load twice changes nothing.

Tables are partitioned by the lineage tag ``source``, by ``bucket``, a hash of the subject (of the id in profiles), and by the
load that wrote the rows. Reloading replaces partitions of one tag and leaves rows of every other tag alone; reloading
some subjects or upserting some profiles rewrites their buckets only. A bucket is labelled with how many there are
(``bucket=3-of-16``), so that number belongs to the table and is read back from it.

Every change is prepared first: its rows are written once, as partitions that the table's view does not show, and counted
while they are written. Then it is turned to, or dropped. A load prepares all its tables, refuses to lose rows, and turns
all views only then. A job that dies before leaves partitions that nobody reads and the next change drops.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens import constants as K
from carelens import schemas
from carelens.session import bounded, remove, scratch_path
from carelens.sources.tables import (
    BUCKET,
    WRITTEN,
    Live,
    Shown,
    condition,
    create_table,
    drop_partitions,
    new_load,
    open_tables,
    partitions,
    require_tables,
    rows_name,
    show,
    shown,
    table_name,
)

#: Buckets of a new table. More make reloads of few subjects cheaper and whole loads write more files.
BUCKETS = 16


def create_tables(spark: SparkSession, base: str, location: str | None = None) -> None:
    """Empty tables in the database ``base``, which is made if need be; existing ones are left as they are.

    ``location`` is where a new database keeps its files.
    """
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{base}`{at}")
    for table, schema in schemas.TABLES.items():
        create_table(spark, table_name(base, table), schemas.with_source(schema))


def bucket_label(subject: Column, buckets: int) -> Column:
    number = F.pmod(F.xxhash64(subject), F.lit(buckets)).cast("string")
    return F.concat(number, F.lit(f"-of-{buckets}"))


def _key(columns: list[str]) -> str:
    return "baby_id" if "baby_id" in columns else "id"


def bucket_count(live: Live, default: int | None = None) -> int:
    """How many buckets the table has, told by any label."""
    label = next((bucket for _, bucket in live), None)
    return int(label.rpartition("-")[2]) if label else default or BUCKETS


def _stored(spark: SparkSession, name: str, live: Live) -> DataFrame:
    """The table's rows that count, with their bucket."""
    return spark.table(rows_name(name)).where(condition(live)).drop(WRITTEN)


class Overtaken(RuntimeError):
    """Another load changed the table in the meantime."""


@dataclass
class Change:
    """Rows that are written but not shown yet, and what the table shows with them."""

    spark: SparkSession
    name: str
    load: str
    before: Shown
    live: Live
    #: Rows of the batch, and rows of the same kind that the table had.
    size: int
    held: int = 0
    #: What the view is to remember.
    notes: dict[str, str] | None = None

    def turn(self) -> int:
        """Show them, and drop what was not shown before either. Returns the rows of the batch."""
        if shown(self.spark, self.name).turned != self.before.turned:
            self.drop()
            raise Overtaken(f"{self.name} was changed by another load")
        show(self.spark, self.name, self.live, self.load, self.notes)
        kept = {(*place, load) for live in (self.before.live, self.live) for place, loads in live.items() for load in loads}
        drop_partitions(self.spark, self.name, [x for x in partitions(self.spark, self.name) if x not in kept])
        return self.size

    def drop(self) -> None:
        """Take back what was written."""
        drop_partitions(self.spark, self.name, partitions(self.spark, self.name, self.load))


def _written(rows: DataFrame, name: str, load: str, buckets: int, batch: Column | None = None) -> tuple[int, int, Live]:
    """Write the rows as partitions of a load; how many of them fulfil ``batch``, how many do not, and where they went."""
    spark, seen = rows.sparkSession, Observation()
    placed = rows.withColumns({BUCKET: bucket_label(F.col(_key(rows.columns)), buckets), WRITTEN: F.lit(load)})
    # Rebalancing lets AQE split a bucket that a hot subject makes large and merge small ones. Rows are counted after it,
    # where no task's work is done twice.
    spread = placed.hint("rebalance", F.col("source"), F.col(BUCKET))
    of_batch = F.lit(True) if batch is None else batch
    counted = spread.observe(seen, F.count_if(of_batch).alias("rows"), F.count_if(~of_batch).alias("others"))
    counted.select(spark.table(rows_name(name)).columns).write.insertInto(rows_name(name))
    return seen.get["rows"], seen.get["others"], {(tag, bucket): [load] for tag, bucket, _ in partitions(spark, name, load)}


def append_rows(rows: DataFrame, name: str, buckets: int | None = None) -> int:
    """Add rows to a table and return how many. ``buckets`` counts for a table without rows."""
    before, load = shown(rows.sparkSession, name), new_load()
    size, _, added = _written(rows, name, load, bucket_count(before.live, buckets))
    live = {place: before.live.get(place, []) + added.get(place, []) for place in {**before.live, **added}}
    return Change(rows.sparkSession, name, load, before, live, size).turn()


def prepare_tagged_replace(rows: DataFrame, name: str, tag: str = K.INGESTED) -> Change:
    spark, tagged = rows.sparkSession, rows.withColumn("source", F.lit(tag))
    before, load = shown(spark, name), new_load()
    size, _, added = _written(tagged, name, load, bucket_count(before.live))
    own = {place: loads for place, loads in before.live.items() if place[0] == tag}
    others = {place: loads for place, loads in before.live.items() if place[0] != tag}
    held = _stored(spark, name, own).count() if own else 0
    return Change(spark, name, load, before, others | added, size, held)


def tagged_replace(rows: DataFrame, name: str, tag: str = K.INGESTED) -> int:
    """Replace exactly the rows tagged ``tag`` and return how many were written."""
    return prepare_tagged_replace(rows, name, tag).turn()


def prepare_subject_replace(rows: DataFrame, subjects: DataFrame, name: str, tag: str = K.INGESTED) -> Change:
    spark, tagged = rows.sparkSession, rows.withColumn("source", F.lit(tag))
    before, load = shown(spark, name), new_load()
    buckets = bucket_count(before.live)
    subjects = subjects.select("baby_id").distinct()
    touched = {r[0] for r in subjects.select(bucket_label(F.col("baby_id"), buckets)).distinct().collect()}
    own = {place: loads for place, loads in before.live.items() if place[0] == tag and place[1] in touched}
    old = _stored(spark, name, own)
    kept = old.join(subjects, "baby_id", "left_anti").select(tagged.columns).withColumn("__batch", F.lit(False))
    # A row of any other subject would replace a bucket nobody asked to replace.
    named = tagged.join(subjects, "baby_id", "left_semi").select(tagged.columns).withColumn("__batch", F.lit(True))
    size, carried, added = _written(kept.unionByName(named), name, load, buckets, F.col("__batch"))
    held = old.count() - carried if own else 0
    others = {place: loads for place, loads in before.live.items() if place not in own}
    return Change(spark, name, load, before, others | added, size, held)


def subject_replace(rows: DataFrame, subjects: DataFrame, name: str, tag: str = K.INGESTED) -> int:
    """Replace the rows of some subjects (``baby_id`` of ``subjects``) within one tag.

    Returns how many rows were loaded. Only the subjects' buckets are read and
    rewritten; rows of other subjects in them are carried over.
    """
    return prepare_subject_replace(rows, subjects, name, tag).turn()


def assert_unique(rows: DataFrame, key: str) -> None:
    """A key hit twice by one batch has no single new value."""
    repeated = rows.groupBy(key).count().where("count > 1").select(key).take(5)
    if repeated:
        raise ValueError(f"batch repeats {key}: {[row[0] for row in repeated]}")


def upserted(target: DataFrame, batch: DataFrame, key: str, size: int | None = None) -> DataFrame:
    """Rows of the batch, plus target rows the batch does not name; ``size`` is the batch's, if that is known."""
    return target.join(bounded(batch.select(key), size), key, "left_anti").select(batch.columns).unionByName(batch)


def prepare_upsert(rows: DataFrame, name: str, key: str = "id") -> Change:
    spark, seen = rows.sparkSession, Observation()
    before, load = shown(spark, name), new_load()
    buckets = bucket_count(before.live)
    # The batch is read three times, so it is evaluated into the shared folder first.
    path = scratch_path(spark, "upsert")
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    try:
        batch = spark.read.schema(rows.schema).parquet(path)
        assert_unique(batch, key)
        touched = {r[0] for r in batch.select(bucket_label(F.col(key), buckets)).distinct().collect()}
        own = {place: loads for place, loads in before.live.items() if place[1] in touched}
        kept_and_new = upserted(_stored(spark, name, own).select(rows.columns), batch, key, seen.get["rows"])
        *_, added = _written(kept_and_new, name, load, buckets)
    finally:
        remove(spark, path)
    others = {place: loads for place, loads in before.live.items() if place not in own}
    return Change(spark, name, load, before, others | added, seen.get["rows"])


def upsert(rows: DataFrame, name: str, key: str = "id") -> int:
    """Upsert the rows into a table and return how many they are.

    Only the buckets that the rows' keys fall into are read and rewritten, in all tags, since a key may move.
    """
    return prepare_upsert(rows, name, key).turn()


def count_by_source(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and lineage tag; only the tag column is read."""
    counts = (
        rows.groupBy("source").agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "source", "rows"
        )
        for name, rows in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)


def ingested_rows(rows: DataFrame, tag: str = K.INGESTED) -> int:
    return rows.where(F.col("source") == tag).count()


def with_total(report: DataFrame) -> DataFrame:
    """Rows per table and a grand total, where the table name is NULL."""
    return report.rollup("table_name").agg(F.sum("rows").alias("rows"))


def reload_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts before and after a load, per table and tag.

    Unexpected: rows of another tag than the loaded one moved, or rows of the loaded tag became fewer. A profile
    may change its tag, so of profiles only the total must not fall.
    """
    before = before.withColumnRenamed("rows", "rows_before")
    after = after.withColumnRenamed("rows", "rows_after")
    rows = before.unionByName(after, allowMissingColumns=True)
    counts = rows.groupBy("table_name", "source").agg(
        F.coalesce(F.max("rows_before"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.max("rows_after"), F.lit(0)).alias("rows_after"),
    )
    table = W.partitionBy("table_name")  # a row per tag
    fewer = F.sum("rows_after").over(table) < F.sum("rows_before").over(table)
    lost = F.col("rows_after") < F.col("rows_before")
    moved = F.when(F.col("source") == K.INGESTED, lost).otherwise(F.col("rows_before") != F.col("rows_after"))
    return counts.withColumn("unexpected_change", F.when(F.col("table_name") == "baby_profiles", fewer).otherwise(moved))


class RowsLost(ValueError):
    """A reload that would leave fewer ingested rows than there are."""


def load(
    spark: SparkSession,
    base: str,
    profiles: DataFrame,
    events: dict[str, DataFrame],
    only: DataFrame | None = None,
    accept_fewer: bool = False,
) -> DataFrame:
    """Load one batch and report the rows written per table.

    With ``only`` (a frame with ``baby_id``) the batch speaks for those
    subjects alone and the ingested rows of all others stay. A batch that would leave fewer ingested rows of an event
    table than there are is refused unless ``accept_fewer``, and then no table changes.
    """
    require_tables(spark, base, schemas.LOADED_TABLES)
    changes: dict[str, Change] = {}
    try:
        changes["baby_profiles"] = prepare_upsert(profiles, table_name(base, "baby_profiles"))
        for table in schemas.EVENT_TABLES:
            rows, name = events[table], table_name(base, table)
            changes[table] = prepare_tagged_replace(rows, name) if only is None else prepare_subject_replace(rows, only, name)
        fewer = [f"{t} from {c.held} to {c.size}" for t, c in changes.items() if t in schemas.EVENT_TABLES and c.size < c.held]
        if fewer and not accept_fewer:
            raise RowsLost(f"ingested rows would become fewer: {', '.join(fewer)}; pass accept_fewer if that is right")
    except BaseException:
        for change in changes.values():
            change.drop()
        raise
    written = [(table, change.turn()) for table, change in changes.items()]
    return with_total(spark.createDataFrame(written, "table_name string, rows bigint"))


def stored_counts(spark: SparkSession, base: str) -> DataFrame:
    tables = open_tables(spark, base)
    return count_by_source({name: tables[name] for name in schemas.LOADED_TABLES})
