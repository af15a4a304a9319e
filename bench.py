"""Time the headline queries; prints one JSON line.

Every number is the median of three warm runs. The mart is written out in
full, other queries are evaluated completely without keeping the result.
``BENCH_COPIES`` runs everything on the events taken that many times over, each copy with subjects of its own;
``plan`` has the time it takes to plan a query, which is part of its time.
"""

from __future__ import annotations

import importlib
import json
import os
import statistics
import sys
import time
from functools import cached_property
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from carelens import constants as K  # noqa: E402
from carelens import schemas  # noqa: E402
from carelens.operators import compare, daily, quality, sleep, staging  # noqa: E402
from carelens.operators.ingest import ingest  # noqa: E402
from carelens.plans import load as loading  # noqa: E402
from carelens.plans.build import build  # noqa: E402
from carelens.plans.mart import mart_daily_metrics  # noqa: E402
from carelens.session import local_session, remove, scratch_path  # noqa: E402
from carelens.sources.exports import read_all_exports  # noqa: E402
from carelens.sources.fixtures import Fixture  # noqa: E402
from carelens.sources.tables import create_table, table_name  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))


class Multiplied(Fixture):
    """The fixture with its events and customers several times over."""

    def table(self, name: str) -> DataFrame:
        rows = super().table(name)
        if COPIES == 1 or name not in ("events", "customer"):
            return rows
        moved = {"user_id": 3_000_000, "event_id": 100_000_000, "c_custkey": 1_000_000}
        many = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        return many.withColumns({c: F.col(c) + F.col("copy") * step for c, step in moved.items() if c in rows.columns}).drop("copy")

    @cached_property
    def mart(self) -> DataFrame:
        return mart_daily_metrics(self.profiles, self.sleeps, self.feeds, self.diapers)

    @property
    def pairs(self) -> DataFrame:
        return self.profiles.select(F.col("id").alias("left_id"), (F.col("id") + 1).alias("right_id"))


QUERIES = {
    "stg_sleep": lambda f: staging.stage_sleeps(f.sleeps, f.profiles),
    "stg_feeding": lambda f: staging.stage_feeds(f.feeds, f.profiles),
    "stg_diaper": lambda f: staging.stage_diapers(f.diapers, f.profiles),
    "fct_sleep_sessions": lambda f: sleep.fct_sleep_sessions(f.sleeps, f.profiles),
    "fct_wake_windows": lambda f: sleep.fct_wake_windows(f.sleeps, f.profiles),
    "date_spine": lambda f: daily.date_spine(f.profiles, f.sleeps, f.feeds, f.diapers),
    "night_sleep": lambda f: daily.night_sleep(f.profiles, f.sleeps),
    "night_wakings": lambda f: daily.night_wakings(f.profiles, f.sleeps),
    "naps": lambda f: daily.naps(f.profiles, f.sleeps),
    "feeds": lambda f: daily.feeds(f.profiles, f.feeds),
    "feed_intervals": lambda f: daily.feed_intervals(f.profiles, f.feeds),
    "nappies": lambda f: daily.nappies(f.profiles, f.diapers),
    "mart_from_groups": lambda f: daily.daily_from_groups(f.profiles, f.sleeps, f.feeds, f.diapers),
    "compare_age_weeks": lambda f: compare.compare(f.mart, f.pairs, "age_weeks"),
    "weekly_summary": lambda f: compare.weekly_overlap(f.mart, f.pairs),
    "dq_unique": lambda f: quality.unique_report(
        {
            "stg_sleep_sessions": staging.stage_sleeps(f.sleeps, f.profiles),
            "stg_feeding_sessions": staging.stage_feeds(f.feeds, f.profiles),
            "stg_diaper_events": staging.stage_diapers(f.diapers, f.profiles),
            "fct_sleep_sessions": sleep.fct_sleep_sessions(f.sleeps, f.profiles),
        }
    ),
}


def median(run) -> float:
    seconds = []
    for _ in range(RUNS + 1):
        begin = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds[1:]), 3)


#: Queries on corpora, where they are installed; each is timed once after a first run.
CORPUS = ("op1_line_dedup", "op11_lexical_search", "op12_exact_dedup", "op13_whitening")


def planned(frame: DataFrame) -> float:
    begin = time.perf_counter()
    frame._jdf.queryExecution().executedPlan()
    return round(time.perf_counter() - begin, 3)


def write_exports(fixture: Fixture, folder: str) -> None:
    """Files as a tracker app exports them, one per subject and kind in one folder; not part of what is timed."""
    spark, parts = fixture.spark, f"{folder}-parts"
    for kind in K.EXPORT_KINDS:
        rows = fixture.export_rows(kind).drop("event_id")
        named = rows.withColumn("file", F.concat(F.col("subject"), F.lit(f"_{kind}.csv"))).drop("subject")
        named.repartition("file").write.mode("append").partitionBy("file").option("header", True).csv(parts)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    for found in store.globStatus(path(f"{parts}/file=*/*.csv")):
        name = found.getPath().getParent().getName().removeprefix("file=")
        store.rename(found.getPath(), path(f"{folder}/{name}"))
    remove(spark, parts)


def main() -> None:
    spark = local_session("bench", cores=CPUS, shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    entry = importlib.import_module("__spark_entry__")  # it must import wherever this runs
    fixture = Multiplied(spark, SF_DIR)
    seconds, plans, scratch = {}, {}, []

    def place(label: str) -> str:
        scratch.append(scratch_path(spark, label))
        return scratch[-1]

    mart = place("mart")
    plans["mart_daily_metrics"] = planned(fixture.mart)
    seconds["mart_daily_metrics"] = median(lambda: fixture.mart.write.mode("overwrite").parquet(mart))
    for name, query in QUERIES.items():
        plans[name] = planned(query(fixture))
        seconds[name] = median(lambda query=query: query(fixture).write.format("noop").mode("overwrite").save())

    exports, typed = place("exports"), place("typed")
    write_exports(fixture, exports)

    def csv_ingest() -> None:
        for name, rows in ingest(read_all_exports(spark, exports), fixture.subjects).items():
            rows.write.mode("overwrite").partitionBy("source").parquet(f"{typed}/{name}")

    seconds["csv_ingest"] = median(csv_ingest)

    spark.sql(f"CREATE DATABASE bench_base LOCATION '{place('base')}'")
    table, sleeps = "bench_base.loaded_sleeps", fixture.sleeps.withColumn("source", F.lit(K.APP))
    create_table(spark, table, sleeps.schema)
    loading.append_rows(sleeps, table)
    seconds["tagged_replace"] = median(lambda: loading.tagged_replace(fixture.sleeps, table))

    base = "bench_base"
    loading.create_tables(spark, base)
    for name in schemas.LOADED_TABLES:
        rows = fixture.relations()[name].withColumn("source", F.lit(K.APP))
        kinds = schemas.with_source(schemas.TABLES[name])
        loading.append_rows(rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds)), table_name(base, name))
    marts = place("marts")
    seconds["build"] = median(lambda: build(spark, base, "bench", "ci", marts, quality.check_names()))
    spark.sql("DROP DATABASE bench_marts CASCADE")
    for name in CORPUS if entry.corpus else ():
        for _ in range(2):
            begin = time.perf_counter()
            entry.queries()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
    spark.sql("DROP DATABASE bench_base CASCADE")
    for path in scratch:
        remove(spark, path)

    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "plan": plans,
                      "copies": COPIES, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
