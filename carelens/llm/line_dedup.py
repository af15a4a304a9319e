"""Lines that many documents share: levelled sorted runs of line hashes.

The index is a set of runs. A run is a table of line keys, bucketed and sorted by key, with one file per bucket; a key
lies in one run only. A new batch is reduced to its distinct keys, written as such a table too, and merge-anti-joined
with one run after the other: keys that no run holds become a run of level 0, holdings of known keys are appended to a
list of repeats. When a level has ``fanout`` runs they are merged by full outer joins into one run of the next level, so
a key is rewritten a logarithmic number of times. As all tables are bucketed and sorted alike, a join of a batch with the
runs, or of two runs, moves and sorts no row (``ordered_buckets``); the batch is shuffled when it is counted. Only with a
``fanout`` above two a merge deals rows again. Files of runs that were merged are deleted.

Defined cases. A null text is one empty line. Rows that share a doc_id are one document; a null doc_id is
one document too, smaller than any other. Repeated rows stay, each with the same lines. An empty table gives
an empty result. Columns besides doc_id and text are carried along unread.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.store import shuffle_partitions, stored
from carelens.session import remove, scratch_path

MIN_KEY_CHARS, MIN_DOCUMENTS = 20, 3
#: Batches a whole table is dealt into, and runs of a level that are merged into one of the next.
BATCHES, FANOUT = 4, 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE_SPACE = " \t\n\x0b\x0c\r"
HASH = ("h1", "h2")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased. ``lower`` suits pure ASCII, and is quicker."""
    bare = F.btrim(line, F.lit(WHITE_SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """One row per keyed line: its document, the row's text hash, its position and 128 bits of its key."""
    lines = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    keys = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    keys = keys.where(F.char_length("key") >= min_chars)
    return keys.select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


#: Lets a scan of a table with one sorted file per bucket say that its rows are sorted.
ORDERED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def ordered_buckets(spark: SparkSession) -> Iterator[None]:
    """Plans made within read the order of bucket files; the session's own setting is put back."""
    before = spark.conf.get(ORDERED_BUCKETS)
    spark.conf.set(ORDERED_BUCKETS, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED_BUCKETS, before)


class LineRuns:
    """The runs and the repeats of all batches added so far, below one folder of the shared store."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.folder, self.name = scratch_path(spark, "line-runs"), f"line_run_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self.repeats: list[DataFrame] = []
        self.written = 0

    def add(self, lines: DataFrame) -> None:
        """Take in a batch of line hashes (doc_id, h1, h2). A document's rows must lie in one batch."""
        holdings = lines.groupBy(*HASH, "doc_id").agg(F.lit(1).alias("one"))
        keys = holdings.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        if self.buckets != shuffle_partitions(self.spark):  # else counting has dealt them already
            keys = keys.repartition(self.buckets, *HASH)
        batch = self._write(keys)
        if any(self.levels):
            with ordered_buckets(self.spark):
                fresh = self._write(self.unknown(batch))
                known = self.spark.table(batch).join(self._keys(fresh), list(HASH), "left_anti")
                self.repeats.append(stored(known, "line-repeats"))
            self._delete(batch)
            batch = fresh
        self.levels[0].append(batch)
        self._compact()

    def unknown(self, batch: str) -> DataFrame:
        """Rows of a table of keys that no run holds."""
        runs = [name for level in reversed(self.levels) for name in level]
        return reduce(lambda rows, run: rows.join(self._keys(run), list(HASH), "left_anti"), runs, self.spark.table(batch))

    def _keys(self, name: str) -> DataFrame:
        return self.spark.table(name).select(*HASH).hint("merge")

    def runs(self) -> DataFrame | None:
        names = [name for level in self.levels for name in level]
        return reduce(DataFrame.unionByName, map(self.spark.table, names)) if names else None

    def shared(self, min_docs: int = MIN_DOCUMENTS) -> DataFrame:
        """Keys held by at least ``min_docs`` documents, and the largest doc_id holding each."""
        parts = [part for part in (self.runs(), *self.repeats) if part is not None]
        held = reduce(DataFrame.unionByName, parts).groupBy(*HASH)
        total = held.agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("keeper"))
        return total.where(F.col("n_docs") >= min_docs)

    def drop(self) -> None:
        """Delete the runs. The repeats stay in the shared folder until that is cleaned."""
        for level in self.levels:
            for name in level:
                self._delete(name)
        self.levels = [[]]

    def _write(self, keys: DataFrame) -> str:
        """A table of keys that are already dealt by bucket, so that each bucket is one file."""
        self.written += 1
        name = f"{self.name}_{self.written}"
        writer = keys.write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        writer.option("path", self._path(name)).saveAsTable(name)
        return name

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _delete(self, name: str) -> None:
        """Drop a table, which is external, and its files."""
        self.spark.sql(f"DROP TABLE {name}")
        remove(self.spark, self._path(name))

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs as one; they share no key."""
        merged = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(*HASH, F.col("n_docs").alias("n"), F.col("last_doc").alias("doc"))
            both = merged.join(other.hint("merge"), list(HASH), "full")
            merged = both.select(
                *HASH, F.coalesce("n_docs", "n").alias("n_docs"), F.coalesce("last_doc", "doc").alias("last_doc")
            )
        return merged

    def _compact(self) -> None:
        for level, names in enumerate(self.levels):
            if len(names) < self.fanout:
                continue
            with ordered_buckets(self.spark):
                merged = self._write(self._merged(names))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            self.levels[level] = []
            for name in names:
                self._delete(name)


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_KEY_CHARS,
    min_docs: int = MIN_DOCUMENTS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """Take shared lines out of every document but the largest doc_id that holds them.

    Returns the columns of ``docs`` with the kept text, and n_lines and n_dropped, which replace columns of
    these names.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    path = scratch_path(spark, "line-hashes")
    hashes = line_hashes(docs, min_chars).withColumn("batch", batch)
    hashes.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashes.schema).parquet(path)

    runs = LineRuns(spark, fanout)
    for number in range(batches):
        runs.add(lines.where(F.col("batch") == number))
    shared = stored(runs.shared(min_docs), "shared-lines")
    runs.drop()

    older = F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper"))
    dropped = lines.join(shared, list(HASH)).where(older)
    positions = dropped.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("__dropped"))
    positions = positions.select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "__dropped"
    )
    split = docs.withColumn("__lines", split_lines(F.col("text"))).withColumn("__own", F.xxhash64("text")).drop("text")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__hash"))
    joined = split.join(positions, same, "left")

    n_lines = F.size("__lines")
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.coalesce("__dropped", F.array().cast("array<int>")))
    kept_lines = F.transform(kept, lambda i: F.get("__lines", i))
    texts = {"text": F.concat_ws("\n", kept_lines)}
    carried = [texts[c].alias(c) if c in texts else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    n_dropped = F.coalesce(F.size("__dropped"), F.lit(0)).cast("long")
    return joined.select(
        *carried,
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("__dropped").isNull(), 0).otherwise(n_dropped).cast("long").alias("n_dropped"),
    )
