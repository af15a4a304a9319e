"""Exact dedup with an extendible-hash index on shared files.

The index is a directory of 2 ** depth slots, named by the first bits of a text's 64-bit hash, and buckets that one or more
slots point to. A bucket is a folder of Parquet files with the different texts of its key range. When a batch would
make a bucket larger than ``bucket_bytes``, the bucket is split by one more bit of the hash until its parts fit, and the
directory doubles whenever a bucket uses more bits than it has. A bucket of one hash value is not split any more: its
texts form a chain.

A batch is read twice. First the names of its texts (hash and SHA-256) and their sizes are written, a short row per
document, which tell what must be split. Then texts travel once to owner tasks, each with a range of keys, equal ones that
a task meets sent as one row, and so again in a tree of merges where very many tasks send the same text. An owner goes
through its range in the order of hashes, follows the chain of each and compares bytes: equal bytes are one entry, others
the next entry of the chain. Of the entries that the index has already, only those whose hash comes again take part.
Every entry's new rows are appended to its tallies, so nothing but split buckets is ever rewritten. The directory is
written last; what a lost job leaves behind is not pointed to.

A row of a document knows its entry by hash and SHA-256. If two different texts ever shared both, an owner would see it
from their bytes, and the job fails rather than join them.

Defined cases. A null text counts as empty. Of equal texts the largest doc_id stays, any other before a null one; of rows
that repeat the same doc_id and text one stays. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.arrow_text import slices
from carelens.llm.store import shuffle_partitions, stored
from carelens.session import remove, scratch_path

#: Slots the directory has at most, as powers of two: what is sent to the tasks is bounded, larger tables get larger buckets.
MOST_DEPTH = 20
#: A bucket holds as much text as Spark's advisory size of a partition, at least this.
LEAST_BUCKET_BYTES = 1 << 20
#: Text that a task holds to join equal ones before it sends them, and rows of one text that an owner takes.
COMBINED_BYTES, FAN_IN = 64 << 20, 256
#: Text in one Arrow batch.
PART_BYTES = 4 << 20

ARRIVALS = "bucket int, owner int, hash long, sha256 string, entry int, text string, n_docs long"
ENTRIES = "hash long, entry int, sha256 string, text string, bucket string"
TALLIES = "hash long, entry int, sha256 string, n_docs long"


def key_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def names(docs: DataFrame, hashed: Column | None = None) -> DataFrame:
    """A short row per document: doc_id, hash, sha256 and size of its text, and a number of its own."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (key_hash() if hashed is None else hashed).alias("hash"),
        F.sha2(text, 256).alias("sha256"),
        F.octet_length(text).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )


@dataclass
class Directory:
    """Buckets by the bits they share: how many, and which; and the bytes of text in each."""

    depth: int = 0
    buckets: dict[tuple[int, int], int] = field(default_factory=lambda: {(0, 0): 0})

    def grow(self, depth: int, sizes: dict[int, int], bucket_bytes: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """Take in bytes per prefix of ``depth`` bits; returns the buckets that were split and what became of each."""
        split: dict[tuple[int, int], list[tuple[int, int]]] = {}
        grown: dict[tuple[int, int], int] = {}
        most = max(depth, self.depth)
        places, amounts = np.array(sorted(sizes), np.int64), np.array([sizes[x] for x in sorted(sizes)], np.int64)
        running = np.append(0, np.cumsum(amounts))

        def new_bytes(bits: int, prefix: int) -> int:
            shift = depth - bits
            low, high = np.searchsorted(places, [prefix << shift, (prefix + 1) << shift])
            return int(running[high] - running[low])

        for (bits, prefix), held in self.buckets.items():
            open_ = [(bits, prefix, held)]
            while open_:
                b, p, old = open_.pop()
                total = old + (new_bytes(b, p) if b <= depth else 0)
                if total <= bucket_bytes or b >= most:
                    grown[b, p] = total
                    if (b, p) != (bits, prefix):
                        split.setdefault((bits, prefix), []).append((b, p))
                else:  # what it held is taken to spread evenly; the hash sees to that
                    open_ += [(b + 1, 2 * p, old // 2), (b + 1, 2 * p + 1, old - old // 2)]
                    self.depth = max(self.depth, b + 1)
        self.buckets = dict(sorted(grown.items(), key=lambda x: x[0][1] << (63 - x[0][0])))
        return split

    def slots(self) -> np.ndarray:
        """The number of the bucket that each slot points to; buckets are numbered in the order of their keys."""
        out = np.zeros(1 << self.depth, np.int32)
        for number, (bits, prefix) in enumerate(self.buckets):
            shift = self.depth - bits
            out[prefix << shift : (prefix + 1) << shift] = number
        return out

    def labels(self) -> list[str]:
        return [label(bits, prefix) for bits, prefix in self.buckets]


def label(bits: int, prefix: int) -> str:
    """A bucket's name: its bits after a letter."""
    return "k" + (format(prefix, f"0{bits}b") if bits else "")


def first_bits(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits).cast("long") if bits else F.lit(0).cast("long")


def _bucket_numbers(hashes: np.ndarray, slots: np.ndarray) -> np.ndarray:
    depth = len(slots).bit_length() - 1
    return slots[(hashes.view(np.uint64) >> np.uint64(64 - depth)).astype(np.int64)] if depth else np.zeros(len(hashes), np.int32)


def _combined(slots, owners: int, buckets: int, most_bytes: int):
    """Rows (hash, sha256, text) as arrivals; equal texts that a task holds at the same time are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for begin in range(0, len(texts := list(held)), 1024):
                part = texts[begin : begin + 1024]
                own = [held[x] for x in part]
                hashes = np.array([x[0] for x in own], np.int64)
                bucket = _bucket_numbers(hashes, slots.value)
                owner = (bucket.astype(np.int64) * owners // buckets).astype(np.int32)
                columns = [pa.array(bucket), pa.array(owner), pa.array(hashes), pa.array([x[1] for x in own], pa.string())]
                columns += [pa.nulls(len(part), pa.int32()), pa.array(part, pa.string()), pa.array([x[2] for x in own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "owner", "hash", "sha256", "entry", "text", "n_docs"])

        for batch in batches:
            for part in slices(iter([batch]), "text", PART_BYTES):
                columns = (part.column(c).to_pylist() for c in ("text", "hash", "sha256"))
                for text, hashed, digest in zip(*columns, strict=True):
                    known = held.get(text)  # by its characters, not by its hash
                    if known is None:
                        held[text] = [hashed, digest, 1]
                        size += len(text) + 200
                    else:
                        known[2] += 1
                if size >= most_bytes:
                    yield from rows()
                    held, size = {}, 0
        yield from rows()

    return run


def _placed(slots, owners: int, buckets: int):
    """Known entries as arrivals that add no document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = _bucket_numbers(batch.column("hash").to_numpy(), slots.value)
            owner = (bucket.astype(np.int64) * owners // buckets).astype(np.int32)
            columns = [pa.array(bucket), pa.array(owner), *(batch.column(c) for c in ("hash", "sha256", "entry", "text"))]
            columns.append(pa.array(np.zeros(batch.num_rows, np.int64)))
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "owner", "hash", "sha256", "entry", "text", "n_docs"])

    return run


def _owned(labels):
    """What arrives for a range of keys, in the order of hashes, as entries of its chains; known entries come first.

    An entry that is new comes out with its text, one the index has already without.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chained(batches, labels.value)

    return run


def _chained(batches: Iterator[pa.RecordBatch], labels: list[str]) -> Iterator[pa.RecordBatch]:
    at, chain = None, []
    out: list[tuple] = []
    size = 0

    def close() -> None:
        nonlocal size
        if len({x["sha256"] for x in chain}) < len(chain):
            raise ValueError("two different texts have the same hash and SHA-256")
        for number, x in enumerate(chain):
            if x["n_docs"]:
                out.append((labels[x["bucket"]], at, number, x["sha256"], None if x["known"] else x["text"], x["n_docs"]))
                size += 100 + (0 if x["known"] else len(x["text"]))

    def batch_of() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64())
        columns = zip(*out, strict=True) if out else [()] * len(kinds)
        arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["bucket", "hash", "entry", "sha256", "text", "n_docs"])

    for batch in batches:
        for part in slices(iter([batch]), "text", PART_BYTES):
            for row in part.to_pylist():
                if row["hash"] != at:
                    if chain:
                        close()
                    at, chain = row["hash"], []
                    if size >= PART_BYTES:
                        yield batch_of()
                        out, size = [], 0
                equal = next((x for x in chain if x["text"] == row["text"]), None)
                if row["entry"] is not None:
                    if row["entry"] != len(chain):
                        raise ValueError("the entries of a chain are not complete")
                    chain.append(row | {"known": True, "n_docs": 0})
                elif equal is None:
                    chain.append(row | {"known": False})
                else:
                    equal["n_docs"] += row["n_docs"]
    if chain:
        close()
    yield batch_of()


class TextIndex:
    """The index and its files below one folder of the shared store."""

    def __init__(self, spark: SparkSession, bucket_bytes: int | None = None, fan_in: int = FAN_IN, hashed: Column | None = None) -> None:
        """``hashed`` is the hash of column ``text`` in 64 bits, xxHash64 if not given."""
        self.spark, self.fan_in, self.hashed = spark, fan_in, hashed
        advised = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
            spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        )
        self.bucket_bytes = bucket_bytes or max(LEAST_BUCKET_BYTES, advised)
        self.directory = Directory()
        self.folder = scratch_path(spark, "text-index")
        #: Folders of entries by bucket, and of tallies; several batches may have added to a bucket.
        self.files: dict[str, list[str]] = {}
        self.tallies: list[str] = []

    def add(self, docs: DataFrame) -> DataFrame:
        """Take in the documents; returns their names (doc_id, hash, sha256, size, row)."""
        named = stored(names(docs, self.hashed), "text-names")
        replaced = self._make_room(named)
        slots = self.spark.sparkContext.broadcast(self.directory.slots())
        buckets = len(self.directory.buckets)
        owners = min(buckets, shuffle_partitions(self.spark))
        # A third of all documents may be one text: it is one row a task, and merged until few tasks send it.
        text = F.coalesce("text", F.lit(""))
        source = docs.select((key_hash() if self.hashed is None else self.hashed).alias("hash"), F.sha2(text, 256).alias("sha256"), text.alias("text"))
        arriving = self._merged(source.mapInArrow(_combined(slots, owners, buckets, COMBINED_BYTES), ARRIVALS), named)
        known = self._known(named)
        if known is not None:
            arriving = arriving.unionByName(known.mapInArrow(_placed(slots, owners, buckets), ARRIVALS))
        # Each owner task has a range of buckets and so of keys; known entries of a hash come before what arrives.
        owned = arriving.repartitionById(owners, F.col("owner")).drop("owner")
        owned = owned.sortWithinPartitions("hash", F.col("entry").asc_nulls_last())
        labels = self.spark.sparkContext.broadcast(self.directory.labels())
        found = owned.mapInArrow(_owned(labels), "bucket string, hash long, entry int, sha256 string, text string, n_docs long")
        path = f"{self.folder}/added-{uuid.uuid4().hex}"
        found.withColumn("fresh", F.col("text").isNotNull()).write.partitionBy("bucket").parquet(path)
        self.tallies.append(path)
        for name in self._buckets_in(path):
            self.files.setdefault(name, []).append(path)
        self._commit(replaced)
        return named

    def entries(self) -> DataFrame:
        """hash, entry (its place in the chain), sha256 and text of all different texts, with their bucket."""
        parts = [self._read(path, [x for x in self.files if path in self.files[x]]) for path in sorted({p for x in self.files.values() for p in x})]
        frame = self.spark.createDataFrame([], ENTRIES)
        for part in parts:
            frame = frame.unionByName(part)
        return frame

    def tally(self) -> DataFrame:
        """hash, entry, sha256 and n_docs of every entry."""
        rows = self.spark.createDataFrame([], TALLIES)
        for path in self.tallies:
            rows = rows.unionByName(self.spark.read.schema(TALLIES).parquet(path).select(rows.columns))
        return rows.groupBy("hash", "entry", "sha256").agg(F.sum("n_docs").alias("n_docs"))

    def _read(self, path: str, buckets: list[str]) -> DataFrame:
        rows = self.spark.read.schema(f"{ENTRIES}, fresh boolean").parquet(path)
        return rows.where(F.col("bucket").isin(buckets) & F.col("fresh")).drop("fresh")

    def _buckets_in(self, path: str) -> list[str]:
        """Buckets that a folder has rows of; partition names are read only."""
        return [r.bucket for r in self.spark.read.schema(ENTRIES).parquet(path).select("bucket").distinct().collect()]

    def _make_room(self, named: DataFrame) -> list[str]:
        """Double the directory and split buckets for the texts to come; returns folders that are not needed any more."""
        fresh = named.groupBy("hash").agg(F.max("size").alias("size"))
        if self.files:
            fresh = fresh.join(self.entries().select("hash"), "hash", "left_anti")
        fresh = stored(fresh, "text-sizes")
        total = (fresh.agg(F.sum("size")).first()[0] or 0) + sum(self.directory.buckets.values())
        bucket_bytes = max(self.bucket_bytes, total >> (MOST_DEPTH - 2))
        depth = min(MOST_DEPTH, max(self.directory.depth, int(total // bucket_bytes).bit_length() + 2))
        prefix = first_bits(F.col("hash"), depth).alias("prefix")
        sizes = {r.prefix: r.size for r in fresh.groupBy(prefix).agg(F.sum("size").alias("size")).collect()}  # a slot each
        split = self.directory.grow(depth, sizes, bucket_bytes)
        return self._split({label(*old): [label(*x) for x in parts] for old, parts in split.items()})

    def _split(self, split: dict[str, list[str]]) -> list[str]:
        """Write the entries of split buckets to the buckets that they now belong to."""
        old = [name for name in split if name in self.files]
        if not old:
            return []
        slots = self.spark.sparkContext.broadcast(self.directory.slots())
        labels = self.directory.labels()

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bucket = _bucket_numbers(batch.column("hash").to_numpy(), slots.value)
                names_ = pa.array(labels).take(pa.array(bucket))
                columns = [batch.column(c) for c in ("hash", "entry", "sha256", "text")]
                yield pa.RecordBatch.from_arrays([*columns, names_], ["hash", "entry", "sha256", "text", "bucket"])

        rows = self.entries().where(F.col("bucket").isin(old)).mapInArrow(moved, ENTRIES)
        path = f"{self.folder}/split-{uuid.uuid4().hex}"
        rows.withColumn("fresh", F.lit(True)).write.partitionBy("bucket").parquet(path)
        left = {}
        for name in old:
            for folder in self.files.pop(name):
                left.setdefault(folder, []).append(name)
        for folder, buckets in left.items():  # a folder that a batch wrote has tallies too, which go on counting
            if folder in self.tallies:
                counts = self.spark.read.schema(f"{TALLIES}, bucket string").parquet(folder).where(F.col("bucket").isin(buckets))
                self.tallies.append(f"{self.folder}/tally-{uuid.uuid4().hex}")
                counts.drop("bucket").write.parquet(self.tallies[-1])
        for name in self._buckets_in(path):
            self.files.setdefault(name, []).append(path)
        return [f"{folder}/bucket={name}" for folder, buckets in left.items() for name in buckets]

    def _commit(self, replaced: list[str]) -> None:
        """Write the directory as a new version, then remove what no directory points to."""
        rows = [(bits, prefix, size, self.files.get(label(bits, prefix), [])) for (bits, prefix), size in self.directory.buckets.items()]
        kinds = "bits int, prefix long, bytes long, folders array<string>"
        self.spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{self.folder}/directory-{len(self.tallies)}")
        for path in replaced:
            remove(self.spark, path)

    def _known(self, named: DataFrame) -> DataFrame | None:
        """Entries whose hash is among the new names."""
        if not self.files:
            return None
        entries = self.entries()
        again = stored(entries.select("hash").distinct().join(named.select("hash").distinct(), "hash"), "text-known")
        return entries.join(again, "hash", "left_semi")

    def _merged(self, arriving: DataFrame, named: DataFrame) -> DataFrame:
        """Arrivals with at most about ``fan_in`` rows of any text that very many documents have."""
        hot = named.groupBy("hash").count().where(F.col("count") > self.fan_in * self.fan_in)
        most = hot.agg(F.max("count")).first()[0]
        if most is None:
            return arriving
        hot = hot.select("hash")
        crowded = arriving.join(hot, "hash", "left_semi").select(*arriving.columns)
        rest = arriving.join(hot, "hash", "left_anti").select(*arriving.columns)
        ways = -(-shuffle_partitions(self.spark) // self.fan_in) * self.fan_in
        key = [c for c in arriving.columns if c != "n_docs"]
        dealt = crowded.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(ways)))
        few = dealt.groupBy(*key, "way").agg(F.sum("n_docs").alias("n_docs")).drop("way")
        return rest.unionByName(few.select(*arriving.columns))


def exact_copies(docs: DataFrame, batches: int = 1, **parameters) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document.

    ``batches`` is how many parts are added to the index one after another; other parameters as of :class:`TextIndex`.
    """
    index = TextIndex(docs.sparkSession, **parameters)
    if batches == 1:
        named = index.add(docs)
    else:
        part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
        parts = [index.add(docs.where(part == number)).withColumn("part", F.lit(number)) for number in range(batches)]
        named = parts[0]
        for more in parts[1:]:
            named = named.unionByName(more)
        # Numbers of rows are those of a batch.
        named = named.withColumn("row", F.col("row") * batches + F.col("part"))
    return judged(named, index.tally())


def judged(named: DataFrame, tally: DataFrame) -> DataFrame:
    """The verdict on every named row, from the sizes of its text's entry."""
    # The first of the rows with the largest id; the index has told which texts are equal.
    last = F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).alias("last")
    kept = named.groupBy("hash", "sha256").agg(last)
    groups = stored(kept.join(tally, ["hash", "sha256"]), "text-groups")
    rows = named.join(groups.select("hash", "sha256", "last", F.col("n_docs").alias("group_size")), ["hash", "sha256"])
    return rows.select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("last.row")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )

