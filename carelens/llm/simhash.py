"""Near duplicates by SimHash, candidates pruned by the pigeonring principle.

A fingerprint of 64 bits is cut into ``max_bits + 2`` segments on a ring. Two fingerprints that differ in at
most ``max_bits`` bits agree wholly in two segments, so a bucket per pair of segments meets every link. Inside a
bucket a pair must first show a chain: from some segment on, the differences of 1, 2, 3, ... consecutive segments
stay within 1, 2, 3, ... times max_bits / segments. Only then the full distance is counted.

Copies are one vertex from the start: everything works on distinct fingerprints. A bucket with more than
``BUCKET`` of them is not compared pair by pair: its free bits are cut into segments again, and again two of them
must agree; each time the free bits shrink, until a bucket can hold a few hundred distinct fingerprints at most.
So no bucket grows with the data, and no link is lost. A bucket returns a spanning forest, never its pairs.

Defined cases. Null and empty texts have fingerprint zero and are linked like any other. Rows that share a doc_id
are kept as they are; their component holds all their fingerprints' documents. A null doc_id never names a component
unless it has no other document. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.components import components
from carelens.llm.store import shuffle_partitions, stored

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
#: Distinct fingerprints of a bucket that are compared in one task; larger ones are refined.
BUCKET = 1024
#: Hashes whose bits are counted at once.
PART = 1 << 16
#: A bucket with so few free bits has at most 2 ** SMALL members and is never refined.
SMALL = 10


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle_words)), strict=False)]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(x, SEED) for x in shingles], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as an unsigned number; zero of none."""
    count = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), PART):
        part = hashes[begin : begin + PART].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(x.as_py(), shingle_words) for x in batch.column("text")), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"]
            )

    source = docs.select("doc_id", "text")
    doc_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(of, f"doc_id {doc_type}, fingerprint long")


def segments(free_bits: tuple[int, ...], count: int) -> list[tuple[int, ...]]:
    """The free bits cut into ``count`` runs of nearly equal length."""
    return [tuple(int(b) for b in part) for part in np.array_split(np.array(free_bits, int), count)]


def mask_of(bits: tuple[int, ...]) -> int:
    """A signed 64-bit number with these bits set."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def refinements(fixed: tuple[int, ...], max_bits: int) -> list[tuple[int, ...]]:
    """Sets of fixed bits, each with two more segments of the free ones."""
    free = tuple(b for b in range(64) if b not in fixed)
    return [
        tuple(sorted(fixed + first + second))
        for first, second in combinations(segments(free, max_bits + 2), 2)
    ]


def has_chain(difference: np.ndarray, free: tuple[int, ...], max_bits: int) -> np.ndarray:
    """Whether the differing bits of each pair pass the pigeonring test on the segments of the free bits."""
    count = max_bits + 2
    parts = [np.uint64(sum(1 << b for b in s)) for s in segments(free, count)]
    differing = np.stack([np.bitwise_count(difference & part).astype(np.int64) for part in parts])
    found = np.zeros(difference.shape, bool)
    for start in range(count):
        held = np.ones(difference.shape, bool)
        chain = np.zeros(difference.shape, np.int64)
        for length in range(1, count + 1):
            chain += differing[(start + length - 1) % count]
            held &= chain * count <= length * max_bits
        found |= held
    return found


def forest(prints: np.ndarray, buckets: np.ndarray, masks: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span, inside each bucket, what its links connect. Rows of a bucket stand together.

    ``masks`` has the bits that all rows of the row's bucket share.
    """
    label = np.arange(len(prints))
    lag = 1
    while True:
        first = np.flatnonzero(buckets[lag:] == buckets[:-lag]) if lag < len(prints) else np.zeros(0, int)
        if not first.size:
            break
        first = first[label[first] != label[first + lag]]  # what is connected already needs no check
        difference = prints[first] ^ prints[first + lag]
        passed = np.zeros(first.size, bool)
        for mask in np.unique(masks[first]):
            of_kind = np.flatnonzero(masks[first] == mask)
            free = tuple(b for b in range(64) if not int(mask) >> b & 1)
            chained = of_kind[has_chain(difference[of_kind], free, max_bits)]
            passed[chained] = np.bitwise_count(difference[chained]) <= max_bits
        left, right = first[passed], first[passed] + lag
        while left.size:
            low, high = np.minimum(label[left], label[right]), np.maximum(label[left], label[right])
            np.minimum.at(label, high, low)
            while not np.array_equal(label, label[label]):
                label = label[label]
            open_ = label[left] != label[right]
            left, right = left[open_], right[open_]
        lag += 1
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return prints[linked], prints[label[linked]]


def _compare(max_bits: int):
    """Links of sorted rows (mask, bucket, fingerprint); a bucket may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((3, 0), np.int64)
        batches = iter(batches)
        ended = False
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if batch is not None:
                rows = np.stack([batch.column(c).to_numpy() for c in ("mask", "bucket", "fingerprint")])
                kept = np.concatenate([kept, rows], axis=1)
                same = (kept[0] == kept[0, -1:]) & (kept[1] == kept[1, -1:])
                complete = int(np.argmax(same)) if same.any() else kept.shape[1]
            else:
                complete = kept.shape[1]
            done, kept = kept[:, :complete], kept[:, complete:]
            if not done.shape[1]:
                continue
            change = np.any(done[:2, 1:] != done[:2, :-1], axis=0)
            group = np.concatenate([[0], np.cumsum(change)])
            ends = forest(np.ascontiguousarray(done[2]).view(np.uint64), group, done[0], max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in ends], ["a", "b"])

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket_size: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect what lies within ``max_bits`` bits.

    ``prints`` has one row per distinct fingerprint. Not all links are returned, but as many as it takes to
    connect the same fingerprints.
    """
    spark = prints.sparkSession
    rows, masks, found = prints.select("fingerprint"), [()], []
    while True:
        refined = {fixed: refinements(fixed, max_bits) for fixed in masks}
        rows = _dealt(spark, rows, refined)
        masks = sorted({finer for many in refined.values() for finer in many})
        last = 64 - min(map(len, masks)) <= SMALL
        sizes = rows.groupBy("mask", "bucket").count().where("count > 1")
        crowded = stored(rows.join(sizes, ["mask", "bucket"]), "simhash-buckets")
        small = crowded if last else crowded.where(F.col("count") <= bucket_size)
        # Together, but not by Spark's choice of a join: rows of a bucket must follow one another.
        dealt = small.select("mask", "bucket", "fingerprint").repartition(shuffle_partitions(spark), "mask", "bucket")
        found.append(
            stored(
                dealt.sortWithinPartitions("mask", "bucket", "fingerprint").mapInArrow(_compare(max_bits), "a long, b long"),
                "simhash-links",
            )
        )
        if last:
            break
        rows = crowded.where(F.col("count") > bucket_size).select("mask", "fingerprint")
        if rows.isEmpty():
            break
        rows = rows.distinct()
    return reduce(DataFrame.unionByName, found).distinct()


def _dealt(spark: SparkSession, rows: DataFrame, refined: dict) -> DataFrame:
    """Every row once for each refinement of its fixed bits, with its bucket."""
    if list(refined) == [()]:
        finer = F.explode(F.array(*(F.lit(mask_of(x)) for x in refined[()])))
        rows = rows.select("fingerprint", finer.alias("mask"))
    else:  # a few hundred masks at most
        pairs = [(mask_of(fixed), mask_of(x)) for fixed, many in refined.items() for x in many]
        finer = spark.createDataFrame(pairs, "coarse long, mask long")
        rows = rows.withColumnRenamed("mask", "coarse").join(F.broadcast(finer), "coarse").select("fingerprint", "mask")
    return rows.withColumn("bucket", F.col("fingerprint").bitwiseAND(F.col("mask")))


def near_duplicates(
    docs: DataFrame, max_bits: int = MAX_BITS, shingle_words: int = SHINGLE_WORDS, bucket_size: int = BUCKET
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable, of every row."""
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits, bucket_size))
    placed = distinct.join(roots.withColumnRenamed("vertex", "fingerprint"), "fingerprint", "left")
    placed = placed.select("fingerprint", "first_doc", F.coalesce("root", "fingerprint").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_print = placed.join(smallest, "root").select("fingerprint", "component_id")
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(of_print, "fingerprint").select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def text_key() -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def one_per_group(docs: DataFrame, **parameters: int) -> DataFrame:
    """One row of every group, with the columns of ``docs``.

    It is the row with the smallest doc_id, one without an id last; then the one with the smallest hash of its text,
    then with the smallest other columns. Rows are told apart by id and text, so texts that share an id, or have
    none, stay unless their own group has another.
    """
    keyed = docs.withColumn("__key", text_key())
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("__key").alias("key"))
    groups = near_duplicates(keyed.select(name.alias("doc_id"), "text"), **parameters)
    kept = groups.select(F.col("component_id.key").alias("__kept"), F.col("component_id.id").alias("__doc")).distinct()
    same = (F.col("__key") == F.col("__kept")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
    return one_row(keyed.join(kept, same, "left_semi"), docs.columns)


def one_row(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The smallest row of each ``__key``, where all have one doc_id."""
    row = F.min(F.struct(*columns)).alias("__row")
    return rows.groupBy("__key").agg(row).select(*(F.col(f"__row.{c}").alias(c) for c in columns))
