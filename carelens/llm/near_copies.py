"""Near copies by SimHash and the Jaccard similarity of word shingles: SimHash proposes, exact counts decide.

Every text gets a SimHash fingerprint of its shingles, and the search of ``simhash.links`` connects all fingerprints that
differ in at most ``BITS`` bits. Texts of similarity 0.8 may differ in more, so MinHash bands complement it: a text has
``BANDS`` keys, each of ``ROWS`` of its ``MINIMA`` least hashed shingles, and texts that agree in a key share a bucket. Texts
that fingerprints or buckets connect are a crowd. A pair beyond the radius of similarity 0.8 agrees in no key with a chance of
about 2e-5, a more similar one with less; every pair of a crowd is decided by its exact shingle sets.

A crowd is never turned into rows of pairs. It is cut into blocks of bounded size, and a task gets two blocks: it counts
what their texts share and returns links that connect what is similar, less than one a text. Nearly all crowds are one
block; one of k blocks is sent k times. So a large group of copies costs no more rows than a bucket of texts that only look
alike. Groups are the connected components of all links, and one row of each stays.

Texts travel only where they must: Bloom filters of bounded size, sent to the tasks, tell texts that are in no crowd, or that
no decision can touch, and these stay where they are read.

Defined cases. Words are divided by ASCII white space and lower-cased in ASCII. A text of fewer words than a shingle is one
shingle; null, empty and blank texts have none and are copies of one another. Ids do not link: different texts under one id,
or without an id, are judged apart. Of a group the row with the smallest id stays, one without an id last, then the one
with the smallest hash of its text, then the smallest other columns. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from carelens.llm import simhash
from carelens.llm.arrow_text import slices
from carelens.llm.components import components
from carelens.llm.decontaminate import expanded
from carelens.llm.simhash import one_row, text_key
from carelens.llm.store import shuffle_partitions, stored
from carelens.llm.url_filter import BlockedBloom, bloom_of, key_hash

SHINGLE_WORDS, PERCENT, SEED = 5, 80, 42
BANDS, ROWS, MINIMA = 64, 7, 256
#: Differing bits of two fingerprints that are a candidate pair.
BITS = 3
#: Texts and shingles of a block, about; a shingle that makes more pairs of a tile than this is counted by matrix products.
BLOCK_TEXTS, BLOCK_SHINGLES, DENSE = 1024, 1 << 18, 64
#: Shingles of one matrix product, and of one step of the other counting.
COLUMNS, STEP = 2048, 1 << 14
#: Shingles whose minima are taken at once, and text whose lists make one batch.
PART, PART_BYTES = 512, 4 << 20
#: Odd multiplier of the rolling hash: a golden ratio of 64 bits.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashed shingles in order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in words), np.uint64, len(words))
    size = min(shingle_words, len(words))
    if not size:
        return hashes
    count = len(words) - size + 1
    rolled = np.full(count, size, np.uint64)
    for begin in range(size):
        rolled = (rolled ^ hashes[begin : begin + count]) * FACTOR
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is xored to a hash and then multiplied, of each permutation, and the permutations of each band."""
    random = np.random.default_rng(SEED)
    mask, odd = random.integers(0, 1 << 64, (2, MINIMA, 1), np.uint64)
    return mask, odd | np.uint64(1), np.stack([random.permutation(MINIMA)[:ROWS] for _ in range(BANDS)])


def band_keys(hashed: np.ndarray) -> np.ndarray:
    """The bucket of the shingles in each band."""
    mask, odd, chosen = _permutations()
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(hashed), PART):
        np.minimum(least, ((hashed[begin : begin + PART] ^ mask) * odd).min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least[chosen].T:
        key = (key ^ row) * FACTOR
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _mapped(frame: DataFrame, of, kinds: T.StructType) -> DataFrame:
    """The frame with ``of(shingles of its text)``, the values of the columns ``kinds``, in the place of its text."""
    rest = [c for c in frame.columns if c != "text"]
    schema = T.StructType([*(frame.schema[c] for c in rest), *kinds.fields])
    types = [to_arrow_type(kind.dataType) for kind in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART_BYTES):
            found = zip(*(of(shingles(x.as_py())) for x in batch.column("text")), strict=True)
            made = [pa.array(list(x), kind) for x, kind in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *made], names=schema.names)

    return frame.mapInArrow(run, schema)


BANDED = T.StructType().add("n", T.LongType()).add("fingerprint", T.LongType()).add("bands", T.ArrayType(T.LongType()))


def _banded(hashed: np.ndarray) -> list:
    return [len(hashed), int(np.uint64(simhash.majority(hashed)).view(np.int64)), band_keys(hashed)]


def shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many members each set numbered in ``left`` shares with each in ``right``."""
    count = np.zeros((len(left), len(right)))
    place = np.full((2, len(sets)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    members, code = np.unique(np.concatenate(sets), return_inverse=True)
    lists, begins, sizes = [], [], []
    for side in place:  # of each member, the sets of the side that hold it
        own = np.flatnonzero(side[owner] >= 0)
        own = own[np.argsort(code[own], kind="stable")]
        lists.append(side[owner[own]])
        sizes.append(np.bincount(code[own], minlength=len(members)))
        begins.append(np.cumsum(sizes[-1]) - sizes[-1])
    both = np.flatnonzero((sizes[0] > 0) & (sizes[1] > 0))
    often = sizes[0][both] * sizes[1][both] > DENSE
    for part in np.array_split(both[often], -(-int(often.sum()) // COLUMNS) or 1):
        held = []
        for rows, begin, size, n in zip(lists, begins, sizes, count.shape, strict=True):
            at, column = expanded(begin[part], begin[part] + size[part])
            held.append(np.zeros((n, len(part)), np.float32))
            held[-1][rows[at], column] = 1
        count += held[0] @ held[1].T
    rare = both[~often]
    for begin in range(0, len(rare), STEP):
        part = rare[begin : begin + STEP]
        at, member = expanded(begins[0][part], begins[0][part] + sizes[0][part])
        a = lists[0][at]
        at, pair = expanded(begins[1][part][member], (begins[1] + sizes[1])[part][member])
        np.add.at(count.reshape(-1), a[pair] * len(right) + lists[1][at], 1)
    return count


def forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of sets, and of a set that each is connected with by similar pairs of the two sides."""
    size = np.array([len(x) for x in sets])
    both = shared(sets, left, right)
    a, b = np.nonzero(both * 100 >= (size[left][:, None] + size[right] - both) * percent)
    a, b = left[a], right[b]
    label = np.arange(len(sets))
    while a.size:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    linked = np.flatnonzero(label != np.arange(len(sets)))
    return linked, label[linked]


def _links(percent: int):
    """Links of the tiles of a task; rows (root, tile, side, key, set) of a tile follow one another."""

    def of(rows: list[dict]) -> pa.RecordBatch:
        sets = [np.frombuffer(row["set"], np.uint64) for row in rows]
        side = np.array([row["side"] for row in rows])
        left = np.flatnonzero(side == side.min())
        right = np.flatnonzero(side != side.min()) if side.max() > side.min() else left
        ends = forest(sets, left, right, percent)
        return pa.RecordBatch.from_arrays([pa.array([rows[i]["key"] for i in x], pa.binary()) for x in ends], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["root"], row["tile"]) != (held[0]["root"], held[0]["tile"]):
                    yield of(held)
                    held = []
                held.append(row)
        if held:
            yield of(held)

    return run


def alike(banded: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) that connect the texts (id, fingerprint) whose fingerprints differ in at most ``bits`` bits."""
    first = stored(banded.groupBy("fingerprint").agg(F.min("id").alias("a")), "near-copy-prints")
    found = simhash.links(first.select("fingerprint"), bits).withColumnsRenamed({"a": "fingerprint", "b": "other"})
    ends = first.select(F.col("fingerprint").alias("other"), F.col("a").alias("b"))
    apart = found.join(first, "fingerprint").join(ends, "other").select("a", "b")
    same = banded.join(first, "fingerprint").where("a < id").select("a", F.col("id").alias("b"))
    return apart.unionByName(same)


def crowds(banded: DataFrame) -> DataFrame:
    """(key, root) of texts with a near fingerprint or a shared bucket, the root naming their crowd; ``banded`` has key,
    fingerprint and bands.

    Here 64 bits stand for a text. Two texts that share them only make two crowds one.
    """
    own = F.xxhash64("key").alias("id")
    rows = banded.select(own, F.explode("bands").alias("bucket"))
    heads = rows.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last")
    shared = rows.join(heads, "bucket").where("a < id").select("a", F.col("id").alias("b"))
    edges = shared.unionByName(alike(banded.select(own, "fingerprint"))).distinct()
    return banded.select("key", own).join(components(edges), F.col("id") == F.col("vertex")).select("key", "root")


def _bloom(keys: DataFrame):
    """The bits of a filter of the keys, sent to the tasks."""
    bits = bloom_of(keys.select(F.hex("key").alias("host"), F.lit("").alias("path"))).bits
    return keys.sparkSession.sparkContext.broadcast(bits)


def _hashed(key: str) -> Column:
    return key_hash(F.hex(key), F.lit(""))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, set) of the wanted keys and maybe a few more; ``docs`` has key and text. Each key has one row."""
    sent = _bloom(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text", PART_BYTES):
            held = batch.filter(pa.array(BlockedBloom(sent.value).may_hold(batch.column("hash").to_numpy())))
            keys, sets = [], []
            for key, text in zip(held.column("key").to_pylist(), held.column("text"), strict=True):
                if key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(shingles(text.as_py()).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["key", "set"])

    source = docs.select("key", _hashed("key").alias("hash"), "text")
    return source.mapInArrow(run, "key binary, set binary").groupBy("key").agg(F.first("set").alias("set"))


def tiles(crowd: DataFrame, sets: DataFrame, texts: int, members: int) -> DataFrame:
    """The sets of every crowd, once for each tile they take part in. ``crowd`` has key, root and n, the size of its set."""
    total = crowd.groupBy("root").agg(F.count("*").alias("texts"), F.sum("n").alias("members"))
    blocks = F.ceil(F.greatest(F.col("texts") / texts, F.col("members") / members, F.lit(1)))
    placed = crowd.join(total.select("root", blocks.alias("blocks")), "root")
    placed = placed.withColumn("side", F.pmod(F.xxhash64("key"), "blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    tile = F.explode(F.transform(others, lambda x: F.least("side", x) * F.col("blocks") + F.greatest("side", x)))
    return placed.join(sets, "key").select("root", tile.alias("tile"), "side", "key", "set")


def links(docs: DataFrame, banded: DataFrame, percent: int, texts: int, members: int) -> DataFrame:
    """Links (a, b) between keys of ``docs`` (key, text) that connect what is similar."""
    crowd = crowds(banded.select("key", "fingerprint", "bands")).join(banded.select("key", "n"), "key")
    crowd = stored(crowd, "near-copy-crowds")
    dealt = tiles(crowd, sets_of(docs, crowd.select("key")), texts, members)
    dealt = dealt.repartition(shuffle_partitions(docs.sparkSession), "root", "tile").sortWithinPartitions("root", "tile")
    return stored(dealt.mapInArrow(_links(percent), "a binary, b binary"), "near-copy-links")


def one_per_group(
    docs: DataFrame, percent: int = PERCENT, block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """One row of every group of near copies, with the columns of ``docs``."""
    keyed = docs.withColumn("__key", text_key())
    source = keyed.select(F.col("__key").alias("key"), "doc_id", "text")
    banded = stored(_mapped(source, _banded, BANDED), "near-copy-bands")
    # A text's rows have the same fingerprint and bands, so any will do; the smallest id names the text.
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    own = (F.min(c).alias(c) for c in BANDED.fieldNames())
    distinct = banded.groupBy("key").agg(F.min(name).alias("first"), *own)
    distinct = stored(distinct, "near-copy-texts")
    linked = components(links(source, distinct, percent, block_texts, block_shingles)).withColumnRenamed("vertex", "key")

    first = distinct.select("key", "first")
    grouped = stored(linked.join(first, "key"), "near-copy-groups")
    chosen = grouped.groupBy("root").agg(F.min(F.struct("first", "key")).alias("best"))
    lost = grouped.join(chosen, "root").where("key <> best.key").select("key")
    # A text that is in no group and has one row stays. Of the others, rows of one key and id may be several; few are.
    copies = banded.groupBy("key", "doc_id").agg((F.count("*") > 1).alias("__many"))
    several = banded.groupBy("key").count().where("count > 1").select("key")
    touched = stored(grouped.select("key").unionByName(several).distinct(), "near-copy-touched")
    left = first.join(lost, "key", "left_anti").select("key", "first.doc_id", F.lit(True).alias("stays"))
    judged = copies.join(touched, "key", "left_semi").withColumnRenamed("key", "__own").withColumnRenamed("doc_id", "__doc")
    same = (F.col("key") == F.col("__own")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
    judged = judged.join(left, same, "left").select("__own", "__doc", "__many", F.coalesce("stays", F.lit(False)).alias("__stays"))
    judged, sent = stored(judged, "near-copy-verdicts"), _bloom(touched)

    @F.arrow_udf("boolean")
    def may_be_touched(hashes: pa.Array) -> pa.Array:
        return pa.array(BlockedBloom(sent.value).may_hold(hashes.to_numpy()))

    asked = keyed.withColumn("__touched", may_be_touched(_hashed("__key")))
    # What passes the filter though nothing touches it has no verdict and stays.
    passed = asked.where("__touched").drop("__touched")
    rows = passed.join(judged, (passed["__key"] == judged["__own"]) & passed["doc_id"].eqNullSafe(judged["__doc"]), "left")
    single = rows.where("__stays IS NULL OR (__stays AND NOT __many)").select(*(passed[c] for c in docs.columns))
    out = asked.where("NOT __touched").select(*docs.columns).unionByName(single)
    many = judged.where("__stays AND __many")
    return out if many.isEmpty() else out.unionByName(one_row(rows.where("__stays AND __many"), docs.columns))
