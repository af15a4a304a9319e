"""Exact top-k inner products by tiles: blocks of queries times shards of candidates.

Vectors are packed into shards and query blocks, one row each, of bounded size. Every pair of a block and a shard is a
tile: one matrix product, of which each query keeps its k best. Tiles are dealt on a grid: a cell has a row of about
``CELL_BLOCKS`` blocks, which its task holds, and a column of shards, which pass by them one after another. So a shard is sent
once for every row of the grid and not for every block, and a block once for every column. A tree of merges brings
the lists of a query together, ``FAN_IN`` at a time, until one is left; no step holds more than ``FAN_IN`` lists of k per
query.

Components are scaled and rounded down to whole numbers, and products are exact: in 32-bit floats, in 64-bit floats or in
Python's integers, whichever the tile's largest components call for; scores beyond 64 bits are set to its ends.

Defined cases. Vectors that are null or hold null or non-finite components take no part, nor do rows without an id.
Vectors of different lengths are compared as if the shorter ended in zeros; an empty one scores 0 with every other.
Rows with the query's id are its own. Repeated candidates are ranked each. Rows that repeat a query's id and vector
are asked once; if rows of one id have different vectors, the scores of all of them are ranked in one list. Ties go to the
smaller id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.store import shuffle_partitions, stored

K, SCALE, QUERY_STEP = 20, 64, 20
#: Vectors in a shard and in a query block; lists that one merge takes.
SHARD, BLOCK, FAN_IN = 2048, 1024, 16
#: Blocks that a task holds, about.
CELL_BLOCKS = 32
#: Matrices are kept in the smallest of these kinds that holds them.
KINDS = ("<i2", "<i4", "<f8")

LISTS = "query_id long, top array<struct<negated:long,vec_id:long>>"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and components rounded down, of the rows that take part."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    components = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    taking_part = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    return taking_part.select(F.col("vec_id").cast("long").alias("vec_id"), components.alias("components"))


def packed(rows: DataFrame, most: int) -> DataFrame:
    """(part, ids, kind, matrix): rows in parts of at most ``most``, numbered by where they were packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        ids: list[np.ndarray] = []
        vectors: list[list] = []

        def emit() -> pa.RecordBatch:
            nonlocal part, vectors
            own, rest = vectors[:most], vectors[most:]
            numbers = np.concatenate(ids)
            width = max(map(len, own))
            matrix = np.zeros((len(own), width))
            for row, vector in enumerate(own):
                matrix[row, : len(vector)] = vector
            kind = next(x for x in KINDS if np.array_equal(matrix, matrix.astype(x)))
            out = [[part], [numbers[: len(own)].tobytes()], [kind], [matrix.astype(kind).tobytes()]]
            types = (pa.int64(), pa.binary(), pa.string(), pa.binary())
            ids[:], vectors = [numbers[len(own) :]], rest
            part += 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names)

        for batch in batches:
            ids.append(batch.column("vec_id").to_numpy())
            vectors.extend(batch.column("components").to_pylist())
            while len(vectors) >= most:
                yield emit()
        if vectors:
            yield emit()

    names = ["part", "ids", "kind", "matrix"]
    return rows.mapInArrow(run, "part long, ids binary, kind string, matrix binary")


def unpacked(ids: bytes, kind: str, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    return numbers, np.frombuffer(matrix, kind).reshape(len(numbers), -1).astype(np.float64)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit numbers."""
    width = min(queries.shape[1], shard.shape[1])
    queries, shard = queries[:, :width], shard[:, :width]
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(width, 1)
    if bound < 1 << 53:
        exact = np.float32 if bound < 1 << 24 else np.float64
        return (queries.astype(exact) @ shard.astype(exact).T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (queries, shard)]
    most = np.iinfo(np.int64).max
    exact = [[min(max(sum(map(int.__mul__, q, c)), -most), most) for c in whole[1]] for q in whole[0]]
    return np.array(exact, np.int64).reshape(len(queries), len(shard))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores with their ids, largest first, ties by id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, at = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        rest = k - len(above)
        if len(at) > rest:
            at = at[np.argpartition(ids[at], rest - 1)[:rest]]
        chosen = np.concatenate([above, at])
        ids, scores = ids[chosen], scores[chosen]
    order = np.lexsort((ids, -scores))
    return ids[order], scores[order]


def _tiles(k: int):
    """Best lists of every query of the cells of a task; a cell's blocks come before its shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks, held = None, [], {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    if held:
                        yield _listed(held)
                    cell, blocks, held = row["cell"], [], {}
                ids, vectors = unpacked(row["ids"], row["kind"], row["matrix"])
                if row["side"] == ASKED:
                    blocks.append((ids.tolist(), vectors))
                    continue
                for query_ids, queries in blocks:
                    for query, scores in zip(query_ids, products(queries, vectors), strict=True):
                        _take(held, query, ids, scores, k)
        if held:
            yield _listed(held)

    return run


def _take(held: dict, query: int, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Merge a tile's row of scores into the query's list."""
    have = held.get(query)
    if have is not None and len(have[1]) == k and scores.max() < have[1][-1]:
        return
    other = ids != query
    own = best(ids[other], scores[other], k)
    held[query] = own if have is None else best(*(np.concatenate(x) for x in zip(have, own, strict=True)), k)


def _listed(held: dict) -> pa.RecordBatch:
    size = [len(ids) for ids, _ in held.values()]
    columns = [np.concatenate([x[i] for x in held.values()]) for i in (1, 0)]
    pairs = pa.StructArray.from_arrays([pa.array(-columns[0]), pa.array(columns[1])], ["negated", "vec_id"])
    ends = pa.array(np.append(0, np.cumsum(size)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.ListArray.from_arrays(ends, pairs)], ["query_id", "top"])


#: Sides of a cell, in the order they are needed.
ASKED, PASSING = 0, 1


def grid(shards: DataFrame, blocks: DataFrame, cell_blocks: int) -> DataFrame:
    """Blocks and shards (part, ids, kind, matrix) once for every cell they belong to, the cells being partitions."""
    spark = shards.sparkSession
    n_blocks, n_shards = (max(1, side.count()) for side in (blocks, shards))
    rows = -(-n_blocks // cell_blocks)
    columns = max(1, min(n_shards, -(-shuffle_partitions(spark) // rows)))
    own = {ASKED: F.pmod(F.xxhash64("part"), F.lit(rows)), PASSING: F.pmod(F.xxhash64("part"), F.lit(columns))}
    across = F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))
    down = F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))
    asked = blocks.withColumn("other", across).withColumn("cell", (own[ASKED] * columns + F.col("other")).cast("int"))
    passing = shards.withColumn("other", down).withColumn("cell", (F.col("other") * columns + own[PASSING]).cast("int"))
    both = asked.withColumn("side", F.lit(ASKED)).unionByName(passing.withColumn("side", F.lit(PASSING))).drop("other", "part")
    return both.repartitionById(rows * columns, F.col("cell")).sortWithinPartitions("cell", "side")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK, cell_blocks: int = CELL_BLOCKS
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best candidates. Both sides as of :func:`whole_vectors`."""
    shards = stored(packed(vectors, shard), "vector-shards")
    distinct = stored(queries.distinct(), "queries")
    parts = max(1, -(-distinct.count() // block))
    asked = stored(packed(distinct.repartition(parts, "vec_id", "components"), block), "query-blocks")
    tiles = grid(shards, asked, cell_blocks)
    return ranked(merged(stored(tiles.mapInArrow(_tiles(k), LISTS), "top-lists"), k))


def merged(lists: DataFrame, k: int) -> DataFrame:
    """One list per query, by a tree of merges."""
    while True:
        most = lists.groupBy("query_id").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return lists
        dealt = lists.withColumn("part", F.pmod(F.xxhash64("top"), F.lit(-(-most // FAN_IN))))
        top = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")
        lists = stored(dealt.groupBy("query_id", "part").agg(top).select("query_id", "top"), "top-lists")


def ranked(lists: DataFrame) -> DataFrame:
    rows = lists.select("query_id", F.posexplode("top").alias("place", "pair"))
    score = (-F.col("pair.negated")).alias("score")
    return rows.select("query_id", (F.col("place") + 1).alias("rank"), F.col("pair.vec_id").alias("vec_id"), score)


def search(vectors: DataFrame, step: int = QUERY_STEP, k: int = K) -> DataFrame:
    """Every row whose id is divisible by ``step`` against all rows."""
    whole = stored(whole_vectors(vectors), "vectors")
    return top_k(whole, whole.where(F.col("vec_id") % step == 0), k)
