"""Ranked lexical search by scanning the documents with an automaton of all items' terms.

A text is turned into its terms with one space before, between and after them, and every term of the items goes into an
Aho-Corasick automaton with a space at both ends. These guards make a match a whole term, and as a space may end one match
and begin the next, none is missed. A scan counts how often each term occurs in a document; there is no index of the
documents. From the counts come the corpus's own numbers (documents, terms, and documents that hold each term); then the
automaton's outputs are mapped to items, and each task keeps the best documents of every item it met. A tree of merges
leaves one list per item.

Items are dealt into blocks whose terms have at most ``BLOCK_BYTES``, checked before they are sent to the tasks; a block
is scanned, ranked and dropped before the next. An item with more terms than that is a block of its own.

Defined cases. A null text has no terms; documents without terms count nowhere. Rows that share an item_id, null among them,
are one item with the terms of all. Documents are ranked each, whatever their id; a null id comes before others of equal
score. Items without terms, or none of whose terms occurs, have no rows. Empty tables give an empty result. Other columns
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.arrow_text import slices
from carelens.llm.decontaminate import expanded
from carelens.llm.store import stored
from carelens.llm.topk import merged

K = 10
#: Bytes of the terms of one block of items, and text of documents in one batch.
BLOCK_BYTES, SHARD_BYTES = 1 << 20, 4 << 20
#: Scores that are held at once, documents times items, and parts of scores that are added up at once.
CELLS, PARTS = 1 << 21, 1 << 21

# Fixed values of the score.
SCALE, WEIGHT_SCALE, TF_SCALE, LENGTH_WEIGHT, PERCENT, SATURATION = 1_000_000_000, 1000, 1000, 90, 100, 8

#: Byte to what stands for it: lower-cased if it belongs to a term, else a space.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

COUNTS = "n long, terms array<int>, counts array<long>"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


@dataclass
class Block:
    """Terms of some items; ``first`` and ``items`` list the items of each term, by number."""

    terms: list[bytes]
    first: np.ndarray
    items: np.ndarray
    n_items: int

    def __getstate__(self) -> dict:
        return {name: getattr(self, name) for name in ("terms", "first", "items", "n_items")}

    @cached_property
    def automaton(self):
        """Built once in each worker."""
        import ahocorasick

        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(f" {term.decode('latin-1')} ", number)
        made.make_automaton()
        return made

    def count(self, text: str | None) -> tuple[int, list[int], list[int]]:
        """The number of terms of a text, and the block's terms in it with how often each occurs."""
        terms = terms_of(text)
        if not terms or not self.terms:
            return len(terms), [], []
        guarded = f" {b' '.join(terms).decode('latin-1')} "  # a character per byte
        found = sorted(Counter(map(itemgetter(1), self.automaton.iter(guarded))).items())
        return len(terms), [number for number, _ in found], [times for _, times in found]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[DataFrame, Block]]:
    """The items in blocks, one at a time: (number, item_id), and the terms that are sent to the tasks."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            found = [sorted(set(terms_of(x.as_py()))) for x in batch.column("text")]
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            terms = pa.array([t for x in found for t in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(rows)), terms], ["item_id", "term"])

    source = benchmark.select("item_id", "text")
    kind = source.schema["item_id"].dataType.simpleString()
    pairs = stored(source.mapInArrow(split, f"item_id {kind}, term binary").distinct(), "item-terms")
    sizes = stored(pairs.groupBy("item_id").agg(F.sum(F.length("term") + 2).alias("size")), "item-sizes")
    total = sizes.agg(F.sum("size")).first()[0]
    if total is None:
        return
    count = -(-total // block_bytes)
    while True:  # no block of several items is larger than what may be sent
        block = F.pmod(F.xxhash64("item_id"), F.lit(count))
        dealt = sizes.groupBy(block.alias("block")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        if dealt.where((F.col("size") > block_bytes) & (F.col("n") > 1)).isEmpty():
            break
        count *= 2
    for number in range(count):
        own = pairs.where(block == number).toArrow()
        if own.num_rows:
            yield _block(benchmark.sparkSession, own, kind)


def _block(spark, pairs: pa.Table, kind: str) -> tuple[DataFrame, Block]:
    ids = pairs.column("item_id").combine_chunks().dictionary_encode("encode")
    terms = pairs.column("term").combine_chunks().dictionary_encode()
    number, term = (x.indices.to_numpy().astype(np.int64) for x in (ids, terms))
    order = np.lexsort((number, term))
    first = np.append(0, np.cumsum(np.bincount(term, minlength=len(terms.dictionary))))
    items = ids.dictionary
    named = spark.createDataFrame([(i, x) for i, x in enumerate(items.to_pylist())], f"number int, item_id {kind}")
    return named, Block(terms.dictionary.to_pylist(), first, number[order], len(items))


def counted(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """doc_id, n and the counts of the block's terms, of every document with terms. ``sent`` is the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            n, terms, counts = zip(*(sent.value.count(x.as_py()) for x in batch.column("text")), strict=True)
            arrays = [pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n", "terms", "counts"])

    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, {COUNTS}").where("n > 0")


def weights(rows: DataFrame, n_docs: int, n_terms: int) -> np.ndarray:
    """The weight of each of the block's terms; one that no document holds has none."""
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)) * WEIGHT_SCALE).alias("weight")
    found = held.select("term", weight).toArrow()  # at most the block's terms
    out = np.zeros(n_terms, np.int64)
    out[found.column("term").to_numpy()] = found.column("weight").to_numpy()
    return out


class Best:
    """The best documents of each item so far; of equal scores the smaller id, a null one first."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.rows = np.zeros((4, 0), np.int64)  # item, negated score, whether there is an id, id

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        """Scores of documents (rows) for items (columns)."""
        least = np.zeros(scores.shape[1], np.int64)
        full = np.flatnonzero(np.bincount(self.rows[0], minlength=scores.shape[1]) == self.k)
        if full.size:  # rows stand by item and rank, so an item's last one has its least score
            least[full] = -self.rows[1][np.searchsorted(self.rows[0], full, side="right") - 1]
        doc, item = np.nonzero((scores > 0) & (scores >= least))
        new = np.stack([item, -scores[doc, item], known[doc], ids[doc]])
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        self.rows = rows[:, place < self.k]

    def lists(self) -> pa.RecordBatch:
        items, size = np.unique(self.rows[0], return_counts=True)
        ids = pa.array(self.rows[3], mask=self.rows[2] == 0)
        pairs = pa.StructArray.from_arrays([pa.array(self.rows[1]), ids], ["negated", "doc_id"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pairs)
        return pa.RecordBatch.from_arrays([pa.array(items.astype(np.int32)), lists], ["query_id", "top"])


def scores_of(block: Block, weight: np.ndarray, m: np.ndarray, begins: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Scores of documents for all items of the block; ``begins`` says where the terms of each document begin."""
    doc = np.repeat(np.arange(len(m)), np.diff(begins))
    own = np.flatnonzero(weight[terms] > 0)
    doc, terms, tf = doc[own], terms[own], tf[own]
    part = weight[terms] * ((SCALE * tf) // (TF_SCALE * tf + SATURATION * m[doc]))
    at, row = expanded(block.first[terms], block.first[terms + 1])
    out = np.zeros((len(m), block.n_items), np.int64)
    # In two halves, as sums are kept as floating-point numbers.
    cell = doc[row] * block.n_items + block.items[at]
    for shift, piece in ((20, part >> 20), (0, part & 0xFFFFF)):
        summed = np.bincount(cell, weights=piece[row].astype(float), minlength=out.size)
        out += summed.astype(np.int64).reshape(out.shape) << shift
    return out


def _ranked(rows: DataFrame, sent: Broadcast, weight: np.ndarray, n_docs: int, all_terms: int, k: int) -> DataFrame:
    """The best documents of each item that a task met; ``weight`` has a number for each of the block's terms."""
    # 64 bits would not do for the product of a very long text and very many documents.
    wide = F.lit(LENGTH_WEIGHT).cast("decimal(3,0)") * F.col("n").cast("decimal(14,0)") * F.lit(n_docs).cast("decimal(19,0)")
    length = (PERCENT - LENGTH_WEIGHT + F.floor(F.expr("wide div total"))).cast("long")
    source = rows.withColumn("wide", wide).withColumn("total", F.lit(all_terms).cast("decimal(19,0)")).select(
        F.col("doc_id").cast("long").alias("doc_id"), length.alias("m"), "terms", "counts"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = sent.value, Best(k)
        most = max(1, CELLS // block.n_items)
        for batch in batches:
            terms = batch.column("terms")
            flat = terms.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            ends = np.append(0, np.cumsum(terms.value_lengths().to_numpy()))
            parts = np.append(0, np.cumsum(block.first[flat[0] + 1] - block.first[flat[0]]))[ends]
            m = batch.column("m").to_numpy()
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            begin = 0
            while begin < batch.num_rows:
                fits = int(np.searchsorted(parts, parts[begin] + PARTS, side="right")) - 1
                end = max(begin + 1, min(begin + most, fits, batch.num_rows))
                own = slice(ends[begin], ends[end])
                scores = scores_of(block, weight, m[begin:end], ends[begin : end + 1], flat[0][own], flat[1][own])
                best.add(scores, known[begin:end], ids[begin:end])
                begin = end
        yield best.lists()

    return source.mapInArrow(run, "query_id int, top array<struct<negated:long,doc_id:long>>")


def best_documents(docs: DataFrame, benchmark: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` documents that score highest for each item."""
    found, corpus = [], None
    for names, block in blocks(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        rows = stored(counted(docs, sent), "term-counts")
        corpus = corpus or rows.agg(F.count("*"), F.sum("n")).first()
        n_docs, all_terms = corpus
        if not n_docs:
            break
        weight = weights(rows, n_docs, len(block.terms))
        lists = merged(stored(_ranked(rows, sent, weight, n_docs, all_terms, k), "item-lists"), k)
        sent.unpersist()
        found.append(lists.join(names, F.col("query_id") == F.col("number")).select("item_id", "top"))
    if not found:
        kinds = f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
        return docs.sparkSession.createDataFrame([], kinds)
    pairs = reduce(DataFrame.unionByName, found).select("item_id", F.posexplode("top").alias("place", "pair"))
    rank, score = (F.col("place") + 1).alias("rank"), (-F.col("pair.negated")).alias("score")
    return pairs.select("item_id", rank, F.col("pair.doc_id").alias("doc_id"), score)
