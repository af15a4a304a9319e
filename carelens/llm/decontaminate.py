"""Benchmark passages in training documents, found with suffix arrays of the training text.

Documents are read in shards of bounded size. A shard's words become numbers of the benchmark's vocabulary (a word
the benchmark lacks ends every match), and the suffixes that are long enough to hold a window are sorted as far as
windows reach: the shard's suffix array. Every test suffix is then searched in it by narrowing its range of suffixes word
by word, all suffixes at once, until the range holds the occurrences of its window. Passages that were hit, in documents
and in items, are then sorted together, whole suffixes now, and each hit place finds its longest verbatim match in the
test suffixes next to it: common prefixes fall with distance. So the time does not grow with the square of an item's length.

The benchmark is sent to the tasks in blocks of at most about ``BLOCK_BYTES`` (a longer item is a block of its own); a
larger benchmark takes several passes over the documents, one after the other, whose stored findings are merged per
document.

The longest match of a document is given by its length, the first place that has it, and an item that holds it.

Defined cases. Null and empty texts have no words. An item without words is never found; items with the same id are
one item; a null id counts as an empty one. Repeated documents are judged each. An empty benchmark contaminates
nothing. Columns besides doc_id and text are carried along unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.arrow_text import slices, utf8
from carelens.llm.store import stored

WINDOW_WORDS = 10
#: Text of documents in one suffix array, and text of benchmark items sent to the tasks at once.
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 8 << 20
#: Bits of a sort key; words of the vocabulary are packed into it, as many as find room.
KEY_BITS = 63

SPAN = "struct<begin:long,end:long>"
FOUND = f"n_words long, spans array<{SPAN}>, items array<string>, longest_words long, longest_begin long, longest_item string"


def _lowered() -> np.ndarray:
    """Byte to lower-cased word byte, 0 for bytes between words."""
    byte = np.zeros(256, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        byte[first : last + 1] = np.arange(first, last + 1)
    byte[0x41:0x5B] = np.arange(0x61, 0x7B)
    return byte


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array, and where the words of each text begin."""
    data, begins = utf8(column)
    low = _lowered()[data]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = begins[:-1][begins[:-1] < begins[1:]]
    first[heads] = inside[heads]
    places = np.flatnonzero(first)
    order = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=order[1:])
    offsets = np.append(order[places], order[-1])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])]
    )
    return words, np.searchsorted(places, begins)


class TestBlock:
    """Benchmark items as numbers, and every suffix of theirs that can hold a window."""

    __test__ = False  # not a test case

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW_WORDS) -> None:
        self.full_window = window
        words, begins = words_of(pa.array(texts, pa.large_string()))
        self.vocabulary = pc.unique(words)
        self.names = sorted(set(ids))
        number = {name: i for i, name in enumerate(self.names)}
        items = np.array([number[x] for x in ids], np.int64)
        lengths = np.diff(begins)
        window_of = np.minimum(lengths, window)
        count = np.where(lengths > 0, lengths - window_of + 1, 0)
        owner = np.repeat(np.arange(len(ids)), count)
        self.begin = begins[owner] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.text_number, self.item, self.window = owner, items[owner], window_of[owner]
        self.widest = int(window_of.max(initial=0))
        self.shortest = int(window_of[lengths > 0].min()) if (lengths > 0).any() else 0
        self.text = np.append(pc.index_in(words, value_set=self.vocabulary).to_numpy(zero_copy_only=False), -2).astype(np.int64)


def packed(text: np.ndarray, places: np.ndarray, bits: int) -> np.ndarray:
    """The next words at each place, ``bits`` each, as one number in the same order."""
    key = np.zeros(len(places), np.int64)
    for step in range(KEY_BITS // bits):
        key = key << bits | text[places + step] + 1
    return key


def suffix_array(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The places ordered by the words that follow, as far as ``depth`` words; ``text`` is padded with -1."""
    bits = max(int(text.max(initial=0) + 1).bit_length(), 1)
    key = packed(text, places, bits)
    order = np.argsort(key, kind="stable")
    order, key = places[order], key[order]
    fresh = np.append(True, key[1:] != key[:-1])[: len(order)]
    step = KEY_BITS // bits
    for sorted_words in range(step, depth, step):
        tied = ~(fresh & np.append(fresh[1:], True))
        at = np.flatnonzero(tied)
        if not at.size:
            break
        group = np.cumsum(fresh)[at]
        key = packed(text, order[at] + sorted_words, bits)
        finer = np.lexsort((key, group))
        order[at], key = order[at][finer], key[finer]
        split = np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))
        fresh[at] |= split
    return order


def names_by_length(text: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1, 2, 4, ... words from each place on, until all places differ; words behind the end are least."""
    names = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
    while len(text) and names[-1].max() + 1 < len(text):
        half, step = names[-1], 1 << len(names) - 1
        after = np.zeros(len(text), np.int64)
        after[:-step] = half[step:] + 1
        names.append(np.unique(half * (len(text) + 1) + after, return_inverse=True)[1].astype(np.int64))
    return names


def common_prefixes(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from places ``a`` and ``b`` on are alike."""
    n = len(names[0])
    length = np.zeros(len(a), np.int64)
    for level in range(len(names) - 1, -1, -1):
        inside = np.flatnonzero((a + length < n) & (b + length < n))
        alike = names[level][a[inside] + length[inside]] == names[level][b[inside] + length[inside]]
        length[inside[alike]] += 1 << level
    return length


def longest_matches(text: np.ndarray, asked: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each asked place the length of its longest match with a known place, and that place.

    Passages of ``text`` must be ended by words of their own, so that no match goes beyond them. In the order of all
    suffixes the best match is the next known place on one side.
    """
    names = names_by_length(text)
    order = np.argsort(names[-1])
    rank = np.empty(len(text), np.int64)
    rank[order] = np.arange(len(text))
    alike = common_prefixes(names, order[:-1], order[1:])
    is_known = np.zeros(len(text), bool)
    is_known[rank[known]] = True
    best, place = np.zeros(len(asked), np.int64), np.full(len(asked), -1, np.int64)
    for backward in (False, True):
        flags, steps, at = (is_known[::-1], alike[::-1], len(text) - 1 - rank[asked]) if backward else (is_known, alike, rank[asked])
        stretch = np.cumsum(flags)  # known places so far; the least common prefix starts anew behind each
        lift = stretch[:-1] * (len(text) + 1)
        least = np.minimum.accumulate(steps - lift) + lift if len(steps) else steps
        last = np.maximum.accumulate(np.where(flags, np.arange(len(text)), -1))
        usable = np.flatnonzero((at > 0) & (last[np.maximum(at - 1, 0)] >= 0))
        length = least[at[usable] - 1]
        source = last[at[usable] - 1]
        source = order[len(text) - 1 - source] if backward else order[source]
        better = length > best[usable]
        best[usable[better]], place[usable[better]] = length[better], source[better]
    return best, place


def lower_bound(text, order, low, high, depth, word):
    """Per range [low, high) of suffixes alike in ``depth`` words: the first whose next word is ``word`` or more."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not open_.size:
            return low
        middle = (low[open_] + high[open_]) // 2
        less = text[order[middle] + depth] < word[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]


def expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return low[owner] + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size), owner


def _covered(size: int, begin: np.ndarray, length: int) -> np.ndarray:
    """Which of ``size`` places lie in a stretch of this length from one of the beginnings on."""
    edge = np.bincount(begin, minlength=size + 1) - np.bincount(begin + length, minlength=size + 1)
    return np.cumsum(edge)[:size] > 0


def _passages(mask: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The masked places with one number of room behind each passage, which ends with its part: the places, and where
    each comes to stand."""
    places = np.flatnonzero(mask)
    new = np.append(False, (np.diff(places) > 1) | (np.diff(part[places]) > 0))[: len(places)]
    return places, np.arange(len(places)) + np.cumsum(new)


def _full_matches(block: TestBlock, text: np.ndarray, at: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The longest match and its item for the places ``at``, each of which holds the full window of one of the suffixes."""
    window = block.full_window
    own, own_slot = _passages(_covered(len(text), at, window), np.zeros(len(text), np.int8))
    part = np.zeros(len(block.text), np.int64)
    part[block.begin] = block.text_number
    part = np.maximum.accumulate(part)
    test, test_slot = _passages(_covered(len(block.text), block.begin[suffixes], window), part)
    test_slot = test_slot + own_slot[-1] + 2
    size = int(test_slot[-1]) + 2
    joint = len(block.vocabulary) + np.arange(size)  # a word of its own wherever a passage ends
    joint[own_slot], joint[test_slot] = text[own], block.text[test]
    known = test_slot[np.searchsorted(test, block.begin[suffixes])]
    length, place = longest_matches(joint, own_slot[np.searchsorted(own, at)], known)
    item_at = np.zeros(size, np.int64)
    item_at[known] = block.item[suffixes]
    return length, item_at[place]


def search(block: TestBlock, column: pa.Array) -> dict[str, list]:
    """What of the block occurs in each text of a shard."""
    words, begins = words_of(column)
    n = len(column)
    n_words = np.diff(begins)
    codes = pc.fill_null(pc.index_in(words, value_set=block.vocabulary), -1).to_numpy(zero_copy_only=False)
    # One gap after each document, and enough of them at the end for any look ahead.
    document = np.repeat(np.arange(n), n_words)
    text = np.full(len(codes) + n + block.widest + KEY_BITS + 1, -1, np.int64)
    text[np.arange(len(codes)) + document] = codes
    first_place = begins[:-1] + np.arange(n)
    gaps = np.flatnonzero(text < 0)
    places = np.flatnonzero(text >= 0)
    run = gaps[np.searchsorted(gaps, places)] - places
    places = places[run >= max(block.shortest, 1)]
    order = suffix_array(text, places, block.widest)

    found: list[tuple[np.ndarray, ...]] = []  # documents, lengths, places and items of matches
    pairs: list[np.ndarray] = []
    edge = np.zeros(len(text) + 1, np.int64)
    active = np.arange(len(block.begin))
    low, high = np.zeros(len(active), np.int64), np.full(len(active), len(order), np.int64)
    for depth in range(block.widest + 1):
        complete = np.flatnonzero(block.window[active] == depth)
        if depth and complete.size:
            # Equal windows have one range: its places are taken once, its documents once for each item.
            suffixes, begin, end = active[complete], low[complete], high[complete]
            first = np.unique(begin, return_index=True)[1]
            ranks, owner = expanded(begin[first], end[first])
            at = order[ranks]
            edge += np.bincount(at, minlength=len(edge)) - np.bincount(at + depth, minlength=len(edge))
            doc = np.searchsorted(first_place, at, side="right") - 1
            length, item = np.full(len(at), depth), block.item[suffixes[first]][owner]
            if depth == block.full_window:
                length, item = _full_matches(block, text, at, suffixes)
            found.append((doc, length, at, item))
            held = np.unique(owner * n + doc)  # window and document
            of_window = np.searchsorted(begin[first], begin)
            wanted = np.unique(of_window * len(block.names) + block.item[suffixes])  # window and item
            window, item = wanted // len(block.names), wanted % len(block.names)
            ranks, owner = expanded(np.searchsorted(held, window * n), np.searchsorted(held, window * n + n))
            pairs.append(np.unique(held[ranks] % n * len(block.names) + item[owner]))
        going = np.flatnonzero(block.window[active] > depth)
        active, low, high = active[going], low[going], high[going]
        word = block.text[block.begin[active] + depth]
        high_, low = lower_bound(text, order, low, high, depth, word + 1), lower_bound(text, order, low, high, depth, word)
        some = np.flatnonzero(low < high_)
        active, low, high = active[some], low[some], high_[some]
        if not active.size:
            break

    longest, where, whose = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    if found:
        doc, length, at, item = map(np.concatenate, zip(*found, strict=True))
        best = np.lexsort((item, at, -length, doc))
        best = best[np.unique(doc[best], return_index=True)[1]]
        longest[doc[best]], where[doc[best]], whose[doc[best]] = length[best], at[best] - first_place[doc[best]], item[best]
    hit = np.cumsum(edge) > 0
    change = np.flatnonzero(np.diff(hit, prepend=False))  # begin and end of each hit passage in turn
    begin, end = change[::2], change[1::2]
    doc = np.searchsorted(first_place, begin, side="right") - 1
    passages: list[list[dict]] = [[] for _ in range(n)]
    for d, b, e in zip(doc.tolist(), begin.tolist(), end.tolist(), strict=True):
        passages[d].append({"begin": b - int(first_place[d]), "end": e - int(first_place[d])})
    items: list[list[str]] = [[] for _ in range(n)]
    for pair in np.unique(np.concatenate(pairs)).tolist() if pairs else []:
        items[pair // len(block.names)].append(block.names[pair % len(block.names)])
    return {
        "n_words": n_words.tolist(),
        "spans": passages,
        "items": items,
        "longest_words": longest.tolist(),
        "longest_begin": [x if x >= 0 else None for x in where.tolist()],
        "longest_item": [block.names[x] if x >= 0 else None for x in whose.tolist()],
    }


def _pass(docs: DataFrame, sent: Broadcast, shard_bytes: int) -> DataFrame:
    """Findings of one block, a row per document: doc_id, text_hash and FOUND."""
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kinds = source.schema
    found_types = T._parse_datatype_string(FOUND)
    out = T.StructType([kinds["doc_id"], kinds["text_hash"], *found_types.fields])
    spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    types = (pa.int64(), spans, pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", shard_bytes):
            found = search(sent.value, batch.column("text"))
            arrays = [pa.array(values, kind) for values, kind in zip(found.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *arrays], names=out.names
            )

    return source.mapInArrow(run, out)


def _blocks(items: DataFrame, block_bytes: int, window: int) -> Iterator[tuple[int, TestBlock]]:
    """The number of blocks and each of them (item, text), one at a time."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for number in range(count):
        rows = sorted(items.where(block == number).distinct().collect(), key=lambda r: (r.item, r.text or ""))
        yield count, TestBlock([r.item for r in rows], [r.text for r in rows], window)


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, spans (words from-to), items (sorted ids as text), and
    the longest verbatim match: longest_words, longest_begin, longest_item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    passes = []
    for count, block in _blocks(items, block_bytes, window):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        found = _pass(docs, sent, shard_bytes)
        if count > 1:  # one block at a time is held by driver and executors
            found = stored(found, "benchmark-pass")
            sent.destroy()
        passes.append(found)
    hits = passes[0] if len(passes) == 1 else _merged(passes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["begin"])
    return hits.withColumn("n_hit", n_hit).withColumn("items", F.array_sort("items"))


def _merged(passes: list[DataFrame]) -> DataFrame:
    """The findings of several passes as one row per document; equal rows come out as often as they went in."""
    rows = reduce(DataFrame.unionByName, passes).groupBy("doc_id", "text_hash")
    best = F.max(F.struct("longest_words", "longest_begin", "longest_item")).alias("best")
    merged = rows.agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("spans").alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        best,
        (F.count("*") / len(passes)).cast("int").alias("copies"),
    )
    joined = F.aggregate(
        F.array_sort(F.flatten("found")),
        F.array().cast(f"array<{SPAN}>"),
        lambda spans, x: F.when(_last_end(spans) >= x["begin"], _widened(spans, x))
        .otherwise(F.concat(spans, F.array(x.cast(SPAN))))
        .cast(f"array<{SPAN}>"),
    )
    return merged.select(
        "doc_id",
        "text_hash",
        "n_words",
        joined.alias("spans"),
        "items",
        *(F.col(f"best.{c}").alias(c) for c in ("longest_words", "longest_begin", "longest_item")),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def _last_end(spans: Column) -> Column:
    return F.try_element_at(spans, F.lit(-1))["end"]


def _widened(spans: Column, x: Column) -> Column:
    """The spans, the last of which now reaches as far as ``x``."""
    begin = F.try_element_at(spans, F.lit(-1))["begin"].alias("begin")
    last = F.struct(begin, F.greatest(_last_end(spans), x["end"]).alias("end")).cast(SPAN)
    return F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), F.array(last))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **parameters: int) -> DataFrame:
    """The documents in which no window of any item occurs, with the columns of ``docs``."""
    affected = benchmark_hits(docs, benchmark, **parameters).where("n_hit > 0")
    affected = affected.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
    own = F.xxhash64("text")
    return docs.join(affected, F.col("doc_id").eqNullSafe(F.col("__doc")) & (own == F.col("__hash")), "left_anti")
