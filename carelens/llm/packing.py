"""Documents as token sequences, packed by best fit and a swap-based local search.

Tokenizing is one pass; its pieces are stored. A piece of full length is a sequence of its own. The others are dealt
at random into pools of about ``POOL`` pieces, and each pool is packed in one task: best fit with decreasing lengths
first, then a local search that moves documents and exchanges one for one and two for one between underfull bins,
always to a larger sum of squared fills, so that the emptiest bins drain into the others. It ends when the free space
left is less than one bin (no packing is smaller), or when no exchange helps. What is in the emptiest bins of all pools is
then dealt into fewer pools and packed once more, until one pool is left or the rest does not shrink.

Ids are those of the given tokenizer file. If it holds plain byte-level BPE, texts of Latin letters, digits and common
signs are encoded with its vocabulary by a quicker encoder, each distinct word once per worker as long as it is
remembered; all other texts, and ones with a run of ``RUN`` white-space characters, go to the tokenizer whole. Either
way the ids are the tokenizer's.

Defined cases. A null text is empty: the closing id alone. Rows that share a doc_id are packed each. Ties are broken
by place. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.store import stored

SEQUENCE_TOKENS, CLOSING_ID = 1024, 2
TOKENIZER = "byte_bpe_50k.json"
#: Pieces packed in one task, and the share of a bin that is free in those packed once more, as a divisor.
POOL, EMPTY = 4096, 4
#: Words a worker remembers the ids of, twice over.
REMEMBERED = 300_000

# Fixed value: how byte-level BPE splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that the quick encoder is given in one run at most: its pattern takes a place on a stack of a million for each.
RUN = 1 << 16
LONG_RUN = re.compile(f"[\t\n\r ]{{{RUN}}}")
#: Characters that every library puts into the same class: up to U+024F, no control characters but white space.
PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder(dict):
    """Text to ids as little-endian unsigned 32-bit numbers; as a dict, the ids of a word after a space."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.quick = self._quick(path)
        self.marks = {mark: self._short(mark) for mark in ".,"} if self.quick else {}

    @staticmethod
    def _quick(path: str):
        """A faster encoder with the same vocabulary, if the file describes plain byte-level BPE."""
        import tiktoken

        told = json.loads(Path(path).read_text(encoding="utf-8"))
        model, split = told["model"], told["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not told["normalizer"] and not model["dropout"] and not model["ignore_merges"]
        plain &= split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        pairs = (x if isinstance(x, list) else x.split(" ") for x in model["merges"])
        made = [model["vocab"]["".join(pair)] for pair in pairs]
        if not plain or made != sorted(made):  # ids must also tell the order of merges
            return None
        byte = byte_alphabet()
        known = set(made)
        pieces = {x: i for x, i in model["vocab"].items() if i in known or (len(x) == 1 and x in byte)}
        ranks = {bytes(byte[c] for c in x): i for x, i in pieces.items()}
        return tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:  # the words met lately stay at hand
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            mark = self.marks.get(word[-1:])
            # A sign after a letter is split off anyway; the word alone is more likely known.
            ids = self[word[:-1]] + mark if mark and word[-2:-1].isalpha() else self._short(" " + word)
        self[word] = ids
        return ids

    def _short(self, text: str) -> bytes:
        return array("I", self.quick.encode_ordinary(text)).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self.quick or not PLAIN.fullmatch(text) or any(x in text for x in self.special):
            return self.whole(text)
        if len(text) >= RUN and LONG_RUN.search(text):
            return self.whole(text)
        # A space between two other characters always begins a word, so what it divides is encoded apart.
        if any(x in text for x in ("  ", " \n", "\n ", "\t", "\r")) or text[:1] == " " or text[-1:] == " ":
            return self._short(text)
        first, *words = text.split(" ")
        return b"".join([self._short(first), *[self[word] for word in words]])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    closing_id: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces: doc_id, piece, start, length, ids_crc32, slot (a number of its own), and ids on demand.

    ``tokenizer`` is a file that every worker has; by default the one that its tokenizer package names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or tokenizer_path()).encode
        closing = closing_id.to_bytes(4, "little")
        slot = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows = []
            for row, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "") + closing
                for number, (begin, end) in enumerate(cuts(len(ids) // 4, sequence_tokens)):
                    own = ids[4 * begin : 4 * end]
                    rows.append((row, number, begin, end - begin, zlib.crc32(own), slot, own if with_ids else b""))
                    slot += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [batch.column("doc_id").take(pa.array(columns[0], pa.int64()))]
            arrays += [pa.array(x, kind) for x, kind in zip(columns[1:], types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays[: 6 + with_ids], names=names[: 6 + with_ids])

    source = docs.select("doc_id", "text")
    doc_type = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot", "ids"]
    schema = f"doc_id {doc_type}, piece int, start long, length long, ids_crc32 long, slot long"
    return source.mapInArrow(run, schema + ", ids binary" * with_ids)


def cuts(length: int, most: int) -> list[tuple[int, int]]:
    """From-to of each piece; what doesn't fill a piece comes first."""
    head = length % most or most
    if length <= most:
        return [(0, length)]
    return [(0, head), *((at, at + most) for at in range(head, length, most))]


class Bins:
    """Bins of one pool: the pieces in each, and the free space of each."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.members: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the bin whose space it leaves smallest."""
        by_space: dict[int, list[int]] = {}
        spaces: list[int] = []
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            length = self.lengths[item]
            at = bisect_left(spaces, length)
            if at == len(spaces):
                bin_, space = len(self.members), self.capacity
                self.members.append([])
                self.free.append(space)
            else:
                space = spaces[at]
                bin_ = by_space[space].pop()
                if not by_space[space]:
                    del by_space[space], spaces[at]
            self.members[bin_].append(item)
            self.free[bin_] = space - length
            if self.free[bin_]:
                if self.free[bin_] not in by_space:
                    by_space[self.free[bin_]] = []
                    insort(spaces, self.free[bin_])
                by_space[self.free[bin_]].append(bin_)

    def drain(self) -> None:
        """Local search between underfull bins, from the emptiest on, until no exchange helps or none can save a bin.

        It ends, as the sum of squared fills grows with every exchange. A bin that had nothing to give is asked again when it
        has changed, or something of it fits into a bin that has; and all are once more, until none of them has anything.
        Pieces and bins are arrays that an exchange changes in a few
        places, so a step costs a look at the pieces of underfull bins and no more.
        """
        if not self.members:
            return
        lengths = np.array(self.lengths, np.int64)
        n, bins = len(lengths), len(self.members)
        # What a target may give back: each piece, or nothing (a move), an entry per bin after the pieces.
        holder = np.concatenate([np.zeros(n, np.int64), np.arange(bins)])
        for number, members in enumerate(self.members):
            holder[members] = number
        back = np.append(lengths, np.zeros(bins, np.int64))
        free = np.array(self.free, np.int64)
        least = np.array([lengths[members].min() if members else self.capacity + 1 for members in self.members])
        asked, moved = np.zeros(bins, bool), False
        while True:
            under = (free > 0) & (free < self.capacity)
            if free[under].sum() < self.capacity:
                break
            waiting = np.where(under & ~asked, free, -1)
            source = int(waiting.argmax())
            if waiting[source] < 0:
                if not moved:
                    break
                asked[:], moved = False, False
                continue
            entries = np.flatnonzero(under[holder])
            found = self._best(source, holder[entries], entries, back[entries], free[holder[entries]], free[source])
            if not found:
                asked[source] = True
                continue
            target, given, taken = found
            moved = True
            self._exchange(source, target, given, taken)
            for bin_, items in ((target, given), (source, taken)):
                holder[list(items)] = bin_
            for bin_ in (source, target):
                free[bin_] = self.free[bin_]
                least[bin_] = lengths[self.members[bin_]].min() if self.members[bin_] else self.capacity + 1
            asked &= least > max(free[source], free[target])
            asked[[source, target]] = False

    def _best(self, source: int, holder: np.ndarray, entry: np.ndarray, back: np.ndarray, free: np.ndarray, own_free: int):
        """The exchange or move that fills another bin, at least as full, the most: its bin, what it gets and gives.

        ``entry`` is a piece of the target given back, or beyond the pieces for a move; ``back`` its length, ``free`` the
        target's space. The sum of squared fills grows whenever the fuller of two bins gains.
        """
        own = self.members[source]
        single = [(self.lengths[i], (i,)) for i in own]
        double = [(self.lengths[i] + self.lengths[j], (i, j)) for n, i in enumerate(own) for j in own[:n]]
        offers = sorted(single + double)
        sizes = np.array([size for size, _ in offers])
        at = np.searchsorted(sizes, back + free, side="right") - 1
        gain = np.where(at >= 0, sizes[at] - back, 0)
        gain[(holder == source) | (free > own_free)] = 0
        most = int(np.argmax(gain)) if len(gain) else 0
        if not len(gain) or gain[most] <= 0:
            return None
        piece = int(entry[most])
        return int(holder[most]), offers[at[most]][1], [piece] if piece < len(self.lengths) else []

    def _exchange(self, source: int, target: int, given: tuple[int, ...], taken: list[int]) -> None:
        gain = sum(self.lengths[i] for i in given) - sum(self.lengths[i] for i in taken)
        self.members[source] = [i for i in self.members[source] if i not in given] + taken
        self.members[target] = [i for i in self.members[target] if i not in taken] + list(given)
        self.free[source] += gain
        self.free[target] -= gain


def pack(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece, and its place there."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.drain()
    bin_, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, members in enumerate(bins.members):
        at = 0
        for item in members:
            bin_[item], place[item] = number, at
            at += lengths[item]
    return bin_, place


def packed_sequences(
    docs: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, pool: int = POOL, **parameters
) -> DataFrame:
    """The pieces with sequence_id and offset; parameters as of :func:`pieces`."""
    cut = stored(pieces(docs, sequence_tokens=sequence_tokens, **parameters), "pieces")
    whole = F.col("length") == sequence_tokens
    placed = _placed(cut.where(~whole).select("slot", "length"), sequence_tokens, pool)
    alone = cut.where(whole).select("*", (-1 - F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return cut.where(~whole).join(placed, "slot").unionByName(alone).drop("slot")


def _placed(rest: DataFrame, capacity: int, pool: int) -> DataFrame:
    """slot, sequence_id and offset of the pieces (slot, length)."""
    done, held, count, round_ = [], None, rest.count(), 0
    while True:
        pools = max(1, -(-count // pool))
        packed = stored(_packed(rest, capacity, pools, round_), "packed")
        if held is not None and _sequences(packed) > _sequences(held):
            done.append(held)
            break
        if pools == 1:
            done.append(packed)
            break
        done.append(packed.where("NOT emptiest"))
        held, before = packed.where("emptiest"), count
        rest, count, round_ = held.select("slot", "length"), held.count(), round_ + 1
        if not count or 2 * count > before:
            done.append(held)
            break
    return reduce(DataFrame.unionByName, done).select("slot", "sequence_id", "offset")


def _sequences(packed: DataFrame) -> int:
    return packed.select("sequence_id").distinct().count()


def _packed(rest: DataFrame, capacity: int, pools: int, round_: int) -> DataFrame:
    """Every piece with its sequence and place, and whether that is one of the emptiest."""

    def solve(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("slot")
        number, lengths = ordered.column("pool")[0].as_py(), ordered.column("length").to_numpy()
        bin_, place = pack(lengths.tolist(), capacity)
        free = capacity - np.bincount(bin_, weights=lengths)
        rows = {"slot": ordered.column("slot"), "length": lengths, "sequence_id": (round_ << 56) + (number << 32) + bin_, "offset": place}
        return pa.table(rows | {"emptiest": free[bin_] * EMPTY > capacity})

    dealt = rest.withColumn("pool", F.pmod(F.xxhash64("slot", F.lit(round_)), F.lit(pools)))
    return dealt.groupBy("pool").applyInArrow(solve, "slot long, length long, sequence_id long, offset long, emptiest boolean")
