import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelens.llm import packing
from carelens.llm.queries import op7_packing

PATH = packing.tokenizer_path()
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts, capacity):
    """Pieces hold every document's ids in order, sequences are gapless and not too long; their number."""
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    expected, got = defaultdict(list), defaultdict(list)
    for doc, text in texts:
        own, at, pieces = ids(text), 0, []
        head = len(own) % capacity or capacity
        for number, length in enumerate([head, *[capacity] * ((len(own) - head) // capacity)] if len(own) > capacity else [len(own)]):
            crc = zlib.crc32(np.array(own[at : at + length], "<u4").tobytes())
            pieces.append((number, at, length, crc))
            at += length
        expected[doc] += pieces
    for doc, pieces in by_doc.items():
        got[doc] = [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces]
    assert {d: sorted(p) for d, p in got.items()} == {d: sorted(p) for d, p in expected.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


@pytest.mark.parametrize(("capacity", "pool"), [(1024, 16384), (16, 4)])
def test_awkward(docs, capacity, pool):
    texts = [(d, t if t is None or len(t) < 5000 else t[:9000]) for d, t in AWKWARD]
    rows = packing.packed_sequences(docs(texts), capacity, pool).collect()
    check(rows, texts, capacity)


def test_empty_table(docs):
    assert packing.packed_sequences(docs([])).collect() == []


def test_ids_on_demand(docs):
    rows = packing.packed_sequences(docs([(1, "some words here"), (2, None)]), with_ids=True).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {1: ids("some words here"), 2: [2]}


def test_whole_table(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used, least = check(op7_packing(spark, sf_dir).collect(), texts, 1024)
    assert used <= least * 1.005 + 1


PIECES = [*"abcXYZ019 éß²½\n\t\r.,'!-_$&<|", " ", "\x85", "ɏ", "あ", "’", "'s", "'ll", " word", "word,", "<|endoftext|>", "\x1c"]


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_quick_encoder_is_the_tokenizer(text):
    encoder = packing.encoder(PATH)
    assert encoder.quick and encoder.encode(text) == encoder.whole(text)


@settings(max_examples=1000, deadline=None)
@given(st.text(st.characters(min_codepoint=1, max_codepoint=0x24F), max_size=40))
def test_quick_encoder_on_latin_text(text):
    encoder = packing.encoder(PATH)
    assert encoder.encode(text) == encoder.whole(text)


def test_what_a_worker_remembers_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    encoder = packing.Encoder(PATH)
    for n in range(100):
        text = f"word{n} other{n % 7}, end"
        assert encoder.encode(text) == encoder.whole(text)
        assert len(encoder) <= 12 and len(encoder.older) <= 12


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_bins(lengths):
    bin_, place = packing.pack(lengths, 40)
    for b in set(bin_.tolist()):
        own = sorted((place[i], lengths[i]) for i in np.flatnonzero(bin_ == b))
        ends = np.cumsum([length for _, length in own])
        assert ends[-1] <= 40 and [p for p, _ in own] == [0, *ends[:-1]]
    assert len(bin_) == len(lengths)


def test_local_search_drains_bins_that_best_fit_leaves():
    """One exchange between two other bins makes room for what stands alone."""
    bins = packing.Bins([30, 20, 20, 20, 15, 15], 60)
    bins.best_fit()
    assert len(bins.members) == 3
    bins.drain()
    assert sorted(sorted(bins.lengths[i] for i in m) for m in bins.members if m) == [[15, 15, 30], [20, 20, 20]]


def test_local_search_keeps_all_and_saves_some():
    saved = 0
    random.seed(8)
    for _ in range(300):
        lengths = [random.choice([10, 12, 15, 20, 24, 30, 36]) for _ in range(30)]
        plain = packing.Bins(lengths, 60)
        plain.best_fit()
        before = len(plain.members)
        squares = sum((60 - f) ** 2 for f in plain.free)
        plain.drain()
        assert sum((60 - f) ** 2 for f in plain.free) >= squares
        assert sorted(i for m in plain.members for i in m) == list(range(30))
        assert all(sum(lengths[i] for i in m) == 60 - f for m, f in zip(plain.members, plain.free, strict=True))
        saved += before - sum(bool(m) for m in plain.members)
    assert saved > 0


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n\t\r" * 500_000, " " * 65_535])
def test_long_runs_of_white_space(run):
    encoder = packing.encoder(PATH)
    text = f"before{run}after it"
    assert encoder.encode(text) == encoder.whole(text)


def test_the_search_ends_when_no_exchange_is_left():
    """Also where many bins are half full; no number of exchanges ends it."""
    rng = random.Random(4)
    lengths = [rng.randint(260, 420) for _ in range(1200)]
    bins = packing.Bins(lengths, 1024)
    bins.best_fit()
    first = sum(map(bool, bins.members))
    bins.drain()
    assert sum(map(bool, bins.members)) < 0.94 * first
    assert sorted(i for m in bins.members for i in m) == list(range(len(lengths)))
    assert all(f == 1024 - sum(lengths[i] for i in m) for f, m in zip(bins.free, bins.members, strict=True))
    before = [list(m) for m in bins.members]
    bins.drain()
    assert bins.members == before


def test_the_emptiest_bins_of_all_pools_are_packed_together(spark):
    rng = random.Random(5)
    lengths = [rng.randint(10, 1023) for _ in range(600)]
    rest = spark.createDataFrame(list(enumerate(lengths)), "slot long, length long")
    placed = packing._placed(rest, 1024, 24).collect()
    assert sorted(r.slot for r in placed) == list(range(600))
    sequences = {}
    for r in placed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, lengths[r.slot]))
    for parts in sequences.values():
        ends = [0, *(offset + length for offset, length in sorted(parts))]
        assert [offset for offset, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
    alone = packing._sequences(packing._packed(rest, 1024, 25, 0))
    assert -(-sum(lengths) // 1024) <= len(sequences) < alone
