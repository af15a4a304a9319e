import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from awkward import AWKWARD, LONG
from hypothesis import given, settings
from hypothesis import strategies as st

from carelens.llm import decontaminate
from carelens.llm.queries import op2_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, window):
    held = defaultdict(set)
    for item, text in items:
        own = words(text)
        n = min(window, len(own))
        for i in range(len(own) - n + 1) if n else ():
            held[tuple(own[i : i + n])].add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        own = words(text)
        hit, found, longest = [False] * len(own), set(), 0
        for n in {len(x) for x in held}:
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in held:
                    found |= held[tuple(own[i : i + n])]
                    hit[i : i + n] = [True] * n
        for _, item in items:  # runs that hold a window of their item
            run = common(own, words(item))
            longest = max(longest, run if run and run >= min(window, len(words(item))) else 0)
        out.append((doc, len(own), sum(hit), sorted(found), longest))
    return sorted(out, key=repr)


def common(a, b):
    """Length of the longest run of words that both have."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0, *(row[j] + 1 if x == y else 0 for j, y in enumerate(b))]
        best = max(best, *row)
    return best


def result(frame, benchmark, **parameters):
    rows = decontaminate.benchmark_hits(frame, benchmark, **parameters).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.longest_words) for r in rows), key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "1 AS spans")


ITEMS = [
    (1, "one"),
    (2, "very long text that goes on many words"),
    (3, "Text here AND now same"),
    (4, None),
    (5, " .,; "),
    (None, "an id of its own"),
    (7, "日本語"),
    (1, "three documents share"),
]


@pytest.mark.parametrize("window", [3, 10])
def test_awkward(spark, docs, window):
    rows = [(d, t if t != LONG else t[:900]) for d, t in AWKWARD]
    assert result(docs(rows), bench(spark, ITEMS), window=window) == brute(rows, ITEMS, window)


def test_very_long_text_in_small_shards(spark, docs):
    got = result(docs([(7, LONG)]), bench(spark, ITEMS[:3]), shard_bytes=1000)
    assert got[0][:2] == (7, 40001) and got[0][3] == ["1", "2"]


def test_several_passes_find_the_same(spark, docs):
    rows = [(d, t if t != LONG else t[:900]) for d, t in AWKWARD]
    once = result(docs(rows), bench(spark, ITEMS), window=4)
    assert result(docs(rows), bench(spark, ITEMS), window=4, block_bytes=30) == once


def test_empty_tables(spark, docs):
    assert result(docs([]), bench(spark, ITEMS)) == []
    assert [r[2:] for r in result(docs(AWKWARD), bench(spark, []))] == [(0, [], 0)] * len(AWKWARD)


TEXT = st.lists(st.sampled_from(["a", "b", "c", "D", "é"]), max_size=14).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6), st.lists(TEXT, max_size=6), st.integers(1, 5))
def test_search_of_a_shard(texts, items, window):
    rows, numbered = list(enumerate(texts)), list(enumerate(items))
    block = decontaminate.TestBlock([str(i) for i, _ in numbered], items, window)
    found = decontaminate.search(block, pa.array(texts, pa.string()))
    hits = [sum(s["end"] - s["begin"] for s in spans) for spans in found["spans"]]
    got = sorted(zip(range(len(texts)), found["n_words"], hits, map(sorted, found["items"]), found["longest_words"], strict=True), key=repr)
    assert got == brute(rows, numbered, window)


def test_suffix_array_is_sorted():
    text = np.append(np.random.default_rng(1).integers(0, 3, 300), [-1] * 50)
    order = decontaminate.suffix_array(text, np.arange(300), 20)
    heads = [tuple(text[p : p + 20]) for p in order]
    assert heads == sorted(heads) and sorted(order) == list(range(300))


def test_many_different_words():
    """Numbers beyond what three to a key have room for."""
    text = np.append(np.random.default_rng(2).choice([1 << 21, (1 << 21) + 1, 1 << 22], 300), [-1] * 100)
    order = decontaminate.suffix_array(text, np.arange(300), 20)
    heads = [tuple(text[p : p + 20]) for p in order]
    assert heads == sorted(heads) and sorted(order) == list(range(300))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=9), min_size=2, max_size=8), st.data())
def test_longest_matches(passages, data):
    ended = [(*passage, 3 + i) for i, passage in enumerate(passages)]
    text = np.array([word for passage in ended for word in passage])
    known = data.draw(st.lists(st.integers(0, len(text) - 1), min_size=1, unique=True))
    asked = [p for p in range(len(text)) if p not in known]
    length, place = decontaminate.longest_matches(text, np.array(asked, int), np.array(known))

    def alike(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    for p, n, at in zip(asked, length.tolist(), place.tolist(), strict=True):
        assert n == max(alike(p, k) for k in known)
        assert n == 0 or (at in known and alike(p, at) == n)


@pytest.mark.parametrize("period", [1, 7, 10**9])
def test_very_long_item(period):
    """100,000 words, also the same few again and again, in four documents of one shard."""
    item = [f"w{i % period}" for i in range(100_000)]
    texts = [" ".join(["x", *item[:n], "y"]) for n in (100_000, 50_000, 99_999, 100_000)]
    found = decontaminate.search(decontaminate.TestBlock(["a"], [" ".join(item)]), pa.array(texts))
    assert found["longest_words"] == [100_000, 50_000, 99_999, 100_000]
    assert found["longest_begin"] == [1] * 4 and found["items"] == [["a"]] * 4
    assert found["spans"] == [[{"begin": 1, "end": n + 1}] for n in (100_000, 50_000, 99_999, 100_000)]


def test_affected_documents_go(spark, docs):
    rows = [(1, "x a b c d y"), (1, "clean"), (2, "a b c"), (2, "a b c d"), (3, None)]
    kept = decontaminate.without_benchmark(docs(rows), bench(spark, [(1, "A b C d e")]), window=4)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "clean"), (2, "a b c"), (3, None)]
    assert kept.columns == docs([]).columns


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = set()
    held = defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - 9)):
            held[tuple(own[i : i + 10])].add(str(item))
    for doc, text in rows:
        own = words(text)
        at = [i for i in range(len(own) - 9) if tuple(own[i : i + 10]) in held]
        found = sorted(set().union(*(held[tuple(own[i : i + 10])] for i in at)))
        n_hit = len({i + k for i in at for k in range(10)})
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        expected.add((doc, len(own), n_hit, len(found), digest, n_hit > 0))
    got = op2_decontamination(spark, sf_dir)
    assert {tuple(r) for r in got.collect()} == expected
