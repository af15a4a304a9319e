import math
import re
from collections import Counter

import numpy as np
import pytest
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from carelens.llm import lexical
from carelens.llm.queries import op11_lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c, sum(c.values())) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, wanted in asked.items():
        found = []
        for doc_id, c, n in counts:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted
                if t in c
            )
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(list(rows), "item_id long, text string").selectExpr(
        "*", "1 AS number", "2 AS size", "'x' AS top", "'y' AS term", "3 AS n"
    )


ITEMS = [
    (1, "the same text here"),
    (2, None),
    (3, ""),
    (4, "İstanbul ß Ω 日本語 end é"),
    (5, "long VERY words-of many, one"),
    (5, "documents share"),
    (None, "a document without an id"),
    (6, "nothing_of this_ occurs xyzzy"),
    (7, "x"),
    (8, "y y y y X"),
]


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("k", [10, 1, 3])
@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_awkward(docs, items, k, block_bytes):
    """Also with items in several blocks."""
    found = lexical.best_documents(docs(AWKWARD), items(ITEMS), k, block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(found) == brute(AWKWARD, ITEMS, k)


def test_ties_over_many_tasks(docs, items, monkeypatch):
    rows = [(i, f"word w{i % 3} word") for i in range(300)] + [(None, "word w1 word")]
    monkeypatch.setattr(lexical, "CELLS", 7)
    monkeypatch.setattr(lexical, "PARTS", 5)
    asked = [(1, "word"), (2, "w1"), (3, "w1 w2 word")]
    found = lexical.best_documents(docs(rows).repartition(40), items(asked), 20)
    assert result(found) == brute(rows, asked, 20)


def test_empty_tables(docs, items):
    assert lexical.best_documents(docs([]), items(ITEMS)).collect() == []
    assert lexical.best_documents(docs(AWKWARD), items([])).collect() == []
    assert lexical.best_documents(docs([(1, None), (2, " ")]), items(ITEMS)).collect() == []
    assert lexical.best_documents(docs([]), items(ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_stay_below_their_bound(items):
    asked = [(i, " ".join(f"t{i}x{j}" for j in range(i % 7 + 1))) for i in range(8)]
    seen = []
    for names, block in lexical.blocks(items(asked), 64):
        number = {r.number: r.item_id for r in names.collect()}
        assert len(number) == 1 or sum(len(t) + 2 for t in block.terms) <= 64
        seen += [(number[i], t.decode()) for t, a, b in zip(block.terms, block.first, block.first[1:], strict=False) for i in block.items[a:b]]
    assert sorted(seen) == sorted((i, t) for i, text in asked for t in set(terms(text)))


def test_a_very_long_text():
    """Every match counts, wherever terms begin, and none is part of a longer word."""
    block = lexical.Block([b"a", b"aa", b"ab"], np.arange(4), np.arange(3), 3)
    n, found, counts = block.count("a aa,ab AB aaa a" * 100_000)
    assert (n, dict(zip(found, counts, strict=True))) == (6 * 100_000 - 99_999, {0: 2, 1: 199_999, 2: 200_000})


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbB1é, \n日_~", max_size=60), st.sets(st.text(alphabet="ab1é日", min_size=1, max_size=3), max_size=8))
def test_counts(text, wanted):
    words = sorted(wanted)
    block = lexical.Block([w.encode() for w in words], np.arange(len(words) + 1), np.arange(len(words)), len(words))
    n, found, counts = block.count(text)
    own = Counter(terms(text))
    assert n == sum(own.values())
    assert {words[i]: c for i, c in zip(found, counts, strict=True)} == {w: own[w] for w in words if w in own}


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    asked = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert result(op11_lexical_search(spark, sf_dir)) == brute(docs, asked)
