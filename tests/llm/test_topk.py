import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carelens.llm import topk
from carelens.llm.queries import op10_top_k

NAN, INF = float("nan"), float("inf")


def brute(rows, k=20, step=20):
    whole = {}
    held = []
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            numbers = [math.floor(64 * float(np.float32(x))) for x in vector]
            held.append((vec_id, numbers))
            if vec_id % step == 0 and numbers not in whole.setdefault(vec_id, []):
                whole[vec_id].append(numbers)
    out = []
    most = 2**63 - 1
    for query, asked in whole.items():
        scores = [
            (min(max(sum(a * b for a, b in zip(own, x, strict=False)), -most), most), v)
            for own in asked
            for v, x in held
            if v != query
        ]
        best = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
        out += [(query, rank, v, s) for rank, (s, v) in enumerate(best, 1)]
    return sorted(out)


@pytest.fixture
def vectors(spark):
    def build(rows):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        return frame.selectExpr("*", "1 AS rank", "2 AS score", "3 AS part", "4 AS components")

    return build


def result(frame, **parameters):
    return sorted(tuple(r) for r in topk.search(frame, **parameters).collect())


AWKWARD = [
    *((i, [math.sin(i), math.cos(i), i % 3 / 8]) for i in range(60)),
    *((100 + i, [1.0, 1.0, 1.0]) for i in range(60)),
    (200, None),
    (220, [None, 1.0]),
    (240, [NAN, 1.0]),
    (260, [INF]),
    (280, []),
    (300, [0.5] * 40),
    (320, [-0.001, 0.0, 0.001]),
    (-40, [1.0, 2.0, 3.0]),
    (None, [1.0, 1.0, 1.0]),
    (101, [1.0, 1.0, 1.0]),
]


@pytest.mark.parametrize("k", [20, 1, 500])
def test_awkward(vectors, k):
    assert result(vectors(AWKWARD), k=k) == brute(AWKWARD, k)


def test_small_tiles_and_a_tree_of_merges(vectors, monkeypatch):
    monkeypatch.setattr(topk, "FAN_IN", 2)
    whole = topk.whole_vectors(vectors(AWKWARD).repartition(9))
    rows = topk.top_k(whole, whole.where("vec_id % 20 = 0"), k=7, shard=5, block=2).collect()
    assert sorted(tuple(r) for r in rows) == brute(AWKWARD, 7)


def test_every_vector_of_a_repeated_id_is_asked(vectors):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), *((i, [math.sin(i), math.cos(i)]) for i in range(1, 19))]
    for parts in (1, 7):
        assert result(vectors(rows).repartition(parts), k=9) == brute(rows, 9)
    half = [(40, [float(i % 5), float(i % 7), 1.0]) for i in range(300)] + [(i, [i / 64, 1.0, -1.0]) for i in range(300)]
    assert result(vectors(half)) == brute(half)


def test_what_is_sent_grows_with_the_grid_only(spark, vectors):
    """A shard is sent once for every row of the grid, a block once for every column."""
    rows = [(i, [float(i % 9), 1.0]) for i in range(400)]
    whole = topk.whole_vectors(vectors(rows).repartition(5))
    shards, blocks = topk.packed(whole, 20), topk.packed(whole.repartition(3), 10)
    n_shards, n_blocks = shards.count(), blocks.count()
    tiles = topk.grid(shards.checkpoint(), blocks.checkpoint(), 16)
    sides = [tiles.where(f"side = {side}").groupBy("cell").count().count() for side in (0, 1)]
    edge = -(-n_blocks // 16)
    columns = tiles.where("side = 0").count() // n_blocks
    assert tiles.where("side = 1").count() == n_shards * edge and edge < n_blocks / 8
    assert tiles.where("side = 0").count() == n_blocks * columns and max(sides) <= edge * columns
    got = topk.top_k(whole, whole.where("vec_id % 20 = 0"), k=5, shard=20, block=3, cell_blocks=2)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_huge_components(vectors):
    rows = [(0, [3e38, 1.0]), (1, [3e38, 2.0]), (2, [-3e38, 1.0]), (20, [1e6, 1e6]), (3, [4e5, -7e5]), (4, [1e12, 1.0])]
    assert result(vectors(rows)) == brute(rows)


def test_empty_table(vectors):
    assert result(vectors([])) == []


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op10_top_k(spark, sf_dir).collect()) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(-3, 3)), max_size=40), st.integers(1, 12))
def test_partial_selection(pairs, k):
    ids, scores = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
    got = [x.tolist() for x in topk.best(ids, scores, k)]
    best = sorted(pairs, key=lambda p: (-p[1], p[0]))[:k]
    assert list(zip(*got, strict=True)) == best
