import random
import re

import numpy as np
import pytest
import xxhash
from awkward import AWKWARD

from carelens.llm import simhash
from carelens.llm.components import components
from carelens.llm.queries import op6_simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(numbers, linked):
    """The smallest member of each number's group, by walking all links."""
    root = {}
    for start in sorted(set(numbers)):
        if start in root:
            continue
        root[start], todo = start, [start]
        while todo:
            at = todo.pop()
            for other in linked(at):
                if other not in root:
                    root[other] = start
                    todo.append(other)
    return root


def near(numbers, bits=2):
    known = np.array(sorted(set(numbers)), np.uint64)
    return lambda x: known[np.bitwise_count(known ^ np.uint64(x)) <= bits].tolist()


def brute(rows):
    prints = [brute_print(text) for _, text in rows]
    root = grouped(prints, near(prints))
    first = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            first[root[p]] = min(first.get(root[p], doc), doc)
    return sorted(((d, f"{p:016x}", first.get(root[p])) for (d, _), p in zip(rows, prints, strict=True)), key=repr)


def test_awkward(docs):
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs(AWKWARD)).collect()), key=repr)
    assert got == brute(AWKWARD)


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.one_per_group(docs([])).collect() == []


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op6_simhash(spark, sf_dir).collect()), key=repr) == brute(rows)


def linked_roots(spark, numbers, **parameters):
    signed = np.array(sorted(set(numbers)), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    edges = simhash.links(frame, **parameters)
    found = {r.vertex: r.root for r in components(edges).collect()}
    mask = (1 << 64) - 1
    groups = {}
    for x in signed:
        groups.setdefault(found.get(x, x), set()).add(x & mask)
    return sorted(map(sorted, groups.values()))


def expected_roots(numbers, bits):
    groups = {}
    for x, r in grouped(numbers, near(numbers, bits)).items():
        groups.setdefault(r, set()).add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_of_near_and_far_prints(spark, bits):
    random.seed(bits)
    numbers = [random.getrandbits(64) for _ in range(60)]
    for x in list(numbers):
        for distance in (1, 2, 3, 4):
            numbers.append(x ^ sum(1 << b for b in random.sample(range(64), distance)))
    assert linked_roots(spark, numbers, max_bits=bits) == expected_roots(numbers, bits)


def test_crowded_buckets_are_refined_without_losing_links(spark):
    """All around one print, so nearly all share their buckets, and buckets may hold 8 only."""
    random.seed(5)
    numbers = {sum(1 << b for b in random.sample(range(64), random.randint(3, 9))) for _ in range(700)}
    assert linked_roots(spark, numbers, bucket_size=8) == expected_roots(numbers, 2)


def test_chain_passes_every_close_pair_and_few_others():
    random.seed(2)
    free = tuple(range(64))
    close = np.array([sum(1 << b for b in random.sample(range(64), n)) for n in (1, 2) for _ in range(500)], np.uint64)
    assert simhash.has_chain(close, free, 2).all()
    far = np.array([sum(1 << b for b in random.sample(range(64), 30)) for _ in range(500)], np.uint64)
    assert not simhash.has_chain(far, free, 2).any()


def test_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, x) for x in range(101, 160)] + [(200, 100)]
    ring = [(300 + i, 300 + (i * 7 + 1) % 31) for i in range(31)]
    edges = spark.createDataFrame(path + star + ring + [(5, 5)], "a long, b long")
    root = {r.vertex: r.root for r in components(edges).collect()}
    both = path + star + ring
    linked = lambda x: [b for a, b in both if a == x] + [a for a, b in both if b == x]
    vertices = {x for a, b in both for x in (a, b) if a != b}
    assert root == grouped(vertices, linked)


def test_one_document_of_each_group(docs):
    rows = [*AWKWARD, (20, "a b c d e f g"), (21, "A b c d e f g"), (22, "something else altogether is here")]
    kept = simhash.one_per_group(docs(rows))
    expected = {d for d, _, c in brute(rows) if d == c}
    assert sorted(kept.columns) == sorted(docs([]).columns)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_different_texts_without_or_under_one_id_stay(docs):
    """Rows of one id, or none, stay unless their own text has a copy."""
    rows = [
        (None, "apples and pears are sold here today"),
        (None, "seven ships went out and none came back"),
        (None, "a copy of what has a number of its own"),
        (3, "a copy of what has a number of its own"),
        (5, "a copy of what has a number of its own"),
        (5, "nobody else holds this text under any id"),
        (6, "first of two texts that share one id"),
        (6, "the other one is not like it at all"),
    ]
    kept = [(r.doc_id, r.text) for r in simhash.one_per_group(docs(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([x for i, x in enumerate(rows) if i not in (2, 4)], key=repr)
