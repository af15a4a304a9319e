import random
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from carelens.llm import near_copies

VOCABULARY = [f"w{i}" for i in range(5000)]


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def planted(rng, base, wanted):
    """A text whose similarity to the base is hardly more than wanted."""
    words, found = base.split(), base
    for place in rng.sample(range(len(words)), len(words)):
        words[place] = f"x{rng.random()}"
        if similarity(base, " ".join(words)) < wanted:
            return found
        found = " ".join(words)
    return found


def test_planted_near_copies(spark, docs, sf_dir):
    rng = random.Random(1)
    rows, copies = [], []
    for i, wanted in enumerate(np.repeat([0.8, 0.85, 0.9, 0.95], 15).tolist()):
        base = " ".join(rng.choices(VOCABULARY, k=rng.randint(100, 600)))
        near, far = planted(rng, base, wanted), base
        while similarity(base, far) >= 0.8:  # just too far to be a copy
            words = far.split()
            words[rng.randrange(len(words))] = f"y{rng.random()}"
            far = " ".join(words)
        rows += [(3 * i, base), (3 * i + 1, near), (3 * i + 2, far)]
        copies.append(3 * i + 1)
    linked = {b for (a, s), (b, t) in combinations(rows, 2) if similarity(s, t) >= 0.8}
    assert linked >= set(copies)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs(rows), sf_dir).collect()}
    assert kept == {i for i, _ in rows} - linked


def groups(texts):
    """The smallest number of each text's group, by the exact similarity of all pairs."""
    label = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if label[i] != label[j] and similarity(texts[i], texts[j]) >= 0.8:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize("block", [(1024, 1 << 20), (7, 1 << 20), (1024, 1500)])
def test_texts_with_much_in_common(docs, block):
    """A large group of copies and many texts with a common part, in one tile and in many: one of each group stays."""
    rng = random.Random(2)
    part = " ".join(rng.choices(VOCABULARY, k=120))
    alike = [f"{part} " + " ".join(rng.choices(VOCABULARY, k=rng.randint(20, 60))) for _ in range(40)]
    group = [planted(rng, part, 0.93) for _ in range(40)]
    texts = alike + group
    rng.shuffle(texts)
    kept = near_copies.one_per_group(docs(enumerate(texts)), block_texts=block[0], block_shingles=block[1])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups(texts)))


def test_a_chain_is_one_group(docs):
    """Each text is similar to the next one only."""
    words = [f"c{i}" for i in range(240)]
    texts = [" ".join(words[8 * i : 8 * i + 100]) for i in range(12)]
    assert [j for j in range(12) if similarity(texts[0], texts[j]) >= 0.8] == [0, 1]
    assert [r.doc_id for r in near_copies.one_per_group(docs(enumerate(texts))).collect()] == [0]


def alike(count):
    rng = random.Random(3)
    base = rng.choices(VOCABULARY, k=60)
    texts = []
    for i in range(count):
        words = list(base)
        for place in (rng.randrange(8, 18), rng.randrange(24, 34), rng.randrange(40, 50)):  # 15 shingles of 56
            words[place] = f"u{i}x{place}"
        texts.append(" ".join(words))
    return texts


def test_what_travels_grows_with_the_texts_only(docs, monkeypatch):
    """Texts that look alike below 0.8 make as many rows per text when there are twice as many; none of them goes."""
    rows, tiles = [], near_copies.tiles

    def counted(*parts):
        made = tiles(*parts)
        rows.append(made.count())
        return made

    monkeypatch.setattr(near_copies, "tiles", counted)
    for count in (300, 600):
        kept = near_copies.one_per_group(docs(enumerate(alike(count))))
        assert kept.count() == count
    assert rows[1] <= 2.1 * rows[0] <= 2.1 * 300


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40)), min_size=1, max_size=30), st.integers(0, 3), st.integers(1, 80))
def test_shared_counts(sets, step, dense):
    arrays = [np.array(sorted(x), np.uint64) for x in sets]
    left = np.arange(0, len(sets), step + 1)
    right = left if step == 0 else np.setdiff1d(np.arange(len(sets)), left)
    before, near_copies.DENSE = near_copies.DENSE, dense
    try:
        got = near_copies.shared(arrays, left, right)
    finally:
        near_copies.DENSE = before
    assert got.tolist() == [[len(sets[i] & sets[j]) for j in right] for i in left]


def test_ids_do_not_link(docs):
    rows = [(None, "one text without id"), (None, "another of them"), (4, "a text"), (4, "other text"), (5, "A  text"), (None, "a text")]
    kept = sorted(((r.doc_id, r.text) for r in near_copies.one_per_group(docs(rows)).collect()), key=repr)
    assert kept == sorted(rows[:4], key=repr)


def test_awkward(docs):
    kept = [r.doc_id for r in near_copies.one_per_group(docs(AWKWARD)).collect()]
    assert sorted(kept, key=repr) == sorted([1, 4, 5, 6, 7, 9, None, 10, 11, -13], key=repr)
    assert near_copies.one_per_group(docs([])).collect() == []


def test_near_fingerprints_make_a_crowd_without_a_shared_bucket(spark):
    """Texts 0 to 5 step by three bits, 6 has the fingerprint of 0, 7 is four bits from 5; all bands are their own."""
    prints = [0, 0b111, 0b111111, 0b111111111, 7 << 9 | 0b111111111, 7 << 61 | 0b111111111111, 0]
    prints.append(prints[5] ^ 0b1111 << 30)
    rows = [(bytes([i]), int(np.uint64(p).view(np.int64)), [64 * i + j for j in range(64)]) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(rows, "key binary, fingerprint long, bands array<long>")
    found = {r.key[0]: r.root for r in near_copies.crowds(frame).collect()}
    assert set(found) == set(range(7)) and len(set(found.values())) == 1


def test_the_stage_searches_the_fingerprints_of_all_texts(spark, docs, sf_dir, monkeypatch):
    """By five-word shingles, each distinct one once, at a radius of three bits."""
    texts = [None, "", "a b", *(" ".join(random.Random(i).choices(VOCABULARY, k=40)) for i in range(9))]
    asked, links = [], near_copies.simhash.links

    def seen(prints, *rest):
        asked.append(({r.fingerprint for r in prints.collect()}, *rest))
        return links(prints, *rest)

    monkeypatch.setattr(near_copies.simhash, "links", seen)
    assert corpus_pipeline.drop_near_copies(spark, docs([*enumerate(texts), (20, texts[3])]), sf_dir).count() == 11
    wanted = set()
    for text in texts:
        hashed = near_copies.shingles(text).tolist()
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))
        wanted.add(int(np.uint64(bits).view(np.int64)))
    assert asked == [(wanted, 3)]
