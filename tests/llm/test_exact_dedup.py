import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from awkward import AWKWARD
from pyspark.sql import functions as F

from carelens.llm import exact_dedup
from carelens.llm.exact_dedup import Directory, TextIndex, exact_copies
from carelens.llm.queries import op12_exact_dedup


def brute(rows):
    """Verdicts; of equal rows one is kept."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((x for x in ids if x is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        copies = Counter(ids)
        out += [(i, keep, len(ids), i == keep and nth == 0, digest) for i in copies for nth in range(copies[i])]
    return sorted(out, key=repr)


def result(frame):
    assert frame.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


MANY = [(i, f"text number {i % 700} " + "x" * (i % 13)) for i in range(1500)] + [(9000 + i, "hot") for i in range(700)]


@pytest.mark.parametrize("batches", [1, 3])
def test_awkward(docs, batches):
    assert result(exact_copies(docs(AWKWARD), batches)) == brute(AWKWARD)


@pytest.mark.parametrize(("batches", "bucket_bytes", "fan_in"), [(1, 1000, 256), (1, 1 << 20, 3), (4, 2000, 256), (3, 700, 2)])
def test_splits_batches_and_a_hot_text(docs, batches, bucket_bytes, fan_in):
    rows = MANY + [(None, "hot"), (None, "hot"), (None, "alone")]
    found = exact_copies(docs(rows).repartition(12), batches, bucket_bytes=bucket_bytes, fan_in=fan_in)
    assert result(found) == brute(rows)


@pytest.mark.parametrize("batches", [1, 3])
@pytest.mark.parametrize("hashed", ["5L", "shiftleft(char_length(coalesce(text, '')) % 4L, 61)"])
def test_collisions_are_chained_and_compared(docs, batches, hashed):
    """Hashes that many texts share: chains keep them apart, and such a bucket is not split for ever."""
    rows = [(i, f"{'ab'[i % 2] * (i % 5)}{i % 17}") for i in range(200)]
    assert result(exact_copies(docs(rows), batches, hashed=F.expr(hashed), bucket_bytes=50)) == brute(rows)


def test_small_memory_for_equal_texts(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COMBINED_BYTES", 1000)
    monkeypatch.setattr(exact_dedup, "PART_BYTES", 300)
    assert result(exact_copies(docs(MANY), bucket_bytes=3000)) == brute(MANY)


def test_a_doubtful_name_is_an_error(docs, monkeypatch):
    """Two texts of one hash and SHA-256 are never taken for equal."""
    rows = docs([(1, "a"), (2, "b")])
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda *_: F.lit("same"))
    with pytest.raises(Exception, match="two different texts have the same hash and SHA-256"):
        exact_copies(rows, hashed=F.lit(1).cast("long")).collect()


def test_empty_table(docs):
    assert result(exact_copies(docs([]))) == []


def test_the_directory_doubles_and_points_to_every_bucket():
    rng = random.Random(1)
    directory, held = Directory(), {}
    for batch in range(4):
        depth = 10
        sizes = {p: rng.randint(1, 50) for p in rng.sample(range(1 << depth), 300)}
        before = set(directory.buckets)
        split = directory.grow(depth, sizes, 500)
        for prefix, size in sizes.items():
            held[prefix] = held.get(prefix, 0) + size
        slots = directory.slots()
        assert len(slots) == 1 << directory.depth == 1 << max(bits for bits, _ in directory.buckets)
        assert set(split) == before - set(directory.buckets)
        assert slots.tolist() == sorted(slots.tolist()) and set(slots.tolist()) == set(range(len(directory.buckets)))
        assert sum(directory.buckets.values()) == sum(held.values())
        assert all(size <= 500 or bits == depth for (bits, _), size in directory.buckets.items())
        for (bits, prefix), parts in split.items():
            assert all(b > bits and p >> (b - bits) == prefix for b, p in parts)
    assert directory.depth > 5


def test_the_index_holds_each_text_once_where_its_key_says(spark, docs, tmp_path):
    index = TextIndex(spark, bucket_bytes=900)
    for part in range(3):
        index.add(docs(r for i, r in enumerate(MANY) if i % 3 == part))
    entries = index.entries().collect()
    assert sorted(e.text for e in entries) == sorted({text for _, text in MANY})
    labels = index.directory.labels()
    assert len(labels) > 8
    for e in entries:
        bits = format(e.hash & (1 << 64) - 1, "064b")
        assert bits.startswith(e.bucket[1:]) and e.bucket in labels
    assert sum(r.n_docs for r in index.tally().collect()) == len(MANY)
    # What was split is gone from the folder.
    folder = Path(index.folder.removeprefix("file:"))
    assert {p.name.removeprefix("bucket=") for p in folder.glob("*/bucket=*")} <= set(labels)
    assert len(list(folder.glob("directory-*"))) == 3


def test_owners_have_ranges_of_keys(docs, spark):
    """Arrivals reach their owners in one exchange of their own; nothing else moves texts."""
    plans = []
    frame = type(docs([]))
    write = frame.mapInArrow

    def seen(self, function, *rest, **named):
        if "_owned" in function.__qualname__:
            plans.append(self._jdf.queryExecution().executedPlan().toString())
        return write(self, function, *rest, **named)

    frame.mapInArrow = seen
    try:
        exact_copies(docs(MANY), bucket_bytes=2000).count()
    finally:
        frame.mapInArrow = write
    assert len(plans) == 1 and plans[0].count("Exchange") == 1


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(op12_exact_dedup(spark, sf_dir)) == brute(rows)
