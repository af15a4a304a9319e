import zlib

import numpy as np
import pyarrow as pa
import pytest
from awkward import AWKWARD

from carelens.llm import quality, toxicity
from carelens.llm.queries import op5_toxicity, op9_quality
from carelens.llm.store import table

#: Query, label, and the least area under the curve and accuracy. Some 40 of the 97 held-out texts labelled toxic at this
#: scale have no word that marks toxic ones; nothing in a text tells them apart.
CASES = [(op5_toxicity, "toxic", 0.93, 0.945), (op9_quality, "quality", 0.99, 0.98)]


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    values, place = np.unique(np.asarray(scores)[order], return_inverse=True)
    rank = np.zeros(len(scores))
    mean = np.bincount(place, weights=np.arange(1, len(scores) + 1)) / np.bincount(place)
    rank[order] = mean[place]
    ones = np.asarray(labels) == 1
    n = ones.sum()
    return (rank[ones].sum() - n * (n + 1) / 2) / (n * (len(ones) - n))


@pytest.mark.parametrize(("query", "target", "least_area", "least_accuracy"), CASES)
def test_held_out_documents(spark, query, target, least_area, least_accuracy):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[target] for r in table(spark, sf_dir, "labels").collect()}
    rows = query(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    judged = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    scores, known, predicted = map(np.array, zip(*judged, strict=True))
    assert len(judged) > 500 and auc(scores, known) > least_area
    assert (predicted == known).mean() > least_accuracy


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality.quality_scores])
@pytest.mark.parametrize(
    ("marked", "share"),
    [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(None, 1), (99, 0), (1, None), (2, 7)], None), ([(1, 1), (7, 0), (8, 0), (4, 1)], None)],
)
def test_awkward(spark, docs, scores, marked, share):
    labels = spark.createDataFrame(marked, "doc_id long, label int").selectExpr(
        "doc_id", "label AS quality", "label AS toxic", "'x' AS text", "'x' AS held_out"
    )
    rows = scores(docs(AWKWARD), labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (7, 8, 9)}) <= 2  # equal texts, equal scores
    if share is not None:
        assert all(abs(r.score - share) < 1e-6 for r in rows)


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality.quality_scores])
def test_empty_table(spark, docs, scores):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert scores(docs([]), labels).collect() == []


def test_scores_ignore_everything_but_text(spark, docs):
    frame = docs([(i, f"text {i % 3} " * 5) for i in range(30)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(20)], "doc_id long, toxic int").selectExpr("*", "toxic AS quality")
    moved = frame.selectExpr("doc_id", "text", "'other' AS lang", "'other' AS source")
    for scores in (toxicity.toxicity_scores, quality.quality_scores):
        got = {r.doc_id: r.score for r in scores(frame, labels).collect()}
        again = {r.doc_id: r.score for r in scores(moved, labels).collect()}
        assert got == pytest.approx(again)


def test_ngrams_are_distinct_whole_and_apart():
    texts = ["abcde", "", None, "abcdeabcde", "é日x"]
    text, gram = toxicity.features(pa.array(texts))
    per = [set(gram[text == i].tolist()) for i in range(len(texts))]
    assert [len(x) for x in per] == [3 + 2 + 1, 0, 0, 5 * 3, 1]
    assert per[0] < per[3]


def gram_rows(*rows):
    return toxicity.Rows(pa.chunked_array([pa.array([np.array(x, "<i4").tobytes() for x in rows], pa.binary())]))


def test_rows_are_a_matrix(monkeypatch):
    monkeypatch.setattr(toxicity, "PART_ROWS", 2)
    rows = gram_rows([1, 2], [], [2, 5, 7], [1], [])
    weights = np.arange(1 << toxicity.HASH_BITS, dtype=float)
    assert rows.times(weights).tolist() == [3, 0, 14, 1, 0]
    back = rows.transposed_times(np.array([1.0, 2.0, 3.0, 4.0, 5.0]))
    assert {i: v for i, v in enumerate(back) if v} == {1: 5, 2: 4, 5: 3, 7: 3}


def test_log_ratios():
    ratio = toxicity.log_ratios(gram_rows([1, 2], [2, 3]), np.array([1.0, 0.0]))
    assert ratio[1] == pytest.approx(np.log(2)) and ratio[2] == 0 and ratio[3] == pytest.approx(-np.log(2))


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(4)
    count, ones = rng.integers(1, 9, 40), None
    ones = rng.binomial(count, np.clip(np.linspace(0, 1, 40) + rng.normal(0, 0.2, 40), 0, 1))
    knots, levels = quality.isotonic(np.arange(40.0), count, ones)
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    # The minimax form of the same regression.
    total, hits = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(ones))
    mean = lambda a, b: (hits[b + 1] - hits[a]) / (total[b + 1] - total[a])
    exact = [max(min(mean(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.unique(np.round(exact, 12)).tolist() == pytest.approx(levels.tolist())


def test_partition_sums_equal_one_fit(spark, docs):
    """The normal equations do not depend on how rows are dealt to partitions."""
    frame = docs([(i, ("word " if i % 2 else "LOUD!! ") * (i % 9 + 1)) for i in range(120)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    one, many = (quality.fit(quality.with_statistics(frame.repartition(n)), labels) for n in (1, 7))
    rows = quality.statistics(pa.array(["word word", "LOUD!! LOUD!!", ""]))
    assert one.score(rows).tolist() == pytest.approx(many.score(rows).tolist())


def test_rejected_documents_go(spark, docs):
    rows = [(i, ("calm words in a row. " if i % 2 else "LOUD!! ") * (i % 9 + 3)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    kept = quality.good_documents(docs(rows), labels)
    assert kept.columns == docs([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(200) if i % 2]


def test_toxicity_learns_from_one_text_of_an_id(spark, docs, monkeypatch):
    """Also where a sampled id has a third of all rows, or n-grams go beyond their bound; the smallest hash is chosen."""
    ids = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5][:60]
    rows = [(i, f"{'bad words' if i % 2 else 'good things'} of text {i} " * 3) for i in ids]
    hot = [(ids[0], f"another text {n} under one id") for n in range(len(rows))]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    seen, regression = [], toxicity.regression

    def counted(sample, label, *rest):
        seen.append((sample.count, sum(len(grams) for grams, _ in sample.parts) * 4, sorted(label)))
        return regression(sample, label, *rest)

    monkeypatch.setattr(toxicity, "regression", counted)
    scores = [
        sorted((r.doc_id, r.score) for r in toxicity.toxicity_scores(docs(rows + hot).repartition(parts), labels).where(f"doc_id <> {ids[0]}").collect())
        for parts in (1, 9)
    ]
    assert [n for n, _, _ in seen] == [60, 60] and np.allclose([s for _, s in scores[0]], [s for _, s in scores[1]], atol=1e-6)
    assert all((score >= 0.5) == (i % 2 == 1) for i, score in scores[0])
    toxicity.toxicity_scores(docs(rows + hot), labels, training_bytes=10_000).count()
    n, size, label = seen[-1]
    assert 2 < n < 60 and size <= 10_000 and 0 < sum(label) < n


def test_toxicity_regression_is_that_of_a_dense_matrix():
    rng = np.random.default_rng(3)
    width, n = 1 << toxicity.HASH_BITS, 40
    grams = [np.unique(rng.integers(0, 60, rng.integers(3, 20))).astype("<i4") for _ in range(n)]
    label = rng.integers(0, 2, n).astype(float)
    rows = toxicity.Rows(pa.chunked_array([pa.array([g.tobytes() for g in grams], pa.binary())]))
    weights, intercept = toxicity.regression(rows, label, 3000, 1e-3)
    x = np.zeros((n, width))
    for i, g in enumerate(grams):
        x[i, g] = 1
    counts = [x[label == k].sum(axis=0) + 1 for k in (0, 1)]
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    assert np.allclose(toxicity.log_ratios(rows, label), ratio)
    used = np.flatnonzero(x.any(axis=0))
    scaled, own, shift = (x * ratio)[:, used], np.zeros(len(used)), 0.0
    for _ in range(60):  # Newton's method on the same loss
        p = 1 / (1 + np.exp(-(scaled @ own + shift)))
        wide = np.hstack([scaled, np.ones((n, 1))])
        slope = wide.T @ (p - label) / n + 1e-3 * np.append(own, 0)
        curve = wide.T @ (wide * (p * (1 - p))[:, None]) / n + 1e-3 * np.diag(np.append(np.ones(len(own)), 0))
        change = np.linalg.solve(curve, slope)
        own, shift = own - change[:-1], shift - change[-1]
    assert np.allclose(weights[used], own * ratio[used], atol=2e-3) and abs(intercept - shift) < 2e-3
