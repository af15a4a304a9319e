"""Document quality from document statistics: random Fourier features, ridge regression, isotonic calibration.

A text becomes a short vector of statistics (lengths, shares of kinds of characters, repetition). Random Fourier
features of the standardized statistics approximate a Gaussian kernel, so a linear model on them is a kernel model.
Its normal equations are sums over rows: each partition adds up its own and sends one matrix. The raw scores of the
training rows, counted in bins of fixed width, are made monotone by pooling adjacent violators; that maps a raw
score to a probability.

All labelled rows outside the held-out fold are learned from; texts are read once to fit and once to judge.

Defined cases. Null and empty texts have the statistics of an empty text and get its score. Repeated rows count each.
Labels that are null, other than 0 and 1 or without a document are left out. If the training rows don't have both
labels, every score is the share of label 1 among them, 0.5 if there are none. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.arrow_text import slices, sums, utf8
from carelens.llm.decontaminate import words_of
from carelens.llm.store import held_out, stored

FEATURES, KERNEL_WIDTH, RIDGE, SEED = 256, 2.0, 1e-3, 7
SHARD_BYTES = 4 << 20
BIN = 0.001
THRESHOLD = 0.3

KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\x0b\x0c\r",
    "newline": b"\n",
    "stop": b".",
    "shout": b"!?",
    "mark": b",;:'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
}
STATISTICS = 2 + len(KINDS) + 1 + 7


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    data, begins = utf8(column)
    n_bytes = np.diff(begins)
    chars = sums((data & 0xC0) != 0x80, begins)
    words, first = words_of(column)
    n_words = np.diff(first)
    per_char = np.maximum(chars, 1)
    per_word = np.maximum(n_words, 1)
    found = [np.log1p(chars), np.log1p(n_words)]
    counts = {}
    for name, members in KINDS.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        counts[name] = sums(table[data], begins)
        found.append(counts[name] / per_char)
    found.append((n_bytes - chars) / per_char)
    letters = counts["lower"] + counts["upper"]
    code = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(column)), n_words)
    kinds = int(code.max(initial=0)) + 1
    found.append(_distinct(owner, code, kinds, len(column)) / per_word)
    follows = np.flatnonzero(owner[1:] == owner[:-1])
    # Below 2 ** 63: a shard has few texts, and fewer kinds of words than bytes.
    pairs = _distinct(owner[follows], code[follows] * kinds + code[follows + 1], kinds * kinds, len(column))
    found.append(pairs / per_word)
    found.append(counts["upper"] / np.maximum(letters, 1))
    found.append((letters + n_bytes - chars) / per_word)
    found.append(np.log1p(chars / (counts["newline"] + 1)))
    found.append((counts["stop"] + counts["shout"]) / per_word)
    found.append(counts["symbol"] / per_word)
    return np.stack(found, axis=1)


def _distinct(owner: np.ndarray, code: np.ndarray, kinds: int, n: int) -> np.ndarray:
    """How many different codes below ``kinds`` each owner has."""
    keys = np.sort(owner * kinds + code)
    first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    return np.bincount(keys[first] // kinds, minlength=n)


def with_statistics(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out and statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", shard_bytes):
            rows = pa.array(list(statistics(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), rows], ["doc_id", "held_out", "statistics"]
            )

    source = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    doc_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {doc_type}, held_out boolean, statistics array<double>")


@dataclass
class Model:
    """What it takes to score a row of statistics."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant one."""
        turned = np.cos((rows - self.mean) / self.scale @ self.directions + self.phases)
        return np.hstack([turned * np.sqrt(2 / len(self.phases)), np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.features(rows) @ self.weights, -1, 2)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(rows), self.levels[0])
        return np.round(np.interp(self.raw(rows), self.knots, self.levels), 9)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("statistics").flatten()).reshape(batch.num_rows, STATISTICS)


def _summed(rows: DataFrame, of, size: int) -> np.ndarray:
    """The sum of ``of(statistics, labels)`` over all batches; each partition sends one vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += of(_rows(batch), batch.column("label").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    parts = rows.mapInArrow(run, "total binary").rdd.map(lambda row: np.frombuffer(row.total))
    return parts.treeAggregate(np.zeros(size), np.add, np.add)


def fit(
    rows: DataFrame,
    labels: DataFrame,
    target: str = "quality",
    features: int = FEATURES,
    width: float = KERNEL_WIDTH,
    ridge: float = RIDGE,
    seed: int = SEED,
) -> Model:
    """Learn from the rows of :func:`with_statistics` that ``labels`` (doc_id, target) marks."""
    marked = labels.where(F.col(target).isin(0, 1)).select("doc_id", F.col(target).cast("double").alias("label"))
    training = stored(rows.where(~F.col("held_out")).join(marked, "doc_id").select("statistics", "label"), "training")

    moments = _summed(
        training, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)]), 2 + 2 * STATISTICS
    )
    count, ones = moments[:2]
    mean = moments[2 : 2 + STATISTICS] / max(count, 1)
    deviation = np.sqrt(np.maximum(moments[2 + STATISTICS :] / max(count, 1) - mean**2, 0))
    scale = np.where(deviation > 1e-9, deviation, 1)
    random = np.random.default_rng(seed)
    directions = random.normal(size=(STATISTICS, features)) / (width * np.sqrt(STATISTICS))
    model = Model(mean, scale, directions, random.uniform(0, 2 * np.pi, features), np.zeros(0), np.zeros(0), np.zeros(0))
    if not 0 < ones < count:
        model.levels = np.array([ones / count if count else 0.5])
        return model

    wide = features + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    total = _summed(training, equations, wide * wide + wide)
    gram = total[: wide * wide].reshape(wide, wide) + ridge * count * np.diag([1.0] * features + [0.0])
    weights = np.linalg.solve(gram, total[wide * wide :])
    model.weights = weights
    model.knots, model.levels = _calibrated(training, model)
    return model


def _calibrated(training: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of the label on the raw score, over bins of fixed width."""

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.floor((model.raw(x) + 1) / BIN).astype(int)
        return np.concatenate([np.bincount(at, minlength=bins), np.bincount(at, weights=y, minlength=bins)])

    bins = int(3 / BIN) + 2
    count, ones = _summed(training, binned, 2 * bins).reshape(2, bins)
    filled = np.flatnonzero(count)
    return isotonic((filled + 0.5) * BIN - 1, count[filled], ones[filled])


def isotonic(at: np.ndarray, count: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the monotone fit: neighbours that fall are pooled until none does."""
    blocks: list[list[float]] = []  # weight, label sum, place sum
    for x, n, y in zip(at, count, ones, strict=True):
        blocks.append([n, y, x * n])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    table = np.array(blocks)
    return table[:, 2] / table[:, 0], table[:, 1] / table[:, 0]


def score(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of rows with statistics."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.score(_rows(batch))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores)]
            columns.append(pa.array((scores >= threshold).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    doc_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_type}, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Fit on the labelled documents and score all."""
    rows = stored(with_statistics(docs), "statistics")
    return score(rows, fit(rows, labels, **parameters))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **parameters) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns. They are judged where they are read."""
    model = fit(stored(with_statistics(docs), "statistics"), labels, **parameters)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            yield batch.filter(pa.array(sent.value.score(statistics(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
