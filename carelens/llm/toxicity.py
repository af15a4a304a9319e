"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its lower-cased characters. Each is scaled by the log ratio of how
often it occurs in toxic and in other training texts, and a logistic regression with ridge penalty is learned on
the scaled features. As both are linear, a text's score is one sum of weights over its n-grams.

Ratios and weights are learned from a sample of at most ``TRAINING_ROWS`` labelled rows outside the held-out fold,
as many of either class as there are up to half of that, by the order of a hash of their ids. An id stands for one of its
texts, the one with the smallest hash, and the n-grams of the sample have at most ``TRAINING_BYTES``: rows of a class
beyond its half of that are left out, the last in that order first. So what is learned from is bounded, whatever the tables
hold. The intercept is set for the share of toxic rows among all training rows. Every text is scored whole.

Defined cases. Null and empty texts, and ones shorter than an n-gram, get the score of the intercept. Repeated rows are
scored each. Labels that are null, other than 0 and 1 or without a document are left out. Without training rows of
both classes every score is the share of label 1, 0.5 if there are no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.arrow_text import slices
from carelens.llm.store import held_out, stored

SIZES, HASH_BITS = (3, 4, 5), 18
TRAINING_ROWS, TRAINING_BYTES, ROUNDS, RIDGE, SMOOTHING = 6000, 256 << 20, 80, 1e-4, 1.0
#: Training rows that one step of the arithmetic takes.
PART_ROWS = 128
SHARD_BYTES, SHARD_ROWS = 2 << 20, 1 << 32 - HASH_BITS
THRESHOLD = 0.5
#: Odd multiplier of the rolling hash: a golden ratio of 32 bits.
FACTOR = np.uint32(0x9E3779B1)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text: (text, n-gram) in order, all texts together."""
    texts = [(x or "").lower() for x in column.to_pylist()]
    length = np.array([len(x) for x in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint32), length)
    rolled = np.zeros(len(points), np.uint32)
    found = []
    for size in range(1, max(SIZES) + 1):
        count = len(points) - size + 1
        if count <= 0:
            break
        rolled = (rolled[:count] + points[size - 1 :]) * FACTOR
        rolled ^= rolled >> np.uint32(15)
        if size not in SIZES:
            continue
        gram = (rolled + np.uint32(size)) * FACTOR >> np.uint32(32 - HASH_BITS)
        inside = owner[:count] == owner[size - 1 :]
        found.append((owner[:count] << np.uint32(HASH_BITS) | gram)[inside])
    keys = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint32)
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    return keys >> np.uint32(HASH_BITS), keys & np.uint32((1 << HASH_BITS) - 1)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text and few enough rows that a row and an n-gram fit into 32 bits."""
    for batch in slices(batches, "text", SHARD_BYTES):
        for begin in range(0, batch.num_rows, SHARD_ROWS):
            yield batch.slice(begin, SHARD_ROWS)


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        text, gram = features(column)
        total = np.bincount(text, weights=self.weights[gram], minlength=len(column)) + self.intercept
        return np.round(1 / (1 + np.exp(-np.clip(total, -500, 500))), 9)


def _sample(labels: DataFrame, target: str, rows: int) -> tuple[DataFrame, int, int]:
    """At most ``rows`` training labels, and how many of them there are of label 1 and in all."""
    marked = labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marked = marked.select("doc_id", F.col(target).cast("int").alias("label"))
    ones, count = marked.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = [marked.where(F.col("label") == k).orderBy(*order).limit(rows // 2) for k in (0, 1)]
    return chosen[0].unionByName(chosen[1]), int(ones), int(count)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "toxic",
    training_rows: int = TRAINING_ROWS,
    training_bytes: int = TRAINING_BYTES,
    rounds: int = ROUNDS,
    ridge: float = RIDGE,
) -> Model:
    sample, ones, count = _sample(labels, target, training_rows)
    blank = np.zeros(1 << HASH_BITS)
    if not 0 < ones < count:
        share = ones / count if count else 0.5
        return Model(blank, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches):
            text, gram = features(batch.column("text"))
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            grams = [gram[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("turn"), batch.column("label"), pa.array(grams, pa.binary())], ["turn", "label", "grams"])

    # The sample's ids are at most training_rows numbers; one row of each is kept, before anything is moved.
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    source = chosen.select(F.xxhash64("doc_id").alias("turn"), "label", F.col("first.text").alias("text"))
    found = stored(source.mapInArrow(extract, "turn long, label int, grams binary"), "toxicity-sample")
    rows = _within(found, training_bytes)
    label = rows.column("label").to_numpy().astype(float)
    if not 0 < label.sum() < len(label):
        share = ones / count
        return Model(blank, float(np.log(share / (1 - share))))
    weights, intercept = regression(Rows(rows.column("grams")), label, rounds, ridge)
    odds = np.log(ones / (count - ones)) - np.log(label.sum() / (len(label) - label.sum()))
    return Model(weights, float(intercept + odds))


def _within(found: DataFrame, most: int) -> pa.Table:
    """The rows of either class that fit into half of the bytes, in the order of their turn."""
    sizes = found.select("label", "turn", F.octet_length("grams").alias("size")).toArrow().to_pandas()  # a number a row
    sizes = sizes.sort_values(["label", "turn"])
    fits = sizes.groupby("label")["size"].cumsum() <= most // 2
    last = {int(label): int(turn) for label, turn in sizes[fits].groupby("label")["turn"].max().items()}
    inside = [(F.col("label") == label) & (F.col("turn") <= turn) for label, turn in last.items()]
    return found.where(reduce(lambda a, b: a | b, inside, F.lit(False))).orderBy("label", "turn").select("label", "grams").toArrow()


class Rows:
    """The training rows' n-grams as a sparse matrix of ones, worked on a few rows at a time."""

    def __init__(self, grams: pa.ChunkedArray) -> None:
        self.count, self.parts = len(grams), []
        for begin in range(0, len(grams), PART_ROWS):
            own = [np.frombuffer(x.as_buffer(), "<i4") for x in grams.slice(begin, PART_ROWS)]
            self.parts.append((np.concatenate(own), np.array([len(x) for x in own])))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Per row, the sum of its n-grams' weights."""
        totals = []
        for grams, sizes in self.parts:
            running = np.append(0.0, np.cumsum(weights[grams]))
            ends = np.cumsum(sizes)
            totals.append(running[ends] - running[ends - sizes])
        return np.concatenate(totals)

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        """Per n-gram, the sum of its rows' values."""
        total, at = np.zeros(1 << HASH_BITS), 0
        for grams, sizes in self.parts:
            own = values[at : at + len(sizes)]
            total += np.bincount(grams, weights=np.repeat(own, sizes), minlength=1 << HASH_BITS)
            at += len(sizes)
        return total


def log_ratios(rows: Rows, label: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Naive Bayes log-count ratio of every n-gram."""
    other, toxic = (rows.transposed_times((label == k).astype(float)) + smoothing for k in (0, 1))
    return np.log(toxic / toxic.sum()) - np.log(other / other.sum())


def regression(rows: Rows, label: np.ndarray, rounds: int, ridge: float) -> tuple[np.ndarray, float]:
    """Weights of the n-grams and the intercept, by accelerated gradient descent on the log loss."""
    ratio = log_ratios(rows, label)
    # A step of one over the largest curvature, which a power iteration finds.
    probe, curvature = np.ones(1 << HASH_BITS) / np.sqrt(1 << HASH_BITS), 1.0
    for _ in range(5):
        probe = rows.transposed_times(rows.times(probe * ratio)) * ratio / rows.count
        curvature = np.linalg.norm(probe)
        probe /= max(curvature, 1e-12)
    step = 1 / (curvature / 4 * 1.2 + 0.25 + ridge)
    weights, momentum = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    intercept = shift = 0.0
    for turn in range(rounds):
        odds = rows.times(momentum * ratio) + shift
        error = (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - label) / rows.count
        new = momentum - step * (rows.transposed_times(error) * ratio + ridge * momentum)
        new_intercept = shift - step * error.sum()
        pace = turn / (turn + 3)
        momentum, shift = new + pace * (new - weights), new_intercept + pace * (new_intercept - intercept)
        weights, intercept = new, new_intercept
    return weights * ratio, intercept


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches):
            scores = sent.value.score(batch.column("text"))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores)]
            columns.append(pa.array((scores >= threshold).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    source = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    doc_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {doc_type}, held_out boolean, score double, predicted int")


def toxicity_scores(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Fit on the labelled documents and score all."""
    return score(docs, fit(docs, labels, **parameters))
