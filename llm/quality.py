"""Quality classifier learned from trusted positives and unlabelled text.

A linear model of surface features is fitted by minimising the non-negative unbiased risk: with
class prior p, R = p * E+[loss(+)] + max(0, E_u[loss(-)] - p * E+[loss(-)]). The prior is estimated
from the positives and the unlabelled texts: no part of the scores can hold a larger share of the
positives' mass than the unlabelled texts have there, so the smallest ratio of the two bounds the
prior. Negative labels are used for nothing but to leave out ids with contradicting labels.

The fit takes at most ``SAMPLE`` positives and as many unlabelled texts, those with the smallest
hashes of their ids, so its cost does not depend on the size of the corpus. Only rows whose
crc32(id) mod 5 is not 0 are learned from. Every text is scored whole.

Cases: null and empty texts get the score of a text without words; a null id counts as held out;
ids with contradicting labels are no positives; null labels are ignored; one text of an id is learned
from, the smallest; a very long text is one row of features, made of its whole bytes; without positives every
score is 0.5; equal rows get equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import small_batches
from llm.hashing import U64, pieces, word_hashes, words_of

SAMPLE = 6_000
THRESHOLD = 0.3
FOLDS = 5

# Byte classes: one for each ASCII mark, and one each for letters, digits and so on.
LOWER, UPPER, DIGIT, BLANK, LINE, CONTROL, HIGH = range(7)
CLASS = np.full(256, HIGH, dtype=np.uint8)
CLASS[:32] = CONTROL
CLASS[[9, 11, 12, 13, 32]] = BLANK
CLASS[10] = LINE
CLASS[127] = CONTROL
CLASS[48:58] = DIGIT
CLASS[65:91] = UPPER
CLASS[97:123] = LOWER
MARKS = [i for i in range(33, 127) if not chr(i).isalnum()]
CLASS[MARKS] = np.arange(7, 7 + len(MARKS))
CLASSES = 7 + len(MARKS)
# Of a word: kinds of its first and last byte, and its length in three steps.
KIND = np.full(256, 3, dtype=np.int64)
KIND[65:91] = 0
KIND[97:123] = 1
KIND[128:] = 1
KIND[48:58] = 2
SHAPES = 4 * 4 * 3
FEATURES = CLASSES + SHAPES + 4


def features(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of features for each text: shares of byte classes and word shapes, repetition, length."""
    count = len(bounds) - 1
    out = np.zeros((count, FEATURES), dtype=np.float64)
    if not len(raw):
        return out
    size = np.diff(bounds)
    text = np.repeat(np.arange(count), size)
    out[:, :CLASSES] = np.bincount(text * CLASSES + CLASS[raw], minlength=count * CLASSES).reshape(count, -1)
    out[:, :CLASSES] /= np.maximum(size, 1)[:, None]
    starts, ends, offsets = words_of(raw, bounds)
    words = np.diff(offsets)
    some = np.maximum(words, 1)
    owner = np.repeat(np.arange(count), words)
    length = ends - starts
    shape = (KIND[raw[starts]] * 4 + KIND[raw[ends - 1]]) * 3 + np.digitize(length, [2, 8])
    shapes = np.bincount(owner * SHAPES + shape, minlength=count * SHAPES).reshape(count, -1)
    out[:, CLASSES : CLASSES + SHAPES] = shapes / some[:, None]
    hashes = word_hashes(raw, starts, ends)
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    mixed = np.sort((hashes >> U64(24)) | (owner.astype(U64) << U64(40)))
    new = np.concatenate(([True], mixed[1:] != mixed[:-1])) if len(mixed) else np.zeros(0, bool)
    distinct = np.bincount((mixed[new] >> U64(40)).astype(np.int64), minlength=count)
    at = CLASSES + SHAPES
    out[:, :at] = np.sqrt(out[:, :at])
    out[:, at] = np.sqrt(np.bincount(owner, weights=again, minlength=count) / some)
    out[:, at + 1] = np.where(words > 0, distinct / some, 1.0)
    out[:, at + 2] = np.log1p(words)
    out[:, at + 3] = np.bincount(owner, weights=length, minlength=count) / some / 10
    return out


def chunked(column: pa.Array, work: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Apply ``work`` to a column of texts, piece by piece."""
    return np.concatenate([np.zeros((0, width)), *(work(raw, bounds) for _, _, raw, bounds in pieces(column))])


class Model:
    """Standardised linear model with a logistic output."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float):
        self.mean, self.scale, self.weights, self.bias = mean, scale, weights, bias

    def score(self, rows: np.ndarray) -> np.ndarray:
        inner = np.clip((rows - self.mean) / self.scale, -20, 20) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(inner, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk with logistic loss by Adam over all rows.

    Where the part of the risk that stands for negatives falls below zero, its gradient is
    reversed, so that the model does not fit positives among the unlabelled texts as negatives.
    """
    both = np.concatenate((positive, unlabelled))
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-3)
    plus, other = (np.clip((x - mean) / scale, -20, 20) for x in (positive, unlabelled))
    plus, other = (np.hstack((x, np.ones((len(x), 1)))) for x in (plus, other))
    weights = np.zeros(plus.shape[1])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        at_plus, at_other = plus @ weights, other @ weights
        sure_plus, sure_other = (1 / (1 + np.exp(-np.clip(x, -40, 40))) for x in (at_plus, at_other))
        negative = np.logaddexp(0, at_other).mean() - prior * np.logaddexp(0, at_plus).mean()
        as_negative = other.T @ sure_other / len(other) - prior * (plus.T @ sure_plus) / len(plus)
        as_positive = prior * (plus.T @ (sure_plus - 1)) / len(plus)
        gradient = as_positive + as_negative if negative >= 0 else -as_negative
        gradient = gradient + decay * np.append(weights[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.05 * (1 - step / (steps + 1))
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return Model(mean, scale, weights[:-1], float(weights[-1]))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.5) -> float:
    """Share of positives among the unlabelled rows.

    Two halves are scored by the model of the other half. Of all thresholds that keep at least
    ``least`` of the positives, the one with the smallest ratio of unlabelled to positive shares
    gives the estimate. Where there are too few rows for halves, it is one half.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    found = []
    for half in range(2):
        model = fit(positive[1 - half :: 2], unlabelled[1 - half :: 2], 0.5)
        plus, other = np.sort(model.score(positive[half::2])), np.sort(model.score(unlabelled[half::2]))
        steps = plus[: max(1, int(len(plus) * (1 - least)))]
        kept = 1 - np.searchsorted(plus, steps, "left") / len(plus)
        found.append(((1 - np.searchsorted(other, steps, "left") / len(other)) / kept).min())
    return float(np.clip(np.mean(found), 0.01, 0.99))


def fold(column: str = "doc_id") -> F.Column:
    """crc32 of an id's text mod 5; a null id is in fold 0."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit the model on bounded samples; None if there are no positives."""
    trusted = (
        labels.filter("quality is not null and doc_id is not null")
        .filter(fold() != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .filter("least = most")
        .select("doc_id", (F.col("least") == 1).alias("good"))
    )
    lot = F.xxhash64("doc_id")
    plus = trusted.filter("good").select("doc_id").orderBy(lot).limit(sample)
    other = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        .filter(F.col("doc_id").isNotNull() & (fold() != 0))
        .distinct().orderBy(lot).limit(sample)
    )
    chosen = plus.withColumn("plus", F.lit(1)).unionByName(other.withColumn("plus", F.lit(0)))
    # One text for each sampled id, at most 2 * sample in all.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "plus").agg(F.min("text").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = chunked(batch.column("text"), features, FEATURES)
                packed = pa.array([x.tobytes() for x in rows.astype(np.float32)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("plus"), packed], ["plus", "row"])

    rows = texts.mapInArrow(describe, "plus int, row binary").toArrow()
    # In one order whatever the partitions were, so that equal tables give equal models.
    ordered = sorted(zip(rows["plus"].to_pylist(), rows["row"].to_pylist(), strict=True))
    table = np.array([np.frombuffer(x, np.float32) for _, x in ordered], dtype=np.float64)
    marks = np.array([x for x, _ in ordered])
    if not (marks == 1).any() or not (marks == 0).any():
        return None
    positive, unlabelled = table[marks == 1], table[marks == 0]
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All columns of the documents, and held_out, score and predicted for each."""
    small_batches(docs.sparkSession)
    model = train(docs, labels, sample)
    added = "held_out boolean, score double, predicted int"
    taken = [x for x in docs.columns if x.lower() not in ("held_out", "score", "predicted")]
    rows = docs.select(*taken, (fold() == 0).alias("held_out"))
    kept = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.select(*taken).schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                score = chunked(batch.column("text"), lambda r, b: model.score(features(r, b))[:, None], 1)[:, 0]
            columns = [*batch.columns, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "predicted"])

    return rows.mapInArrow(judge, f"{kept}, {added}")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the model accepts, with all their columns."""
    small_batches(docs.sparkSession)
    model = train(docs, labels, sample)
    if model is None:
        return docs

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = chunked(batch.column("text"), lambda r, b: model.score(features(r, b))[:, None], 1)[:, 0]
            yield batch.filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(accept, docs.schema)
