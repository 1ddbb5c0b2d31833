"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered 0 < 1 < ... < G - 1. One weight vector over hashed text
features gives a text its score s, and ordered thresholds t turn the score into
grade probabilities: P(grade <= g) = sigmoid(t[g] - s). The expected grade ranks
texts; the tail probability P(grade >= g) selects them.

Features of a text, hashed into ``DIMENSIONS`` slots: its words, the prefixes
of its words of 4 to 8 bytes, words equal to the one before, and the shapes of
its blank-separated tokens.
Their values are log(1 + SCALE * count / words), so neither long nor short
texts stand out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tessera.llm._spark import in_tasks
from tessera.llm._text import ALNUM, LOWER, NONBLANK, find_words, mix, segment_hashes, text_chunks

DIMENSIONS = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)
SCALE = 100.0

#: Shape classes of bytes: lower case and non-ASCII, upper case, digits; other marks stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_REPEATED = np.uint64(0xD0B1E)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def _values(count: np.ndarray, words: np.ndarray | int) -> np.ndarray:
    return np.log1p(SCALE * count / np.maximum(1, words)).astype(np.float32)


def _counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, slot, count) of the features of a run of texts, by doc and slot; words of each text."""
    lower = LOWER[data]
    keys = []
    starts, ends, first = find_words(lower, offsets, ALNUM)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = np.diff(first)
    keys.append((doc, segment_hashes(lower, starts, ends)))
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (keys[0][1][1:] == keys[0][1][:-1]) & (doc[1:] == doc[:-1])
    keys.append((doc[again], np.full(int(again.sum()), _REPEATED)))
    for p in PREFIXES:
        long = ends - starts > p
        keys.append((doc[long], segment_hashes(lower, starts[long], starts[long] + p) ^ np.uint64(p)))
    starts, ends, first = find_words(data, offsets, NONBLANK)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = np.maximum(words, np.diff(first))
    shape = np.zeros(len(starts), dtype=np.uint64)
    for k in range(3):  # the last three bytes and the first one
        shape = shape * np.uint64(256) + _SHAPE[data[np.maximum(starts, ends - 1 - k)]]
    shape = shape * np.uint64(256) + _SHAPE[data[starts]]
    keys.append((doc, mix(shape + np.uint64(0x5EED))))
    packed = np.concatenate([(d.astype(np.int64) << 20) | (h & np.uint64(DIMENSIONS - 1)).astype(np.int64) for d, h in keys])
    packed, count = np.unique(packed, return_counts=True)
    return packed >> 20, (packed & (DIMENSIONS - 1)).astype(np.int32), count, words


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(slots: list[np.ndarray], values: list[np.ndarray], grade: np.ndarray, grades: int, *,
          epochs: int = 15, batch: int = 64, rate: float = 0.1, l2: float = 3e-3, least_docs: int = 6) -> Model:
    """Maximum likelihood by mini-batch AdaGrad; slots that fewer than ``least_docs`` texts hold get no weight."""
    weights = np.zeros(DIMENSIONS, dtype=np.float32)
    seen = np.bincount(grade, minlength=grades) + 1.0
    below = np.cumsum(seen)[:-1] / seen.sum()
    cut = np.log(below / (1 - below))
    if not len(grade):
        return Model(weights, cut)
    held = np.zeros(DIMENSIONS, dtype=np.int32)
    for s in slots:
        held[s] += 1
    useful = held >= least_docs
    slots, values = zip(*[(s[useful[s]], v[useful[s]]) for s, v in zip(slots, values, strict=True)], strict=True)
    square = np.full(DIMENSIONS, 1e-6, dtype=np.float32)
    square_cut = np.full(grades - 1, 1e-6)
    order = np.random.default_rng(7)
    balance = (seen.sum() / seen) ** 0.5
    balance /= (balance[grade]).mean()
    for _ in range(epochs):
        shuffled = order.permutation(len(grade))
        for lo in range(0, len(shuffled), batch):
            at = shuffled[lo: lo + batch]
            size = [len(slots[i]) for i in at]
            slot = np.concatenate([slots[i] for i in at])
            value = np.concatenate([values[i] for i in at])
            row = np.repeat(np.arange(len(at)), size)
            score = np.bincount(row, weights=weights[slot] * value, minlength=len(at))
            g = grade[at]
            full = np.concatenate([[-np.inf], cut, [np.inf]])
            upper, lower = _sigmoid(full[g + 1] - score), _sigmoid(full[g] - score)
            w = balance[g]
            slope = (upper + lower - 1) * w  # of the log likelihood, in the score
            used, inverse = np.unique(slot, return_inverse=True)
            grad = np.bincount(inverse, weights=slope[row] * value).astype(np.float32) / len(at) - l2 * weights[used]
            square[used] += grad * grad
            weights[used] += rate * grad / np.sqrt(square[used])
            share = np.maximum(upper - lower, 1e-9)
            up = np.where(g < grades - 1, upper * (1 - upper) / share, 0) * w
            down = np.where(g > 0, -lower * (1 - lower) / share, 0) * w
            grad_cut = np.array([up[g == k].sum() + down[g == k + 1].sum() for k in range(grades - 1)]) / len(at)
            square_cut += grad_cut * grad_cut
            cut = np.maximum.accumulate(cut + rate * grad_cut / np.sqrt(square_cut) + np.arange(grades - 1) * 1e-6)
    return Model(weights, cut)


def fit(docs: DataFrame, marks: DataFrame, grades: int, *, sample: int = 8000, **options) -> Model:
    """A model of the texts of ``docs`` (doc_id, text) rated by ``marks`` (doc_id, grade).

    Fitted on at most ``sample`` of the ratings, those with the smallest hashes;
    a rating without a document, an id or a grade is left out, a null text
    counts as empty. The bounded sample of ratings is broadcast to the
    documents, features are extracted where they are and one task fits them.
    """
    picked = marks.filter("doc_id is not null and grade is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade")).withColumn(
        "h", F.xxhash64("doc_id", "grade")).orderBy("h", "doc_id", "grade").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(picked), "doc_id")

    def compute(batches):
        for batch in batches:
            slots, counts, words = [], [], []
            for _, offsets, data in text_chunks(batch.column("text")):
                doc, slot, count, size = _counts(data, offsets)
                cuts = np.searchsorted(doc, np.arange(1, len(offsets) - 1))
                slots += [s.tobytes() for s in np.split(slot, cuts)]
                counts += [c.astype(np.uint32).tobytes() for c in np.split(count, cuts)]
                words += size.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("grade"), pa.array(slots, pa.binary()), pa.array(counts, pa.binary()),
                 pa.array(words, pa.int64())], names=["h", "grade", "slots", "counts", "words"])

    def learn(batches):
        got = sorted((tuple(r.values()) for batch in batches for r in batch.to_pylist()), key=lambda r: r[:3])
        m = _train_lists(got, grades, options)
        yield pa.RecordBatch.from_arrays([pa.array([m.weights.tobytes()], pa.binary()), pa.array([m.thresholds.tolist()])],
                                         names=["weights", "thresholds"])

    features = rows.select("text", "grade", "h").transform(
        in_tasks, compute, "h long, grade int, slots binary, counts binary, words long")
    # Repeated documents repeat their ratings: each task cuts to the bound before one task gets the rest.
    bounded = features.orderBy("h", "grade", "slots", "counts").limit(sample)
    fitted = bounded.repartition(1).transform(in_tasks, learn, "weights binary, thresholds array<double>").first()
    if fitted is None:
        return _train_lists([], grades, options)
    return Model(np.frombuffer(fitted.weights, dtype=np.float32), np.array(fitted.thresholds))


def _train_lists(rows: list[tuple], grades: int, options: dict) -> Model:
    """``train`` on (hash, grade, slots, counts, words) rows."""
    return train([np.frombuffer(r[2], dtype=np.int32) for r in rows],
                 [_values(np.frombuffer(r[3], dtype=np.uint32), r[4]) for r in rows],
                 np.array([r[1] for r in rows], dtype=np.int64), grades, **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail`` added: tail[g] = P(grade > g).

    Scores every row from its whole ``text``; a null text is scored as an empty
    one, which has no features and so gets the thresholds' own probabilities.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.drop("expected_grade", "tail").schema.add("expected_grade", DoubleType()).add(
        "tail", ArrayType(DoubleType()))

    def compute(batches):
        m = shared.value
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for row, offsets, data in text_chunks(batch.column("text").cast(pa.string())):
                doc, slot, count, words = _counts(data, offsets)
                n = len(offsets) - 1
                s[row: row + n] = np.bincount(doc, weights=m.weights[slot] * _values(count, words[doc]), minlength=n)
            tail = 1 - _sigmoid(m.thresholds[None, :] - s[:, None])
            at = np.arange(0, tail.size + 1, tail.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tail.sum(axis=1)), pa.ListArray.from_arrays(pa.array(at), pa.array(tail.ravel()))],
                names=[*batch.schema.names, "expected_grade", "tail"])

    return docs.drop("expected_grade", "tail").transform(in_tasks, compute, schema)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of labels: 0 toxic, 1 of low quality, 2 good; incomplete labels are left out."""
    return labels.filter("doc_id is not null and quality is not null and toxic is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, *, least: float = 0.5, **options) -> DataFrame:
    """``docs`` with expected_grade, p_good and keep (p_good >= ``least``) added.

    The model is fitted on the labelled documents (see ``fit`` for the bound)
    and applied to every row. With no labelled document all rows get the prior
    of equal grades (p_good 1/3) and are not kept. Columns of the same names
    are replaced; other columns pass through.
    """
    model = fit(docs, graded(labels), 3, **options)
    out = score(docs.drop("p_good", "keep"), model)
    return out.withColumn("p_good", F.expr("tail[1]")).withColumn("keep", F.col("p_good") >= least).drop("tail")
