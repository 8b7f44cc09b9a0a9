"""Quality grades by ordinal regression on hashed text.

Cumulative-link model: P(grade <= k) = logistic(threshold_k - w.x) with one weight vector for
all grades and ordered thresholds. x holds, for each word of a text, its hash, its shape, and
whether it repeats the word before or lies in a window that the text repeats, each divided by the square
root of the number of words. From the model follow the expected grade and the probability
of a grade or better, which selects documents.

The fit uses at most ``FIT_ROWS`` graded documents, those of lowest hash of the id. Their
features meet in one task, bounded by that number, which returns weights of fixed size. All
texts are scored whole, in one pass without a shuffle.

Defined cases: null, empty and wordless texts have no feature and get the grades' base rates;
equal texts get equal grades; null grades are not used, the lowest of several grades of an id counts;
without graded rows all probabilities are those of equal grades; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .repetition_rules import covered, repeated
from .words import roll, slices, split_words, word_hashes

_U = np.uint64
FIT_ROWS = 20_000
WORD_BITS = 16
SHAPES = 1 << 10
SIZE = (1 << WORD_BITS) + SHAPES
STEPS, RATE, RIDGE = 150, 0.5, 1e-4
WINDOW = 5

_CLASS = np.zeros(256, np.int64)  # of a byte: 0 other sign, 1 lower, 2 upper, 3 digit, 4 beyond ASCII, 5 full stop or comma
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
_CLASS[list(b".,;:?")] = 5


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the weights, value) of every feature."""
    words = split_words(column)
    n = np.bincount(words.doc, minlength=words.n_docs)
    hashes = word_hashes(words, lower=True)
    value = 1 / np.sqrt(n[words.doc])
    first, last = _CLASS[words.data[words.start]], _CLASS[words.data[words.end - 1]]
    middle = _CLASS[words.data[(words.start + words.end) // 2]]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    inside = np.zeros(len(hashes), bool)
    for k, at, keys in roll(hashes, words.doc, [WINDOW]):
        twice, _ = repeated(keys, words.doc[at])
        inside = covered(at[twice], k, len(hashes))
    shape = ((first * 6 + middle) * 6 + last) + 216 * again + 432 * inside
    doc = np.concatenate([words.doc, words.doc])
    place = np.concatenate([(hashes >> _U(64 - WORD_BITS)).astype(np.int64), (1 << WORD_BITS) + shape])
    return doc, place, np.concatenate([value, value])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # increasing; one less than there are grades

    def probabilities(self, z: np.ndarray) -> np.ndarray:
        """P(grade = k) for each text (rows) and grade (columns)."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))
        edges = np.column_stack([np.zeros(len(z)), below, np.ones(len(z))])
        return np.diff(edges, axis=1)


def _thresholds(free: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([free[:1], np.logaddexp(0, free[1:])]))  # gaps are positive


def fit_weights(doc: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, n_grades: int) -> Model:
    """Maximum likelihood with a ridge, by gradient steps scaled for each weight."""
    n = len(grade)
    w, free = np.zeros(SIZE), np.full(n_grades - 1, 0.5)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] / n, 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    free[0] = start[0]
    free[1:] = np.log(np.expm1(np.maximum(np.diff(start), 1e-2)))
    seen_w, seen_t = np.full(SIZE, 1e-8), np.full(n_grades - 1, 1e-8)
    for _ in range(STEPS):
        z = np.bincount(doc, weights=w[place] * value, minlength=n)
        t = np.concatenate([[-np.inf], _thresholds(free), [np.inf]])
        hi = 1 / (1 + np.exp(-np.clip(t[grade + 1] - z, -40, 40)))
        lo = 1 / (1 + np.exp(-np.clip(t[grade] - z, -40, 40)))
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p  # of log p by the upper and by the lower threshold
        gz = d_hi - d_lo  # of -log p by z
        gw = np.bincount(place, weights=value * gz[doc], minlength=SIZE) / n + RIDGE * w
        gt = np.zeros(n_grades + 1)
        np.add.at(gt, grade + 1, -d_hi)
        np.add.at(gt, grade, d_lo)
        by_threshold = gt[1:n_grades] / n
        tail = np.cumsum(by_threshold[::-1])[::-1]  # a threshold moves all later ones
        gf = tail * np.concatenate([[1.0], 1 / (1 + np.exp(-free[1:]))])
        seen_w += gw**2
        seen_t += gf**2
        w -= RATE * gw / np.sqrt(seen_w)
        free -= 0.1 * gf / np.sqrt(seen_t)
    return Model(w, _thresholds(free))


def fit(docs: DataFrame, grades: DataFrame, n_grades: int, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", fit_rows: int = FIT_ROWS) -> Model:
    """A model of grades 0 .. ``n_grades`` - 1 from at most ``fit_rows`` of the ids for which ``may_learn`` holds."""
    known = grades.filter(may_learn & F.col(grade_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(grade_col).cast("int").alias("_grade"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)  # bounded, so it may be broadcast
    sample = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(known), "_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0)):
                doc, place, value = features(batch.column(0).slice(first, n))
                key, back = np.unique(doc.astype(np.int64) * SIZE + place, return_inverse=True)
                total = np.bincount(back, weights=value)
                ends = np.searchsorted(key, (np.arange(n + 1)) * SIZE).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((key % SIZE).astype(np.int32), total.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, n), *lists], names=["grade", "place", "value"])

    rows = materialize(sample.select("_text", "_grade").mapInArrow(extract, "grade int, place array<int>, value array<float>"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grade, doc, place, value, n = [], [], [], [], 0
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            doc.append(np.repeat(np.arange(n, n + len(sizes)), sizes))
            place.append(batch.column(1).flatten().to_numpy())
            value.append(batch.column(2).flatten().to_numpy())
            grade.append(batch.column(0).to_numpy())
            n += len(sizes)
        if n:
            model = fit_weights(*map(np.concatenate, (doc, place, value, grade)), n_grades)
            yield pa.RecordBatch.from_pydict({"weights": [model.weights], "thresholds": [model.thresholds]})

    found = rows.coalesce(1).mapInArrow(learn, "weights array<double>, thresholds array<double>").toArrow()
    if not found.num_rows:
        even = np.arange(1, n_grades) / n_grades
        return Model(np.zeros(SIZE), np.log(even / (1 - even)))
    return Model(*(np.array(found.column(c)[0].values) for c in ("weights", "thresholds")))


def grade_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``expected_grade`` and ``tail``, the probabilities of grade 1 or better, 2 or better, ..."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for first, n in slices(batch.column(1)):
                doc, place, value = features(batch.column(1).slice(first, n))
                p = m.probabilities(np.bincount(doc, weights=m.weights[place] * value, minlength=n))
                tail = np.cumsum(p[:, ::-1], axis=1)[:, ::-1][:, 1:]
                arrays = [batch.column(0).slice(first, n), pa.array(tail.sum(axis=1)), pa.array(list(tail), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "expected_grade", "tail"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, expected_grade double, tail array<double>")
