"""Toxic passages as maximal scoring segments of token log-odds.

Fit. Labelled documents are counted once for each word and each of its stems (the first
3 to 7 bytes). The class probability of a word is estimated by a chain of Dirichlet
priors: that of a stem is centred on the next shorter stem, that of the word on its longest
stem, so that a rare or new form borrows from its family. A token's score is its log-odds
against the base rate, less a drift that makes ordinary text lose score.

Search. In one linear pass all maximal scoring segments of a text are found: disjoint runs
of words whose score no extension or part exceeds. Only words of positive score start a step.

Calibration. Over clean documents the best segment of n words follows an extreme-value law,
P(best <= x) = exp(-K n e^(-lambda x)); its parameters are fitted on labelled documents that
were not counted. A segment is significant if K n e^(-lambda s) is small. A document's score
is a logistic function of the evidence of its best segment and of all segments together.

The fit uses at most ``FIT_ROWS`` labelled documents, those of lowest hash, a third of them for
calibration; their texts are written once. Counts are kept in a table of fixed size, so what is
broadcast does not grow with the data. Every text is scored whole, in one pass without a shuffle.

Defined cases: null, empty and wordless texts have no segment and get the score of a document
without evidence; equal texts get equal scores; labels that are null are not used, several labels
of one id count as toxic if one is; without labels every score is 0; an empty table gives an empty
table; null ids are carried; other columns are ignored. Very long texts are one array operation and one linear scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import SLICE_BYTES, mix, released, slices, span_hashes, split_words

_U = np.uint64
FIT_ROWS = 20_000
STEMS = (3, 4, 5, 6, 7)  # bytes
WORD_BITS, STEM_BITS = 18, 16
PRIOR = 6.0  # documents that a prior counts for
DRIFT = 1.0
MAX_E = 0.01  # a significant segment is expected less often than this in a clean text of the length
SEGMENTS = "array<struct<start:long,end:long,score:double,e_value:double>>"

LETTER = np.ones(256, bool)  # bytes that may begin or end the core of a word
LETTER[:128] = [chr(c).isalnum() for c in range(128)]


def _places(column: pa.Array) -> tuple:
    """Words of the texts, and for each of them its place in the count table at every level."""
    words = split_words(column)
    letters = np.flatnonzero(LETTER[words.data])
    first, last = np.searchsorted(letters, words.start), np.searchsorted(letters, words.end)
    full = last > first  # others, without a letter, are passed over
    start, end = letters[first[full]], letters[last[full] - 1] + 1
    levels = [span_hashes(words.data, start, np.minimum(start + n, end), lower=True) for n in STEMS]
    places = np.empty((len(start), len(STEMS) + 1), np.int32)
    for i, h in enumerate(levels):
        places[:, i] = (mix(h + _U(i)) >> _U(64 - STEM_BITS)).astype(np.int32) + (i << STEM_BITS)
    whole = span_hashes(words.data, start, end, lower=True)
    places[:, -1] = (whole >> _U(64 - WORD_BITS)).astype(np.int32) + (len(STEMS) << STEM_BITS)
    return words, words.doc[full], words.start[full], words.end[full], places


TABLE = (len(STEMS) << STEM_BITS) + (1 << WORD_BITS)


@dataclass(frozen=True)
class Model:
    toxic: np.ndarray  # documents by place
    clean: np.ndarray
    base: float  # share of toxic documents
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)  # constant, best segment, all segments

    def token_scores(self, places: np.ndarray) -> np.ndarray:
        p = np.full(len(places), self.base)
        for i in range(places.shape[1]):
            toxic, clean = self.toxic[places[:, i]], self.clean[places[:, i]]
            p = (toxic + PRIOR * p) / (toxic + clean + PRIOR)
        return np.log(p / (1 - p)) - np.log(self.base / (1 - self.base)) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, past the last, score), in order."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    breaks = np.flatnonzero(np.diff(up) > 1)
    firsts = up[np.concatenate([[0], breaks + 1])]
    lasts = up[np.concatenate([breaks, [len(up) - 1]])] + 1
    found: list[tuple[int, int, float, float, int]] = []  # first, end, total before, total after, nearest earlier one that begins lower
    for first, end, low, high in zip(firsts.tolist(), lasts.tolist(), total[firsts].tolist(), total[lasts].tolist()):
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((first, end, low, high, j))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(first, end, high - low) for first, end, low, high, _ in found]


def _scan(column: pa.Array, model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """For each text its number of words and its segments, as byte spans of the text."""
    words, doc, start, end, places = _places(column)
    scores = model.token_scores(places)
    edges = np.searchsorted(doc, np.arange(words.n_docs + 1))
    for i in range(words.n_docs):
        a, b = edges[i], edges[i + 1]
        base = int(words.bounds[i])
        yield int(b - a), [(int(start[a + s]) - base, int(end[a + e - 1]) - base, value) for s, e, value in maximal_segments(scores[a:b])]


def evidence(n: int, values: list[float], lam: float, k: float) -> tuple[float, float]:
    """Of the best segment, and of all segments that exceed what is expected in n words."""
    over = [x for v in values if (x := lam * v - np.log(k * max(n, 1))) > 0]
    best = lam * max(values) - np.log(k * max(n, 1)) if values else -5.0
    return float(np.clip(best, -5.0, 50.0)), float(np.log1p(sum(over)))


def fit_extremes(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and K by maximum likelihood from the best scores of clean texts of n words."""
    n = np.maximum(n, 1)

    def likelihood(lam: float) -> tuple[float, float]:
        tail = np.maximum(n * np.exp(-lam * best), 1e-300)
        k = len(best) / tail.sum()
        return float(np.sum(np.log(k * lam * tail) - k * tail)), k

    grid = np.geomspace(0.05, 20, 200)
    lam = float(max(grid, key=lambda x: likelihood(x)[0]))
    return lam, float(likelihood(lam)[1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression with a constant, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0, *np.ones(x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """A model from at most ``fit_rows`` of the labelled ids for which ``may_learn`` holds."""
    known = labels.filter(may_learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)  # bounded, so it may be broadcast
    part = F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(3)) == 0
    sample = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(known), "_id")
    sample = materialize(sample.dropDuplicates(["_text", "_label"]).select("_text", "_label", part.alias("_calibrate")))

    @released
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((TABLE + 1, 2), np.int64)  # the last place counts documents
        for batch in batches:
            for first, n in slices(batch.column(0)):
                _, doc, _, _, places = _places(batch.column(0).slice(first, n))
                label = batch.column(1).slice(first, n).to_numpy()
                for i in range(places.shape[1]):
                    keyed = np.unique(places[:, i].astype(np.int64) * n + doc)
                    np.add.at(sums, (keyed // n, label[keyed % n]), 1)
                sums[TABLE] += np.bincount(label, minlength=2)
        place = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums[place, 0]), pa.array(sums[place, 1])], names=["place", "clean", "toxic"])

    counts = sample.filter("not _calibrate").select("_text", "_label").mapInArrow(counted, "place long, clean long, toxic long")
    found = counts.groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()  # at most TABLE + 1 rows
    clean, toxic = np.zeros(TABLE + 1), np.zeros(TABLE + 1)
    clean[found.column("place").to_numpy()] = found.column("clean").to_numpy()
    toxic[found.column("place").to_numpy()] = found.column("toxic").to_numpy()
    n_clean, n_toxic = clean[TABLE], toxic[TABLE]
    if not n_clean + n_toxic:
        return Model(toxic, clean, 0.5, weights=(-1e9, 0.0, 0.0))
    model = Model(toxic, clean, float((n_toxic + 0.5) / (n_clean + n_toxic + 1)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @released
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0)):
                rows = list(_scan(batch.column(0).slice(first, n), shared.value))
                arrays = [batch.column(1).slice(first, n), pa.array([r[0] for r in rows], pa.int64()), pa.array([[s[2] for s in r[1]] for r in rows], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["label", "n", "scores"])

    rows = sample.filter("_calibrate").select("_text", "_label").mapInArrow(scanned, "label int, n long, scores array<double>").toArrow().to_pydict()
    label, n = np.array(rows["label"], float), np.array(rows["n"], float)
    if not len(label) or label.min() == label.max():
        return Model(toxic, clean, model.base, weights=(float(np.log(model.base / (1 - model.base))), 0.0, 0.0))
    best = np.array([max(s, default=0.0) for s in rows["scores"]])
    lam, k = fit_extremes(best[label == 0], n[label == 0])
    x = np.array([evidence(m, s, lam, k) for m, s in zip(n, rows["scores"])])
    return Model(toxic, clean, model.base, lam, k, tuple(fit_logistic(x, label)))


def _judged(column: pa.Array, model: Model) -> Iterator[tuple[float, list[dict]]]:
    for n, segments in _scan(column, model):
        best, together = evidence(n, [s[2] for s in segments], model.lam, model.k)
        z = model.weights[0] + model.weights[1] * best + model.weights[2] * together
        expected = [(model.k * max(n, 1) * float(np.exp(-model.lam * v)), a, b, v) for a, b, v in segments]
        yield float(1 / (1 + np.exp(-np.clip(z, -700, 700)))), [{"start": a, "end": b, "score": v, "e_value": e} for e, a, b, v in expected if e <= MAX_E]


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_segments: bool = True) -> DataFrame:
    """Per row: id, ``score`` and the significant ``segments`` as byte spans of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))
    id_type = docs.schema[id_col].dataType.simpleString()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(1), SLICE_BYTES):
                rows = list(_judged(batch.column(1).slice(first, n), shared.value))
                arrays = [batch.column(0).slice(first, n), pa.array([r[0] for r in rows], pa.float64())]
                arrays += [pa.array([r[1] for r in rows], kind)] * with_segments
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "score", "segments"][: len(arrays)])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, score double" + f", segments {SEGMENTS}" * with_segments)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows that score below ``limit``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            for first, n in slices(texts):
                kept = [score < limit for score, _ in _judged(texts.slice(first, n), shared.value)]
                yield batch.slice(first, n).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
