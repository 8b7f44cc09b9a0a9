"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased, and everything but letters separates words. Its subwords
are the words and their pieces of 2 to 4 bytes, word ends included; each is hashed to one of
2^``BITS`` embeddings of ``WIDTH`` numbers. The mean embedding of all subwords of
the whole text goes through a linear softmax over the languages.

Fit. Of every language about ``rows_per_language`` different texts are chosen by a hash of the text; each
gives ``WINDOWS`` windows spread over it, of 32, 16, 8 and 4 words, so that short texts
are learned too. The windows are dealt to tasks that go through them by stochastic
gradient descent in numpy; after every round the models of the tasks are averaged, piece by piece,
so that no task gathers them all.

Calibration. A fifth of the chosen texts is not trained on. Whole texts of it, ``CALIBRATE`` at most
on average, give the temperature that makes the scores likeliest, and the least score to accept: the lowest one
at which accepted texts are right with a share of ``precision``; where even all texts
are, the one that ``STRANGE`` of them lie below. Texts below it are rejected
(``accepted`` is false); they still carry the likeliest language.

Scoring is one pass without a shuffle; embeddings are folded with the softmax where there are fewer
languages than numbers in an embedding.

Defined cases: a null text or one without a letter is ``und`` with score 0, and rejected; without
a labelled text nothing is learned and all texts are ``und``; a null language is not learned; equal texts
count once in the fit, equal rows get equal results; of equal scores the language first in order is taken; very
long texts are read in steps; an empty table gives an empty table; null ids are carried; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import slices, span_hashes, split_words, text_bytes

_U = np.uint64
BITS, WIDTH = 15, 16
PIECES = (2, 3, 4)  # bytes
ROWS_PER_LANGUAGE = 5000
WINDOWS = (32, 16, 8, 4)  # words
WINDOW_BYTES = 2048  # at most, as words may be long
TASK_WINDOWS = 8000
ROUNDS, BATCH, RATE = 3, 32, 0.2
STEPS = 400  # a round goes through a task's windows as often as it takes for so many batches
CALIBRATE = 10_000
STRANGE = 0.002
UNKNOWN = "und"
_CHUNK = 1 << 14
_STEP = 1 << 20

LETTER = np.ones(256, bool)  # bytes of words in lower-cased text
LETTER[:128] = [chr(c).isalpha() for c in range(128)]
_KEYS = np.cumsum(np.full(256, 0x9E3779B97F4A7C15, _U), dtype=_U) ^ _U(0xD1B54A32D192ED03)
_ROLL, _SPREAD = _U(0xF1357AEA2E62A9C5), _U(0xD6E8FEB86659FD93)


def subwords(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all subwords, in steps of about a megabyte; texts do not decrease."""
    data, bounds = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    inside = LETTER[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(bounds, start, side="right") - 1
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _STEP, side="right")))
        length = end[i:j] - start[i:j]
        gaps = np.cumsum(length + 1) - length - 1
        gap = np.zeros(int((length + 1).sum()) + 1, bool)
        gap[gaps], gap[-1] = True, True
        line = np.full(len(gap), 32, np.uint8)  # the words with a gap before each, and one at the end
        line[~gap] = data[start[i] : end[j - 1]][inside[start[i] : end[j - 1]]]
        at = np.repeat(doc[i:j], length + 1)
        keys = _KEYS[line]
        rolled, open_ = keys, np.ones(len(line), bool)  # no gap between the first and the last byte
        docs, buckets = [doc[i:j]], [span_hashes(data, start[i:j], end[i:j])]
        for n in range(2, max(PIECES) + 1):
            m = len(line) - n + 1
            if m <= 0:
                break
            open_ = open_[:m] & ~gap[n - 2 : n - 2 + m] if n > 2 else open_[:m]
            rolled = rolled[:m] * _ROLL + keys[n - 1 :]
            if n in PIECES:
                docs.append(at[:m][open_])
                buckets.append((rolled[open_] ^ _U(n)) * _SPREAD)
        doc_of, bucket = np.concatenate(docs), (np.concatenate(buckets) >> _U(64 - BITS)).astype(np.int32)
        yield doc_of, bucket
        i = j


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether a text holds a letter of any script; null has none."""
    return pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    embeddings: np.ndarray  # bucket x width
    weights: np.ndarray  # width x language
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0  # accepted score

    def logits(self, column: pa.Array) -> np.ndarray:
        folded = len(self.languages) < WIDTH
        table = np.ascontiguousarray((self.embeddings @ self.weights if folded else self.embeddings).T)
        sums, n = np.zeros((len(column), len(table))), np.zeros(len(column))
        for doc, bucket in subwords(column):
            n += np.bincount(doc, minlength=len(column))
            for k, part in enumerate(table):
                sums[:, k] += np.bincount(doc, weights=part[bucket], minlength=len(column))
        means = sums / np.maximum(n, 1)[:, None]
        return (means if folded else means @ self.weights) + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def gradients(embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray, bucket: np.ndarray, starts: np.ndarray, label: np.ndarray) -> tuple:
    """(loss, gradients by embedding, weights, bias) summed over texts; text i has the buckets from ``starts[i]``."""
    n = np.diff(np.append(starts, len(bucket)))
    mean = np.add.reduceat(embeddings[bucket], starts, axis=0) / n[:, None]
    p = softmax(mean @ weights + bias)
    loss = -np.log(np.maximum(p[np.arange(len(label)), label], 1e-30)).sum()
    p[np.arange(len(label)), label] -= 1
    back = np.repeat(p @ weights.T / n[:, None], n, axis=0)
    of = np.stack([np.bincount(bucket, weights=back[:, k], minlength=len(embeddings)) for k in range(back.shape[1])], axis=1)
    return loss, of, mean.T @ p, p.sum(axis=0)


def descend(model: Model, texts: pa.Array, label: np.ndarray, rates: tuple[float, float], seed: int) -> Model:
    """Passes over the texts in orders drawn from ``seed``, the rate falling from the first to the second."""
    e, w, b = model.embeddings.astype(np.float64), model.weights.astype(np.float64), model.bias.astype(np.float64)
    draw, passes = np.random.default_rng(seed), -(-STEPS * BATCH // len(texts))
    order = np.concatenate([draw.permutation(len(texts)) for _ in range(passes)])
    texts, label, done = texts.take(pa.array(order)), label[order], 0
    for first, rows in slices(texts, _STEP):
        parts = list(subwords(texts.slice(first, rows)))
        doc, bucket = (np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)]) for k in (0, 1))
        by_doc = np.argsort(doc, kind="stable")
        doc, bucket = doc[by_doc], bucket[by_doc]
        edges = np.searchsorted(doc, np.arange(rows + 1))
        full = np.flatnonzero(np.diff(edges))
        for k in range(0, len(full), BATCH):
            batch = full[k : k + BATCH]
            lo, hi = edges[batch[0]], edges[batch[-1] + 1]
            _, de, dw, db = gradients(e, w, b, bucket[lo:hi], edges[batch] - lo, label[first + batch])
            rate = rates[0] + (rates[1] - rates[0]) * (done + k) / max(len(texts), 1)
            e -= rate * de
            w -= rate * dw
            b -= rate * db
        done += rows
    return Model(model.languages, e.astype(np.float32), w.astype(np.float32), b.astype(np.float32))


def windows_of(column: pa.Array) -> Iterator[tuple[int, int, str]]:
    """(text, number, words) of windows spread evenly over each text."""
    words = split_words(column)
    edges = np.searchsorted(words.doc, np.arange(words.n_docs + 1))
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        for k, size in enumerate(WINDOWS if b > a else ()):
            first = a + max(b - a - size, 0) * k // (len(WINDOWS) - 1)
            lo, hi = int(words.start[first]), int(words.end[min(first + size, b) - 1])
            yield i, k, words.data[lo : min(hi, lo + WINDOW_BYTES)].tobytes().decode("utf-8", "ignore")


def _chosen(docs: DataFrame, may_learn: Column, text_col: str, lang_col: str, rows_per_language: int) -> DataFrame:
    """(_text, _lang, _h) of texts chosen by hash; equal texts are all chosen or none is."""
    known = docs.filter(may_learn & F.col(f"`{text_col}`").isNotNull() & F.col(f"`{lang_col}`").isNotNull())
    known = known.select(F.col(f"`{text_col}`").alias("_text"), F.col(f"`{lang_col}`").cast("string").alias("_lang"), F.xxhash64(f"`{text_col}`").alias("_h"))
    sizes = known.groupBy("_lang").agg((F.approx_count_distinct("_h") / rows_per_language).alias("_times"))
    part = F.pmod(F.xxhash64(F.lit("chosen"), "_h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.join(materialize(sizes), "_lang").filter(part * F.col("_times") < 1).drop("_times")


def _averaged(pieces: DataFrame) -> np.ndarray:
    """Mean of flat models that come in pieces (at, n, values), weighted by n."""

    def mean(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        values = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in table.column("values")])
        out = (values * (n / n.sum())[:, None]).sum(axis=0).astype(np.float32)
        return pa.table({"at": pa.array([key[0].as_py()], pa.int32()), "values": pa.array([out.tobytes()], pa.binary())})

    rows = pieces.groupBy("at").applyInArrow(mean, "at int, values binary").toArrow().sort_by("at")  # one model, whatever the tasks
    return np.concatenate([np.frombuffer(v.as_buffer(), np.float32) for v in rows.column("values")])


def fit(
    docs: DataFrame, may_learn: Column, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE,
    rounds: int = ROUNDS, precision: float = 0.99,
) -> Model:
    """A model of the languages of rows for which ``may_learn`` holds."""
    chosen = _chosen(docs, may_learn, text_col, lang_col, rows_per_language)
    held_back = F.pmod(F.xxhash64(F.lit("held"), "_h"), F.lit(5)) == 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0)):
                found = list(windows_of(batch.column(0).slice(first, n)))
                row = pa.array([first + f[0] for f in found], pa.int64())
                arrays = [batch.column(1).take(row), batch.column(2).take(row), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "h", "k", "words"])

    examples = chosen.filter(~held_back).select("_text", "_lang", "_h").mapInArrow(cut, "lang string, h long, k int, words string")
    examples = materialize(examples.dropDuplicates(["lang", "h", "k"]))
    languages = tuple(sorted(r[0] for r in examples.select("lang").distinct().collect()))
    size, width = 1 << BITS, len(languages)
    start = np.random.default_rng(1).uniform(-0.5, 0.5, (size, WIDTH)) / WIDTH
    model = Model(languages, start.astype(np.float32), np.zeros((WIDTH, width), np.float32), np.zeros(width, np.float32))
    if not languages:
        return model
    tasks = -(-examples.count() // TASK_WINDOWS)
    # Only so many partitions hold windows, whatever the session's number, as each gives a model.
    dealt = examples.withColumn("task", F.pmod(F.xxhash64(F.lit("task"), "h"), F.lit(tasks)))
    dealt = materialize(dealt.repartitionByRange(tasks, "task").sortWithinPartitions("task", "h", "k", "lang"))
    context = docs.sparkSession.sparkContext
    for step in range(rounds):
        shared, rates = context.broadcast(model), (RATE * (rounds - step) / rounds, RATE * (rounds - step - 1) / rounds)

        def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]  # about TASK_WINDOWS short windows
            if not held:
                return
            table = pa.Table.from_batches(held)
            label = pc.index_in(table.column("lang"), pa.array(languages)).to_numpy()
            out = descend(shared.value, table.column("words").combine_chunks(), label, rates, table.column("task")[0].as_py() * rounds + step)
            flat = np.concatenate([x.ravel() for x in (out.embeddings, out.weights, out.bias)])
            pieces = [flat[i : i + _CHUNK].tobytes() for i in range(0, len(flat), _CHUNK)]
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(pieces)), pa.int32()), "n": pa.array([len(table)] * len(pieces), pa.int64()), "values": pa.array(pieces, pa.binary())})

        flat = _averaged(dealt.mapInArrow(trained, "at int, n long, values binary"))
        ends = np.cumsum([size * WIDTH, WIDTH * width])
        model = Model(languages, flat[: ends[0]].reshape(size, WIDTH), flat[ends[0] : ends[1]].reshape(WIDTH, width), flat[ends[1] :])
    return _calibrated(model, chosen.filter(held_back), rows_per_language, precision)


def _calibrated(model: Model, held: DataFrame, rows_per_language: int, precision: float) -> Model:
    shared, languages = held.sparkSession.sparkContext.broadcast(model), model.languages
    share = min(1.0, CALIBRATE / (len(languages) * max(rows_per_language // 5, 1)))
    held = held.filter(F.pmod(F.xxhash64(F.lit("calibrate"), "_h"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0)):
                column = batch.column(0).slice(first, n)
                logits = shared.value.logits(column).astype(np.float32)
                arrays = [batch.column(1).slice(first, n), batch.column(2).slice(first, n), pa.array([x.tobytes() for x in logits], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "h", "logits"]).filter(pa.array(has_letter(column)))

    rows = held.select("_text", "_lang", "_h").mapInArrow(scored, "lang string, h long, logits binary").dropDuplicates(["lang", "h"]).sort("h", "lang").toArrow()
    label = pc.fill_null(pc.index_in(rows.column("lang"), pa.array(languages)), -1).to_numpy()
    logits = np.frombuffer(b"".join(rows.column("logits").to_pylist()), np.float32).reshape(len(label), len(languages)).astype(np.float64)
    known = label >= 0
    if not known.any():
        return model

    # As if one text more had been of any language: texts that are all told apart would ask for a temperature of 0.
    target = np.full((known.sum(), len(languages)), 1 / (known.sum() + 1) / len(languages))
    target[np.arange(known.sum()), label[known]] += known.sum() / (known.sum() + 1)

    def likelihood(t: float) -> float:
        return float((target * np.log(np.maximum(softmax(logits[known] / t), 1e-300))).sum())

    temperature = float(max(np.geomspace(0.02, 20, 121), key=likelihood))
    p = softmax(logits / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == label
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    if share[-1] >= precision:
        least = float(np.quantile(score, STRANGE))
    else:
        good = np.flatnonzero(share >= precision)
        least = float(score[order[good[-1]]]) if len(good) else 1.0
    return Model(languages, model.embeddings, model.weights, model.bias, temperature, least)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (the calibrated probability of that language) and ``accepted``."""
    shared, id_type = docs.sparkSession.sparkContext.broadcast(model), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, n in slices(batch.column(1)):
                column = batch.column(1).slice(first, n)
                usable = has_letter(column) & bool(model.languages)
                if model.languages:
                    p = softmax(model.logits(pc.fill_null(column, "")) / model.temperature)
                    best = np.where(usable, p.argmax(axis=1), len(model.languages))
                    score = np.where(usable, p.max(axis=1), 0.0)
                else:
                    best, score = np.zeros(n, np.int64), np.zeros(n)
                names = pa.array([*model.languages, UNKNOWN]).take(pa.array(best))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), names, pa.array(score), pa.array(usable & (score >= model.least))], names=[id_col, "lang_pred", "score", "accepted"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double, accepted boolean")
