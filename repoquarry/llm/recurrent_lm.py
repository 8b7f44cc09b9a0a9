"""Document log-likelihood under a gated recurrent language model, beside smoothed unigrams.

Vocabulary. All words of all training texts are counted. The ``VOCAB`` most frequent are outputs of the
network; any other word is one of ``GROUPS`` outputs, by its last letters, and then drawn from the smoothed counts of its
group. So every text has a proper likelihood, and no word is left out.

Network. Gated recurrent units in numpy with an output softmax factored into classes of words. Every
task trains its share of the texts by truncated backpropagation: the texts run through parallel lanes,
gradients stop at the ends of windows, the state goes on and is reset where a text begins. After each of
``ROUNDS`` rounds, which together use every training text once, the models of all tasks are averaged, weighted by words.

Scoring. Texts are lanes, sorted by length; the state is carried from window to window over the
whole text, so long ones are not cut.

Counts of the ``FREQUENT`` most frequent words at most are broadcast. Rarer words of a text go through a join
with all counts, spread by word, so counts are exact for every word at any vocabulary. Models are averaged in pieces that are
summed as a stream; only the average, of fixed size, reaches the driver.

Defined cases: null and empty texts are the end of text alone; equal texts get equal scores; a
null id counts as an empty text in the split; without training text every likelihood is 1; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import slices, split_words, tail_hashes, word_hashes

_U = np.uint64
VOCAB, GROUPS, CLASS_SIZE = 1024, 16, 32
HIDDEN = 16
ROUNDS = 4
LANES, WINDOW = 512, 16
RATES = (0.02, 0.01, 0.006, 0.003)
FREQUENT = 1 << 19
SCORE_BYTES = 8 << 20
PIECE = 4096  # numbers of a model that travel in one row
SMOOTH = 0.1
LEAD_BITS = 20
END = -16  # key of the end of a text; its group bits are 0


def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of all words and ends of text, in order. The last 4 bits of a key name the group."""
    words = split_words(column)
    group = tail_hashes(words, lower=True) & _U(GROUPS - 1)
    key = ((word_hashes(words, lower=True) & ~_U(GROUPS - 1)) | group).view(np.int64)
    n = words.n_docs
    at = np.searchsorted(words.doc, np.arange(n), side="right")
    return np.insert(words.doc, at, np.arange(n)), np.insert(key, at, END)


@dataclass(frozen=True)
class Counts:
    """The most frequent words and sums over all."""

    key: np.ndarray  # sorted as unsigned numbers
    count: np.ndarray
    rank: np.ndarray  # 0 for the most frequent
    tokens: int  # N
    types: int  # V
    group_mass: np.ndarray  # smoothed mass of the words outside the vocabulary, by group
    first: np.ndarray  # place of the first key with given leading bits

    def find(self, key: np.ndarray) -> np.ndarray:
        """Place of each key, or -1: the few frequent keys with the same leading bits are tried in turn."""
        lead = (key.view(_U) >> _U(64 - LEAD_BITS)).astype(np.int64)
        at, end, out = self.first[lead], self.first[lead + 1], np.full(len(key), -1)
        live = np.flatnonzero(at < end)
        while len(live):
            hit = self.key[at[live]] == key[live]
            out[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out

    def outputs(self, key: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Output of the network for each word: its group, or ``GROUPS`` + rank."""
        rank = self.rank[at] if len(self.rank) else np.full(len(at), VOCAB)
        return np.where((at >= 0) & (rank < VOCAB), GROUPS + rank, key & (GROUPS - 1)).astype(np.int32)


N_OUT = GROUPS + VOCAB
N_CLASSES = 1 + VOCAB // CLASS_SIZE
START = N_OUT  # the input before the first word


_CLASS = np.concatenate([np.zeros(GROUPS, np.int64), 1 + np.arange(VOCAB) // CLASS_SIZE])


def class_of(output: np.ndarray) -> np.ndarray:
    return _CLASS[output]


def members(c: int) -> slice:
    return slice(0, GROUPS) if c == 0 else slice(GROUPS + (c - 1) * CLASS_SIZE, GROUPS + c * CLASS_SIZE)


SHAPES = {"inputs": (N_OUT + 1, 3 * HIDDEN), "state": (HIDDEN, 3 * HIDDEN), "class_w": (HIDDEN, N_CLASSES), "class_b": (N_CLASSES,), "word_w": (N_OUT, HIDDEN), "word_b": (N_OUT,)}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def shaped(numbers: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k], at = numbers[at : at + size].reshape(shape).astype(np.float32), at + size
    return out


def initial(mass: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights; the biases give every output its share of ``mass``."""
    draw = np.random.default_rng(11)
    w = {k: (0.1 * draw.standard_normal(shape)).astype(np.float32) for k, shape in SHAPES.items()}
    w["word_w"] *= 0.1
    w["class_w"] *= 0.1
    mass = np.maximum(mass, 1e-3)
    for c in range(N_CLASSES):
        w["word_b"][members(c)] = np.log(mass[members(c)] / mass[members(c)].max())
    w["class_b"] = np.log([mass[members(c)].sum() for c in range(N_CLASSES)]).astype(np.float32)
    w["class_b"] -= w["class_b"].max()
    return w


def _sigmoid(v: np.ndarray) -> np.ndarray:
    """In place; exp takes less than half the time of tanh."""
    np.negative(v, out=v)
    with np.errstate(over="ignore"):  # 1 / inf is 0
        np.exp(v, out=v)
    v += 1
    return np.reciprocal(v, out=v)


def step(w: dict, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(new state, update gate, reset gate, candidate, recurrent part of the candidate)."""
    a, g = w["inputs"].take(x, axis=0), h @ w["state"]
    z, r = (_sigmoid(a[:, k : k + HIDDEN] + g[:, k : k + HIDDEN]) for k in (0, HIDDEN))
    gn = np.ascontiguousarray(g[:, 2 * HIDDEN :])
    n = r * gn
    n += a[:, 2 * HIDDEN :]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, n, gn


def _softmax_log(z: np.ndarray, place: np.ndarray, d: bool) -> np.ndarray:
    """Log-probability at ``place`` of each row of logits. With ``d``, z becomes the gradient of its negative."""
    rows = np.arange(len(z))
    if z.max(initial=0) > 80:
        np.minimum(z, 80, out=z)
    out = z[rows, place]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    out = out - np.log(total)
    if d:
        z /= total[:, None]
        z[rows, place] -= 1
    return out


def output_log(w: dict, h: np.ndarray, y: np.ndarray, grad: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each output and, with ``grad``, the gradient of the mean negative one by h.

    Rows are sorted by class once, so that every class is one stretch of them.
    """
    c, back = class_of(y), grad is not None
    order = np.argsort(c.astype(np.uint8), kind="stable")
    h, c, y = h.take(order, axis=0), c[order], y[order]
    z = h @ w["class_w"]
    z += w["class_b"]
    logs = _softmax_log(z, c, back).astype(np.float64)
    dh = None
    if back:
        dh = z @ w["class_w"].T
        grad["class_w"] += h.T @ z / len(y)
        grad["class_b"] += z.sum(axis=0) / len(y)
    edges = np.searchsorted(c, np.arange(N_CLASSES + 1))
    for k in np.flatnonzero(np.diff(edges)):
        at, of = slice(edges[k], edges[k + 1]), members(k)
        z = h[at] @ w["word_w"][of].T
        z += w["word_b"][of]
        logs[at] += _softmax_log(z, y[at] - of.start, back)
        if back:
            dh[at] += z @ w["word_w"][of]
            grad["word_w"][of] += z.T @ h[at] / len(y)
            grad["word_b"][of] += z.sum(axis=0) / len(y)
    out = np.empty(len(y))
    out[order] = logs
    if not back:
        return out, None
    dh /= len(y)
    by_row = np.empty_like(dh)
    by_row[order] = dh
    return out, by_row


def gradients(w: dict, x: np.ndarray, y: np.ndarray, begins: np.ndarray, h: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """(mean loss, gradients, last state) of one window; x, y and begins are (time, lane)."""
    grad = {k: np.zeros(shape, np.float32) for k, shape in SHAPES.items()}
    kept, firsts_of = [], [np.flatnonzero(row) for row in begins]
    states = np.empty((x.size, HIDDEN), w["state"].dtype)
    for t in range(len(x)):
        if len(firsts_of[t]):
            h = h.copy()
            h[firsts_of[t]] = 0
        new, *parts = step(w, x[t], h)
        kept.append((h, *parts))
        states[t * x.shape[1] : (t + 1) * x.shape[1]] = h = new
    logs, dh_out = output_log(w, states, y.ravel(), grad)
    lanes = x.shape[1]
    carry, d_inputs = np.zeros_like(h), np.empty((len(x) * lanes, 3 * HIDDEN), states.dtype)
    back, dg = np.ascontiguousarray(w["state"].T), np.empty((lanes, 3 * HIDDEN), states.dtype)
    for t in reversed(range(len(x))):
        hp, z, r, n, gn = kept[t]
        dh = dh_out[t * lanes : (t + 1) * lanes]
        dh += carry
        carry = dh * z
        dh -= carry  # dh * (1 - z)
        dn = dh * n
        dn *= n
        np.subtract(dh, dn, out=dn)
        dz = hp - n
        dz *= carry
        dz -= dz * z
        dr = dn * r
        dg[:, 2 * HIDDEN :] = dr
        dr *= gn
        dr -= dr * r
        da = d_inputs[t * lanes : (t + 1) * lanes]
        da[:, :HIDDEN], da[:, HIDDEN : 2 * HIDDEN], da[:, 2 * HIDDEN :] = dz, dr, dn
        dg[:, : 2 * HIDDEN] = da[:, : 2 * HIDDEN]
        grad["state"] += hp.T @ dg
        carry += dg @ back
        if len(firsts_of[t]):
            carry[firsts_of[t]] = 0
    order = np.argsort(x.ravel(), kind="stable")
    ids = x.ravel()[order]
    firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    grad["inputs"][ids[firsts]] = np.add.reduceat(d_inputs[order], firsts, axis=0)
    return float(-logs.mean()), grad, h


class Trainer:
    """Adam steps over the texts of one task."""

    def __init__(self, weights: dict, rate: float):
        self.w, self.rate, self.t = {k: v.copy() for k, v in weights.items()}, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}
        self.words, self.loss = 0, 0.0

    def update(self, grad: dict) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        scale = min(1.0, 1.0 / max(norm, 1e-12))
        for k, g in grad.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.w[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)

    def texts(self, doc: np.ndarray, y: np.ndarray) -> None:
        begins = np.concatenate([[True], doc[1:] != doc[:-1]])
        x = np.where(begins, START, np.concatenate([[START], y[:-1]])).astype(np.int32)
        lanes = int(np.clip(len(y) // 1000, 1, LANES))
        length = len(y) // lanes
        shape = lambda a: a[: lanes * length].reshape(lanes, length).T
        rest = slice(lanes * length, None)
        self._run(shape(x), shape(y), shape(begins))
        if len(y[rest]):
            self._run(x[rest][:, None], y[rest][:, None], begins[rest][:, None])

    def _run(self, x: np.ndarray, y: np.ndarray, begins: np.ndarray) -> None:
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t in range(0, len(x), WINDOW):
            part = slice(t, t + WINDOW)
            loss, grad, h = gradients(self.w, x[part], y[part], begins[part], h)
            self.words += y[part].size
            self.loss += loss * y[part].size
            self.update(grad)


def score_texts(w: dict, doc: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Natural log-likelihood of the outputs of each text, state carried over the whole of it."""
    size = np.bincount(doc, minlength=n)
    first = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")
    sizes, firsts = size[order], first[order]
    out = np.zeros(n)
    h = np.zeros((n, HIDDEN), np.float32)
    x = np.full(n, START, np.int32)
    held: list[tuple[np.ndarray, np.ndarray, int]] = []
    waiting = 0

    def flush() -> None:
        logs, _ = output_log(w, np.concatenate([k[0] for k in held]), np.concatenate([k[1] for k in held]))
        at = 0
        for _, _, active in held:
            out[:active] += logs[at : at + active]
            at += active

    active = n
    for t in range(int(sizes.max(initial=0))):
        while active and sizes[active - 1] <= t:
            active -= int(np.searchsorted(sizes[:active][::-1], t, side="right"))
        h, *_ = step(w, x[:active], h[:active])
        x = y[firsts[:active] + t]
        held.append((h, x, active))
        waiting += active
        if waiting > 1 << 16:
            flush()
            held, waiting = [], 0
    if held:
        flush()
    back = np.empty(n)
    back[order] = out
    return back


def count_words(texts: DataFrame) -> DataFrame:
    """(key, c) of all words and ends of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0), SCORE_BYTES):
                key, c = np.unique(keys_of(batch.column(0).slice(first, n))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(c.astype(np.int64))], names=["key", "c"])

    return texts.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _least_count(sizes: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach. ``sizes``: c, types (a row for each count)."""
    steps = sizes.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.sum("types").alias("types"), F.min("c").alias("low"), F.max("c").alias("high"))
    total, least = 0, 1
    for row in steps.orderBy(F.desc("step")).collect():  # at most 16 * 63 steps
        total += row["types"]
        if total > most:
            return max(least, row["high"] + 1)
        least = row["low"]
    return least


def frequent_words(counts: DataFrame) -> Counts:
    sizes = counts.groupBy("c").agg(F.count("*").alias("types"))
    found = counts.filter(F.col("c") >= _least_count(sizes, FREQUENT)).toArrow()  # at most FREQUENT rows
    key, count = found.column("key").to_numpy(), found.column("c").to_numpy()
    order = np.lexsort((key, -count))
    ranks = np.empty(len(key), np.int64)
    ranks[order] = np.arange(len(key))
    by_key = np.argsort(key.view(_U))
    first = np.searchsorted(key.view(_U)[by_key] >> _U(64 - LEAD_BITS), np.arange((1 << LEAD_BITS) + 1, dtype=_U)).astype(np.int32)
    groups = counts.groupBy(F.col("key").bitwiseAND(GROUPS - 1).alias("g")).agg(F.sum("c").alias("c"), F.count("*").alias("types")).collect()  # at most GROUPS rows
    tokens, types = np.zeros(GROUPS), np.zeros(GROUPS)
    for row in groups:
        tokens[row["g"]], types[row["g"]] = row["c"], row["types"]
    known = order[:VOCAB]
    mass = tokens - np.bincount(key[known] & (GROUPS - 1), weights=count[known], minlength=GROUPS) + SMOOTH * (types - np.bincount(key[known] & (GROUPS - 1), minlength=GROUPS) + 1)
    return Counts(key[by_key], count[by_key], ranks[by_key], int(tokens.sum()), int(types.sum()), mass, first)


def average(parts: DataFrame) -> tuple[np.ndarray, int, float] | None:
    """Mean of the models in ``parts`` (piece, numbers, words, loss), weighted by words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            numbers = batch.column(1)
            for i, piece in enumerate(batch.column(0).to_pylist()):
                words, loss = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                held = sums.setdefault(piece, [0.0, 0, 0.0])
                held[0] = held[0] + words * numbers[i].values.to_numpy().astype(np.float64)
                held[1] += words
                held[2] += loss
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s[0] for s in sums.values()]), pa.array([s[1] for s in sums.values()]), pa.array([s[2] for s in sums.values()])], names=["piece", "numbers", "words", "loss"])

    rows = parts.repartition(4, "piece").mapInArrow(run, "piece long, numbers array<double>, words long, loss double").collect()  # one model
    rows.sort(key=lambda r: r["piece"])
    if not rows or not rows[0]["words"]:
        return None
    return np.concatenate([np.array(r["numbers"]) / r["words"] for r in rows]), rows[0]["words"], rows[0]["loss"] / rows[0]["words"]


def train(texts: DataFrame, counts: Counts, share: Column) -> dict:
    """Weights after ``ROUNDS`` rounds. ``share``: a number below ROUNDS that says in which a text is used."""
    mass = np.zeros(N_OUT)
    mass[:GROUPS] = counts.group_mass
    known = counts.rank < VOCAB
    mass[GROUPS + counts.rank[known]] = counts.count[known]
    weights = initial(mass)
    context = texts.sparkSession.sparkContext
    shared_counts = context.broadcast(counts)
    for r in range(ROUNDS):
        shared = context.broadcast(weights)
        rate = RATES[min(r, len(RATES) - 1)]

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate) -> Iterator[pa.RecordBatch]:
            found, trainer = shared_counts.value, Trainer(shared.value, rate)
            for batch in batches:
                for first, n in slices(batch.column(0)):
                    doc, key = keys_of(batch.column(0).slice(first, n))
                    trainer.texts(doc, found.outputs(key, found.find(key)))
            if trainer.words:
                numbers = flat(trainer.w)
                pieces = [numbers[i : i + PIECE] for i in range(0, len(numbers), PIECE)]
                k = len(pieces)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(pieces, pa.list_(pa.float32())), pa.array(np.full(k, trainer.words)), pa.array(np.full(k, trainer.loss))], names=["piece", "numbers", "words", "loss"])

        parts = texts.filter(share == r).select(texts.columns[0]).mapInArrow(run, "piece long, numbers array<float>, words long, loss double")
        mean = average(parts)
        if mean is not None:
            weights = shaped(mean[0])
    return weights


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score (both log10)."""
    text = F.col(f"`{text_col}`")
    learn = docs.filter(~held_out).select(text.alias("text"))
    table = materialize(count_words(learn))
    counts = frequent_words(table)
    weights = train(learn, counts, F.pmod(F.xxhash64(F.lit("round"), "text"), F.lit(ROUNDS)))
    context = docs.sparkSession.sparkContext
    shared_counts, shared = context.broadcast(counts), context.broadcast(weights)
    total = np.log10(counts.tokens + SMOOTH * (counts.types + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared_counts.value
        log_mass = np.log10(found.group_mass)
        for batch in batches:
            for first, n in slices(batch.column(2), SCORE_BYTES):
                doc, key = keys_of(batch.column(2).slice(first, n))
                at = found.find(key)
                y = found.outputs(key, at)
                natural = score_texts(shared.value, doc, y, n)
                add = lambda v, where: np.bincount(doc[where], weights=v[where], minlength=n).astype(float)
                near, outside = at >= 0, y < GROUPS
                log_c = np.log10((found.count[at] if len(found.count) else np.zeros(len(at))) + SMOOTH)
                tokens = np.bincount(doc, minlength=n)
                base = add(log_c, near)
                score = natural / np.log(10) - add(log_mass[y * outside], outside) + add(log_c, near & outside)
                far = ~near
                packed = doc[far].astype(np.int64)
                order = np.lexsort((key[far], packed))
                word, owner = key[far][order], packed[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
                starts = np.flatnonzero(new)
                times = np.diff(np.append(starts, len(word)))
                edges = np.searchsorted(owner[starts], np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in (word[starts], times.astype(np.int32))]
                ids = [batch.column(c).slice(first, n) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(tokens.astype(np.int64)), pa.array(np.bincount(doc[near], minlength=n).astype(np.int64)), pa.array(base), pa.array(score), *lists], names=names)

    names = [id_col, "held_out", "n_tokens", "n_known", "base", "model", "words", "times"]
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, held_out boolean, n_tokens long, n_known long, base double, model double, words array<long>, times array<int>"
    rows = docs.select(F.col(f"`{id_col}`"), held_out.alias("held_out"), text).mapInArrow(run, schema)
    rows = materialize(rows).withColumn("row", F.monotonically_increasing_id())
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("key"), F.col("w.times").alias("n"))
    c = F.coalesce("c", F.lit(0))
    sums = rare.join(table, "key", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c + F.lit(SMOOTH))).alias("rare_log"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )
    more = F.coalesce("rare_log", F.lit(0.0))
    return rows.drop("words", "times").join(sums, "row", "left").select(
        f"`{id_col}`", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(float(total))).alias("base_score"), (F.col("model") + more).alias("score"),
    )
