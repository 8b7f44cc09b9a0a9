"""Quality rules from repetition: how much of a text lies in what it repeats.

Words get 64-bit hashes and windows of several lengths rolling hashes, in numpy over
whole Arrow batches. A window is a duplicate if the same text holds it twice or more;
its characters, the first copy's included, count once for each length. Lines are
compared whole. Windows nest (words in a repeated window of 10 lie in repeated ones of 8, 5 and
3), so limits fall with the length and lie well under the base rule; otherwise the longer
windows would decide nothing. Rows are judged where they lie: no shuffle, one pass, and memory
follows the slice (and a longer text alone), not the table.

Defined cases: null, empty and white-space texts have no words and are rejected by
``MIN_WORDS``; texts are measured whole, whatever their length; equal rows get equal
results; an empty table gives an empty table; all other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import SPACE, mix, per_unit, released, roll, slices, span_hashes, split_words, word_hashes

_U = np.uint64


@dataclass(frozen=True)
class Rules:
    """Largest shares that a kept text may have. ``windows``: {words: share of word characters}."""

    min_words: int = 50
    repeat_words_pct: int = 50  # words in repeated windows of ``base_window`` words
    base_window: int = 3
    windows: tuple[tuple[int, float], ...] = ((5, 0.15), (8, 0.13), (10, 0.10))
    line_chars: float = 0.065  # word characters in lines equal to an earlier one; half of what windows count for the two
    symbols: float = 0.10  # symbols for each word; no repetition, so a flag of its own


SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def repeated(keys: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether the key occurs twice or more in its unit, whether it did before)."""
    keyed = keys ^ mix(unit.astype(_U) + _U(0x51ED27))
    order = np.argsort(keyed, kind="stable")
    ranked = keyed[order]
    same = ranked[1:] == ranked[:-1]
    twice, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    again[order[1:]] = same
    return twice, again


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a window of ``n`` that begins in ``at``."""
    steps = np.zeros(size + 1, np.int32)
    steps[at] = 1
    steps[at + n] -= 1  # each position at most once, as those of ``at`` are distinct
    return np.cumsum(steps[:size]) > 0


def line_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the lines that hold a word; ``\\n`` splits and is not part of a line."""
    feeds = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    start = start[start < len(data)]
    doc = np.searchsorted(bounds, start, side="right") - 1
    follow = np.append(feeds, len(data))
    end = np.minimum(follow[np.searchsorted(follow, start)], bounds[doc + 1]) if len(start) else start
    full = end > start
    return start[full], end[full], doc[full]


def measures(column: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """Counts and shares of each text of one slice."""
    words = split_words(column)
    n, doc = words.n_docs, words.doc
    points = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((words.data & 0xC0) != 0x80, out=points[1:])  # bytes that begin a code point
    length = points[words.end] - points[words.start]
    of_text = np.repeat(np.arange(n), np.diff(words.bounds))
    out = {
        "n_words": np.bincount(doc, minlength=n).astype(np.int64),
        "word_chars": per_unit(length, doc, n),
        "n_symbols": np.bincount(of_text[SYMBOLS[words.data]], minlength=n).astype(np.int64),
    }
    start, end, line_doc = line_spans(words.data, words.bounds)
    inside = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(~SPACE[words.data], out=inside[1:])
    with_word = inside[end] > inside[start]
    start, end, line_doc = start[with_word], end[with_word], line_doc[with_word]
    _, again = repeated(span_hashes(words.data, start, end), line_doc)
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=n).astype(np.int64)
    word_points = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(((words.data & 0xC0) != 0x80) & ~SPACE[words.data], out=word_points[1:])
    out["dup_line_chars"] = per_unit((word_points[end] - word_points[start])[again], line_doc[again], n)
    wanted = {rules.base_window, *(k for k, _ in rules.windows)}
    for k, at, keys in roll(word_hashes(words), doc, wanted):
        twice, _ = repeated(keys, doc[at])
        cover = covered(at[twice], k, len(doc))
        if k == rules.base_window:
            out["n_repeat_words"] = np.bincount(doc[cover], minlength=n).astype(np.int64)
        if k in dict(rules.windows):
            out[f"dup_{k}gram_chars"] = per_unit(length[cover], doc[cover], n)
    return out


class Verdict(NamedTuple):
    base_failed: np.ndarray
    kept: np.ndarray  # passes the base rules and those on repetition
    many_symbols: np.ndarray


def judge(found: dict[str, np.ndarray], rules: Rules) -> Verdict:
    words = found["n_words"]
    failed = (words < rules.min_words) | (100 * found["n_repeat_words"] > rules.repeat_words_pct * words)
    chars = np.maximum(found["word_chars"], 1)
    kept = ~failed & (found["dup_line_chars"] <= rules.line_chars * chars)
    for k, share in rules.windows:
        kept &= found[f"dup_{k}gram_chars"] <= share * chars
    return Verdict(failed, kept, found["n_symbols"] > rules.symbols * words)


def _columns(rules: Rules) -> list[str]:
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    return base + [f"dup_{k}gram_chars" for k, _ in rules.windows]


def measure_repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Per row: id, the counts, ``base_failed``, ``kept`` and ``many_symbols``."""
    names = _columns(rules)
    schema = T.StructType(
        [docs.schema[id_col]] + [T.StructField(c, T.LongType()) for c in names] + [T.StructField(c, T.BooleanType()) for c in Verdict._fields]
    )

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(1)):
                found = measures(batch.column(1).slice(first, n), rules)
                arrays = [batch.column(0).slice(first, n), *(pa.array(found[c]) for c in names), *map(pa.array, judge(found, rules))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def keep_unrepetitive(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows that pass all rules, also that on symbols, with all their columns."""
    place = docs.columns.index(text_col)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            for first, n in slices(texts):
                verdict = judge(measures(texts.slice(first, n), rules), rules)
                yield batch.slice(first, n).filter(pa.array(verdict.kept & ~verdict.many_symbols))

    return docs.mapInArrow(run, docs.schema)
