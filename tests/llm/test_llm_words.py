"""Byte-level words, hashes and windows against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from repoquarry.llm import repetition_rules as R
from repoquarry.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab Aé\n\t\u00a0#", max_size=60)), min_size=1, max_size=6)


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_and_hashes(rows):
    column = pa.array(rows, pa.string())
    words = W.split_words(column)
    expected = [(i, w) for i, t in enumerate(rows) for w in WORD.findall(t or "")]
    assert [(int(d), words.text(i)) for i, d in enumerate(words.doc)] == expected
    exact, lower = W.word_hashes(words), W.word_hashes(words, lower=True)
    assert len(set(exact.tolist())) == len({w for _, w in expected})
    fold = str.maketrans("AB", "ab")
    assert len(set(lower.tolist())) == len({w.translate(fold) for _, w in expected})
    assert W.string_hashes([w for _, w in expected]).tolist() == exact.tolist() if expected else True


@given(texts, st.integers(1, 4))
@settings(max_examples=100, deadline=None)
def test_windows(rows, n):
    words = W.split_words(pa.array(rows, pa.string()))
    [(length, at, keys)] = list(W.roll(W.word_hashes(words), words.doc, [n]))
    expected = [(i, tuple(w[j : j + n])) for i, t in enumerate(rows) for w in [WORD.findall(t or "")] for j in range(len(w) - n + 1)]
    assert length == n and words.doc[at].tolist() == [i for i, _ in expected]
    names = {}
    assert all(names.setdefault(key, window) == window for key, (_, window) in zip(keys.tolist(), expected))
    assert len(names) == len({window for _, window in expected})


def test_slices_hold_whole_texts():
    column = pa.array(["a" * 10, None, "b" * 50, "c", "d" * 5])
    assert list(W.slices(column, 12)) == [(0, 2), (2, 1), (3, 2)]
    assert list(W.slices(pa.array([], pa.string()))) == []


def test_hashes_do_not_depend_on_the_step():
    text = " ".join(f"w{i % 997}" for i in range(400_000))  # longer than a step
    words = W.split_words(pa.array([text, "w5 w6"]))
    hashes = W.word_hashes(words)
    assert len(set(hashes.tolist())) == 997 and hashes[-2:].tolist() == hashes[5:7].tolist()


def brute_measures(text, rules):
    text = text or ""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen, out["n_dup_lines"], out["dup_line_chars"] = set(), 0, 0
    for line in lines:
        if line in seen:
            out["n_dup_lines"] += 1
            out["dup_line_chars"] += sum(map(len, WORD.findall(line)))
        seen.add(line)
    for k in sorted({rules.base_window, *dict(rules.windows)}):
        windows = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        often = Counter(windows)
        cover = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + k)}
        if k == rules.base_window:
            out["n_repeat_words"] = len(cover)
        if k in dict(rules.windows):
            out[f"dup_{k}gram_chars"] = sum(len(words[j]) for j in cover)
    return out


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n#", max_size=120)), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_repetition_measures(rows):
    rules = R.Rules(windows=((2, 0.5), (4, 0.5)))
    found = R.measures(pa.array(rows, pa.string()), rules)
    for i, text in enumerate(rows):
        assert {k: int(v[i]) for k, v in found.items()} == brute_measures(text, rules)


def test_covered():
    assert R.covered(np.array([1, 2, 5]), 2, 7).tolist() == [False, True, True, True, False, True, True]
