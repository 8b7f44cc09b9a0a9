"""What a word and a step of the language model cost, and that they stay what they are."""

import warnings

import numpy as np
import pyarrow as pa

from repoquarry.llm import recurrent_lm, words

TEXTS = pa.array(["a bB ccc É É\nxy $", "", None, "z", "The the THE\t\tend"])


def test_group_of_a_word_reads_two_bytes(monkeypatch):
    found = words.split_words(TEXTS)
    for lower in (True, False):
        spans = words.span_hashes(found.data, np.maximum(found.end - 2, found.start), found.end, lower)
        assert (words.tail_hashes(found, lower) == spans).all() and len(spans) == 12
    assert len(words.tail_hashes(words.split_words(pa.array(["", None])))) == 0
    hashed, whole = [], words.span_hashes
    for module in (words, recurrent_lm):
        monkeypatch.setattr(module, "span_hashes", lambda data, *rest, **more: hashed.append(len(data)) or whole(data, *rest, **more), raising=False)
    recurrent_lm.keys_of(TEXTS)
    assert hashed == [len(found.data)]  # the texts are gone through once


def test_step_is_a_gated_recurrent_unit():
    draw, n = np.random.default_rng(2), recurrent_lm.HIDDEN
    w = {k: draw.standard_normal(s) for k, s in recurrent_lm.SHAPES.items()}
    w["inputs"][3] *= 1e3  # exp goes beyond all bounds
    x, h = np.array([0, 3, 5, 3]), np.tanh(draw.standard_normal((4, n)))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        new, *parts = recurrent_lm.step(w, x, h)
    a, g = w["inputs"][x], h @ w["state"]
    z, r = (0.5 * (np.tanh(0.5 * (a + g)[:, k : k + n]) + 1) for k in (0, n))
    cand = np.tanh(a[:, 2 * n :] + r * g[:, 2 * n :])
    assert np.allclose(new, z * h + (1 - z) * cand) and all(np.allclose(p, q) for p, q in zip(parts, (z, r, cand, g[:, 2 * n :])))
    assert all(p.flags.c_contiguous for p in parts)  # parts of wider rows take several times as long


def test_logits_are_bounded_only_where_they_exceed():
    for top in (1.0, 79.0, 200.0):
        z = np.array([[top, 0.0, -3.0], [0.5, 0.0, 1.0]], np.float32)
        bounded = np.minimum(z, 80).astype(float)
        plain = bounded[[0, 1], [0, 2]] - np.log(np.exp(bounded).sum(axis=1))
        assert np.allclose(recurrent_lm._softmax_log(z, np.array([0, 2]), False), plain, atol=1e-5)
