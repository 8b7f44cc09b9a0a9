"""Language identification: subwords and gradients by brute force, held-out accuracy, rows that break things."""

import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repoquarry.llm import language_id
from repoquarry.llm.queries import in_fold
from repoquarry.llm.words import string_hashes

FOLDER = "/root/testdata/sf0.01"


def pieces(text):
    """Subwords of a text, the slow way."""
    low = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
    out = Counter()
    for word in low.split():
        line = b" " + word.encode() + b" "
        out[word.encode()] += 1
        for n in language_id.PIECES:
            for i in range(len(line) - n + 1):
                out[n, line[i : i + n]] += 1
    return out


def bucket_of(piece):
    if isinstance(piece, bytes):
        return int(string_hashes([piece.decode()])[0]) >> (64 - language_id.BITS)
    n, data = piece
    value = 0
    for byte in data:
        value = (value * int(language_id._ROLL) + int(language_id._KEYS[byte])) % 2**64
    return (((value ^ n) * int(language_id._SPREAD)) % 2**64) >> (64 - language_id.BITS)


@pytest.mark.parametrize("step", [1 << 20, 8])
def test_subwords_against_brute_force(monkeypatch, step):
    monkeypatch.setattr(language_id, "_STEP", step)
    texts = ["Über ÉTÉ, don't! x", "", "12 3.4 --", "a", "ends here", "日本 語", " \n\t two  words "]
    found = [Counter() for _ in texts]
    for doc, bucket in language_id.subwords(pa.array(texts)):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            found[d][b] += 1
    for text, got in zip(texts, found):
        expected = Counter()
        for piece, n in pieces(text).items():
            expected[bucket_of(piece)] += n
        assert got == expected, text


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(4)
    e, w, b = r.normal(size=(8, 3)), r.normal(size=(3, 4)), r.normal(size=4)
    bucket, starts, label = np.array([0, 1, 1, 5, 7, 2]), np.array([0, 3, 5]), np.array([2, 0, 3])
    _, de, dw, db = language_id.gradients(e, w, b, bucket, starts, label)

    def loss():
        return language_id.gradients(e, w, b, bucket, starts, label)[0]

    for values, found in ((e, de), (w, dw), (b, db)):
        for at in np.ndindex(values.shape):
            kept = values[at]
            values[at] = kept + 1e-6
            high = loss()
            values[at] = kept - 1e-6
            low = loss()
            values[at] = kept
            assert abs((high - low) / 2e-6 - found[at]) < 1e-6


def test_windows_are_spread_over_the_text():
    text = " ".join(f"w{i}" for i in range(100))
    found = {k: w.split() for i, k, w in language_id.windows_of(pa.array(["", text, "one two"])) if i == 1}
    assert [len(found[k]) for k in range(4)] == [32, 16, 8, 4] and found[0][0] == "w0" and found[3][-1] == "w99"
    assert [w for i, _, w in language_id.windows_of(pa.array(["one two"]))] == ["one two"] * 4


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.fit(docs, ~in_fold("doc_id", 4, 2))
    assert model.languages == ("de", "en", "es", "fr") and 0 < model.least < 1
    held = docs.filter(in_fold("doc_id", 4, 2))
    rows = language_id.identify(held, model).join(held, "doc_id").select("lang", "lang_pred", "score", "accepted").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97 and all(0 < r["score"] <= 1 for r in rows)
    taken = [r for r in rows if r["accepted"]]
    assert len(taken) > 0.8 * len(rows) and np.mean([r["lang"] == r["lang_pred"] for r in taken]) > 0.98
    strange = spark.createDataFrame([(1, "日本語の文章です"), (2, "привет как дела сегодня")], "doc_id long, text string")
    assert not any(r["accepted"] for r in language_id.identify(strange, model).collect())


def test_more_tasks_than_texts(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TASK_WINDOWS", 1)
    monkeypatch.setattr(language_id, "STEPS", 1)
    rows = [(i, "the house of the king" if i % 2 else "la casa del rey", "en" if i % 2 else "es") for i in range(4)]
    assert language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True)).languages == ("en", "es")


def test_rows_that_break_things(spark):
    clashes = ["lang_pred", "score", "accepted", "h", "k", "words", "_text", "_lang", "_h", "_times", "at", "n"]
    long = "los caminos de la noche " * 60_000
    rows = [(1, "the house of the king and the road", "en"), (2, "la casa del rey y el camino largo", "es"), (3, None, "en"), (4, "", "es"), (5, "12 + 3!", "en"), (6, "²³ — …", "en"),
            (7, long, None), (None, "the road to the house", "en"), (8, "the road to the house", "en"), (8, "the road to the house", "en"), (9, "ª", "es"), (10, "ЖД", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *(F.lit(1).alias(c) for c in clashes))
    model = language_id.fit(docs, F.lit(True))
    assert model.languages == ("en", "es")
    found = language_id.identify(docs, model)
    assert found.columns == ["doc_id", "lang_pred", "score", "accepted"]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in found.collect()]
    assert len(got) == len(rows)
    none = {i for i, lang, score in got if lang == "und"}
    assert none == {3, 4, 5, 6} and all(score == 0 for _, lang, score in got if lang == "und")
    assert len({(lang, score) for i, lang, score in got if i in (8, None)}) == 1
    assert language_id.identify(docs.limit(0), model).count() == 0
    unlearned = language_id.fit(docs, F.lit(False))
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in language_id.identify(docs, unlearned).collect()} == {("und", 0.0, False)}
    assert language_id.fit(docs.limit(0), F.lit(True)).languages == ()
