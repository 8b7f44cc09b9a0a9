"""Token alignment against brute force over all token pairs, and on texts that break things."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from repoquarry.llm import token_alignment
from repoquarry.llm.queries import piece_path, tokenizer_path

TEXTS = [
    "Plain words stand here, and more words stand there.", None, "", " ", "  two  spaces  ", "line\nbreak\n\n and\ttab ", "naïve café déjà vu — “quoted” …", "日本語 テキスト 🙂🙂 x", "a▁b",
    "<s> a </s> <unk> <|endoftext|> <0x41>", "\x00\x0b odd spaces 　", "ﬁ ½ é ①", "x" * 400, "word " * 300, "Plain words stand here, and more words stand there.", "12,345.67 + 8e-9 = ?", "\n", "tail \n x \t",
]
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(tokenizer_path(), piece_path())


def encoded(text):
    """(ids, bytes) of both sides for the whole text, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    ids = a.encode(" " + text, add_special_tokens=False).ids
    own = token_alignment._byte_characters()
    one = [(i, bytes(own[c] for c in a.id_to_token(i))) for i in ids]
    model = sentencepiece.SentencePieceProcessor(model_file=piece_path())
    two = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p := model.id_to_piece(i)) else p.replace("▁", " ").encode()) for i in model.encode(text)]
    return one, two


def spans(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(texts):
    links, rows, held = [], [], Counter()
    for text in texts:
        one, two = encoded(text) if text else ([], [])
        if any(b"".join(d for _, d in x) != b" " + (text or "").encode() for x in (one, two)):
            one, two = [], []
        one, two = spans(one), spans(two)
        cuts = sorted({e for _, _, e in one} & {e for _, _, e in two})
        pairs = [(i, j) for i, s, e in one for j, t, f in two if s < f and t < e]
        low, groups = 0, []
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in x if low <= s and e <= cut) for x in (one, two)))
            low = cut
        links.append(pairs)
        held.update(set(pairs))
        line = ";".join(groups)
        rows.append([len(one), len(two), len(cuts), len(pairs), 0, 0, hashlib.sha256(line.encode()).hexdigest() if line else ""])
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    for row, pairs in zip(rows, links):
        row[4] = sum(held[p] == best[p[0]] for p in pairs)
        row[5] = sum(held[p] for p in pairs)
    return [tuple(r) for r in rows]


def test_parts_have_the_ids_of_whole_texts(aligner):
    for text, (a, b) in zip(TEXTS, aligner.parts.of_all(TEXTS)):
        one, two = encoded(text) if text else ([], [])
        if all(b"".join(d for _, d in x) == b" " + (text or "").encode() for x in (one, two)):
            assert (a, b) == tuple(b"".join(i.to_bytes(4, "little") for i, _ in x) for x in (one, two)), text
        else:
            assert (a, b) == (b"", b""), text


@pytest.mark.parametrize("hot_pairs", [1 << 20, 12, 0])
def test_counts_against_all_pairs(spark, hot_pairs):
    clashes = ["pair", "pairs", "times", "row", "n", "a", "best", "n_a", "groups_sha256", "more_best"]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").select(F.when(F.col("doc_id") != 5, F.col("doc_id")).alias("doc_id"), "text", *(F.lit(1).alias(c) for c in clashes))
    found = token_alignment.alignment_counts(docs.repartition(3), tokenizer_path(), piece_path(), hot_pairs=hot_pairs)
    assert sorted(found.columns) == sorted(["doc_id", *NUMBERS, "groups_sha256"])
    got = {r["doc_id"]: tuple(r[c] for c in [*NUMBERS, "groups_sha256"]) for r in found.collect()}
    expected = {(k if k != 5 else None): row for k, row in enumerate(brute(TEXTS))}
    assert got == expected and sum(r[3] for r in expected.values()) > 300


def test_groups_give_the_bytes(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in token_alignment.token_groups(docs, tokenizer_path(), piece_path()).collect():
        text = TEXTS[row["doc_id"]]
        one, two = encoded(text) if text else ([], [])
        if not row["groups"]:
            assert not text or "▁" in text or b"".join(d for _, d in two) != b" " + text.encode()
            continue
        data, (a, b) = b" " + text.encode(), ({i: d for i, d in x} for x in (one, two))
        assert [g["start"] for g in row["groups"]] == [0, *(g["end"] for g in row["groups"])][:-1] and row["groups"][-1]["end"] == len(data)
        for g in row["groups"]:
            assert data[g["start"] : g["end"]] == b"".join(a[i] for i in g["a"]) == b"".join(b[i] for i in g["b"])


def test_empty_table_and_one_very_long_text(spark):
    docs = spark.createDataFrame([(1, "some words of a long text, " * 40_000), (2, "some words")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in token_alignment.alignment_counts(docs, tokenizer_path(), piece_path()).collect()}
    assert rows[1]["n_groups"] > 200_000 and rows[2]["count_sum"] == 4
    assert token_alignment.alignment_counts(docs.limit(0), tokenizer_path(), piece_path()).count() == 0
