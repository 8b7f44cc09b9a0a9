"""Ids by parts against those of whole texts, and which parts reach a tokenizer."""

import random

import numpy as np
import pyarrow as pa
import pytest

from repoquarry.llm import best_fit_packing, token_alignment
from repoquarry.llm.part_ids import ByteLevel, PartIds
from repoquarry.llm.queries import piece_path, tokenizer_path


class Counted(ByteLevel):
    """Counts the bytes that it encodes."""

    n = 0

    def encode(self, text):
        self.n += len(text.encode())
        return super().encode(text)


def rows(found, n):
    return [[x.ids[x.bounds[i] : x.bounds[i + 1]].tolist() for x in found] for i in range(n)]


def odd_texts(n):
    """Texts of words, some of 22 to 25 bytes, and of all kinds of white space, control characters and wide characters."""
    draw = random.Random(3)
    pieces = ["a", "don't", "l'été", "Wörter", "12,5", "$$$", "日本", "🙂", "\x00", "\x1c", "\x85", "x" * 21, "x" * 22, "x" * 23, "x" * 24, "…", "ß", "a\x00", "﻿"]
    spaces = [" "] * 8 + ["\n"] * 3 + ["", "  ", "\n\n", " \n", "\n ", "\t", "\r\n", "　", "\xa0", " ", "  ", "\x85 ", "\x1f "]
    return ["".join(x for _ in range(draw.randrange(12)) for x in (draw.choice(pieces) + draw.choice(pieces)[: draw.randrange(3)], draw.choice(spaces))) for _ in range(n)]


@pytest.mark.parametrize("most", [40, 1_000_000])
def test_ids_of_parts_are_those_of_whole_texts(most):
    texts = [*odd_texts(600), None, "", " ", "\n", "  x", " \n x ", "é ", "é"]
    side = ByteLevel(tokenizer_path())
    parts = PartIds([side], most=most)
    for first in range(0, len(texts), 50):
        some = texts[first : first + 50]
        assert rows(parts.of_column(pa.array(some, pa.string())), len(some)) == [[side.encode(t) if t else []] for t in some]
    assert parts.n < 10_000


@pytest.mark.parametrize("most", [40, 1_000_000])
def test_both_sides_of_parts_are_those_of_whole_texts(most):
    texts = [*odd_texts(600), "a▁b c", "d e\nf", None, "", " ", "\n", "\nx", "x\n", "ﬁ½ a\nb"]
    sides = ByteLevel(tokenizer_path()), token_alignment.Pieces(piece_path())
    parts = token_alignment.BothIds(sides)
    parts.most = most
    assert parts.lines and parts.spaces
    for first in range(0, len(texts), 50):
        some = texts[first : first + 50]
        found = rows(parts.of_texts(pa.array(some, pa.string())), len(some))
        for text, ids in zip(some, found):
            whole = [list(side.encode(" " + text)) for side in sides] if text else [[], []]
            spelled = all(b"".join(side.entries[i] for i in x) == (" " + text).encode() for side, x in zip(sides, whole)) if text else True
            assert ids == (whole if spelled else [[], []]), text


def test_known_parts_reach_no_tokenizer_again():
    side = Counted(tokenizer_path())
    parts = PartIds([side])
    words = [f"{i:x}{'ghk'[i % 3]}" for i in range(200_000)]
    parts.of_column(pa.array([" ".join(words), "begin\n" + "\n".join(words)]))
    assert side.n <= 2 * sum(len(w) + 1 for w in words) + 10  # each after a space and after a line feed
    side.n = 0
    draw = random.Random(1)
    mixed = ["begin" + "".join(draw.choice(" \n") + draw.choice(words) for _ in range(300)) for _ in range(100)]
    parts.of_column(pa.array(mixed))
    assert side.n == 0


def test_parts_stay_with_a_worker(monkeypatch):
    """A worker's next task encodes nothing that it knows, in packing and alignment."""
    words = pa.array([" ".join(f"{i:x}z" for i in range(160_000))])
    ids = best_fit_packing._ids(tokenizer_path())
    list(ids.of_column(words, 0))
    known = ids.parts.n
    assert known >= 160_000 and best_fit_packing._ids(tokenizer_path()) is ids
    list(ids.of_column(words, 0))
    assert ids.parts.n == known
    assert token_alignment._aligner(tokenizer_path(), piece_path()) is token_alignment._aligner(tokenizer_path(), piece_path())


def test_end_ids_follow_every_text():
    ids = best_fit_packing._Ids(tokenizer_path())
    texts = ["one two", None, "", "one\ntwo "]
    found = [np.frombuffer(x, "<u4").tolist() for x in ids.of_column(pa.array(texts), 7)]
    assert found == [[*(ids.tokenizer.encode(t).ids if t else []), 7] for t in texts]
