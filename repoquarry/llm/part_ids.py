"""Token ids of the parts of texts, for all texts of a slice at once.

A part begins at a space, or at a line feed where no token goes on across one, that follows a character that is not white
space; what comes before the first such place of a text is a part too. No token crosses these places, so the ids of
the parts are those of the whole text. Parts are numpy spans of the UTF-8 bytes; those of up to ``KEY_BYTES`` bytes are three numbers,
which hold all of their bytes and their length, so that a look-up compares parts exactly. Only new parts reach a tokenizer: many
are encoded as one text, and the places where tokens end say which ids are whose.

The table stays with a worker for its next tasks, at some 60 bytes a part and 20 more for a second side. It is bounded: where a slice finds
more than ``MOST_PARTS`` in it, it goes back to the half that came first, the frequent ones among them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple, Protocol

import numpy as np
import pyarrow as pa

from .words import text_bytes

_U = np.uint64
KEY_BYTES = 23
MOST_PARTS = 1_000_000
TOGETHER = 512  # parts that are encoded as one text; a pieces tokenizer takes longer for each byte of long ones
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)
_SPACES = np.array(sorted(int.from_bytes(chr(c).encode(), "big") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


class Side(Protocol):
    """A tokenizer: the bytes of its entries by id, and the ids of a text that begins as it would stand in a longer one."""

    entries: list[bytes]

    def encode(self, text: str) -> Sequence[int]: ...


def _byte_characters() -> dict[str, int]:
    """Bytes by the characters that stand for them: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        byte_of, vocabulary = _byte_characters(), self.tokenizer.get_vocab()
        self.entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.entries[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


class Ids(NamedTuple):
    """Ids of one side: those of text i are ids[bounds[i]:bounds[i + 1]]."""

    ids: np.ndarray
    bounds: np.ndarray


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. (size[0] numbers), first[1], .."""
    edges = np.cumsum(size)
    return np.arange(edges[-1] if len(edges) else 0) + np.repeat(first - edges + size, size)


def _after_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space, or a control character, stands before each place (of 1 at least)."""
    last = data[at - 1].astype(np.int64)
    out = last <= 0x20
    wide = np.flatnonzero(last >= 0x80)
    two = data[at[wide] - 2].astype(np.int64) << 8 | last[wide]
    three = data[np.maximum(at[wide] - 3, 0)].astype(np.int64) << 16 | two
    out[wide] = np.isin(two, _SPACES) | np.isin(three, _SPACES)
    return out


class PartIds:
    """Ids of texts for every side, by a table of parts. With ``checked``, texts that a side does not spell have none."""

    def __init__(self, sides: Sequence[Side], spaces: bool = True, lines: bool = True, checked: bool = False, most: int = MOST_PARTS):
        self.sides, self.spaces, self.lines, self.checked, self.most = sides, spaces, lines and spaces, checked, most
        self.sizes = [np.array([len(x) for x in side.entries], np.int64) for side in sides]
        self.firsts = [np.cumsum(x) - x for x in self.sizes]
        self.bytes = [np.frombuffer(b"".join(side.entries), np.uint8) for side in sides] if checked else []
        self.slots = np.full(1 << 13, -1, np.int32)
        self.n = 0
        self.keys = np.empty((3, 1 << 12), _U)
        self.bad = np.empty(1 << 12, bool)
        self.edges = [np.zeros((1 << 12) + 1, np.int64) for _ in sides]  # ids of part e: held[edges[e]:edges[e + 1]]
        self.held = [np.empty(1 << 14, np.int32) for _ in sides]

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First bytes of all parts."""
        begins = bounds[:-1][bounds[1:] > bounds[:-1]]
        if not self.spaces:
            return begins
        cut = data == 0x20
        if self.lines:
            cut |= data == 0x0A
        cut[1:] &= data[:-1] > 0x20
        cut[begins] = False
        at = np.flatnonzero(cut)
        wide = np.flatnonzero(data[at - 1] >= 0x80)
        cut[at[wide[_after_space(data, at[wide])]]] = False
        cut[begins] = True
        return np.flatnonzero(cut)

    @staticmethod
    def _keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        padded = np.append(data, np.zeros(24, np.uint8))
        eights = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        keys = np.zeros((3, len(start)), _U)
        keys[0] = eights[start] & _MASKS[np.minimum(size, 8)]
        for k in (1, 2):
            more = np.flatnonzero(size > 8 * k)
            keys[k, more] = eights[start[more] + 8 * k] & _MASKS[np.minimum(size[more] - 8 * k, 8 if k < 2 else 7)]
        keys[2] |= size.astype(_U) << _U(56)
        return keys

    def _places(self, keys: np.ndarray) -> np.ndarray:
        h = keys[0] * _U(0x9E3779B97F4A7C15)
        for k in (1, 2):
            h ^= h >> _U(31)
            h += keys[k]
            h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        h *= _U(0x94D049BB133111EB)
        return (h >> _U(64 - (len(self.slots) - 1).bit_length())).astype(np.int64)

    def _find(self, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Part of each key, or -1."""
        out = self.slots[at]
        live = np.flatnonzero(out >= 0)
        at = at.copy()
        while len(live):
            live = live[(self.keys[:, out[live]] != keys[:, live]).any(axis=0)]
            at[live] = (at[live] + 1) & (len(self.slots) - 1)
            out[live] = self.slots[at[live]]
            live = live[out[live] >= 0]
        return out

    def _enter(self, first: int, n: int) -> None:
        """Slots for the n parts from ``first`` on, which differ."""
        if len(self.slots) < 2 * (first + n):
            self.slots = np.full(1 << (2 * (first + n)).bit_length(), -1, np.int32)
            first, n = 0, first + n
        at, live = self._places(self.keys[:, first : first + n]), np.arange(n)
        while len(live):
            free = live[self.slots[at[live]] < 0]
            self.slots[at[free]] = first + free
            live = live[self.slots[at[live]] != first + live]
            at[live] = (at[live] + 1) & (len(self.slots) - 1)

    def _grow(self, n: int, ids: list[int]) -> None:
        """Room for n more parts and their ids."""
        if (need := self.n + n) > len(self.bad):
            size = max(need, 2 * len(self.bad))
            keys = np.empty((3, size), _U)
            keys[:, : self.n] = self.keys[:, : self.n]
            self.keys, self.bad = keys, np.resize(self.bad, size)
            self.edges = [np.resize(x, size + 1) for x in self.edges]
        for k, more in enumerate(ids):
            if (need := int(self.edges[k][self.n]) + more) > len(self.held[k]):
                self.held[k] = np.resize(self.held[k], max(need, 2 * len(self.held[k])))

    def shrink(self, most: int) -> None:
        """Keep the parts that came first."""
        if self.n > most:
            self.n = most
            self.keys, self.bad = self.keys[:, :most].copy(), self.bad[:most].copy()
            self.edges = [x[: most + 1].copy() for x in self.edges]
            self.held = [x[: e[most]].copy() for x, e in zip(self.held, self.edges)]
            self.slots.fill(-1)
            self._enter(0, most)

    def _spelled(self, k: int, ids: np.ndarray, text: bytes) -> bool:
        sizes = self.sizes[k][ids]
        if sizes.sum() != len(text):
            return False
        return self.bytes[k][ragged(self.firsts[k][ids], sizes)].tobytes() == text

    def _encoded(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]]:
        """(ids of each side, how many each part has, which parts are not spelled) for stretches of the parts, encoded together."""
        text = data[ragged(start, size)].tobytes()
        ids = [np.array(side.encode(text.decode()), np.int32) for side in self.sides]
        ends, counts = np.cumsum(size), []
        good = not self.checked or all(self._spelled(k, x, text) for k, x in enumerate(ids))
        if good:
            for x, sizes in zip(ids, self.sizes):
                reached = np.cumsum(sizes[x])
                last = np.searchsorted(reached, ends)
                counts.append(np.diff(last + 1, prepend=0))
                good &= bool((reached[last] == ends).all())
        if good:
            return [(ids, counts, np.zeros(len(start), bool))]
        if len(start) == 1:
            return [([np.zeros(0, np.int32)] * len(ids), [np.zeros(1, np.int64)] * len(ids), np.ones(1, bool))]
        half = len(start) // 2
        return self._encoded(data, start[:half], size[:half]) + self._encoded(data, start[half:], size[half:])

    def _learn(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Add parts; their numbers. Those that end in white space or do not begin with a cut are encoded alone."""
        lead = data[start]
        alone = ~((lead == 0x20) | (lead == 0x0A) & self.lines) | _after_space(data, start + size) | (not self.spaces)
        together, single = np.flatnonzero(~alone), np.flatnonzero(alone)
        found = []
        for i in range(0, len(together), TOGETHER):
            found += self._encoded(data, start[together[i : i + TOGETHER]], size[together[i : i + TOGETHER]])
        for i in single.tolist():
            found += self._encoded(data, start[i : i + 1], size[i : i + 1])
        if not found:
            return np.zeros(0, np.int64)
        n, first = len(start), self.n
        self._grow(n, [sum(len(x[0][k]) for x in found) for k in range(len(self.sides))])
        for k, (held, edges) in enumerate(zip(self.held, self.edges)):
            counts = np.concatenate([x[1][k] for x in found])
            ids = np.concatenate([x[0][k] for x in found])
            held[edges[first] : edges[first] + len(ids)] = ids
            edges[first + 1 : first + n + 1] = edges[first] + np.cumsum(counts)
        self.bad[first : first + n] = np.concatenate([x[2] for x in found])
        self.n += n
        out = np.empty(n, np.int64)
        out[np.concatenate([together, single])] = np.arange(first, first + n)
        return out

    def of_column(self, column: pa.Array) -> list[Ids]:
        """Ids of all texts, for each side; null texts are empty."""
        data, bounds = text_bytes(column)
        if self.n > self.most:
            self.shrink(self.most // 2)
        start = self._starts(data, bounds)
        size = np.diff(start, append=len(data))
        short = size <= KEY_BYTES
        keys = self._keys(data, start, np.where(short, size, 0))
        part = self._find(keys, self._places(keys)).astype(np.int64)
        new = np.flatnonzero((part < 0) & short)
        if len(new):
            order = new[np.lexsort(keys[:, new])]
            differs = np.append(True, (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0))
            distinct, first = order[differs], self.n
            found = self._learn(data, start[distinct], size[distinct])
            self.keys[:, found] = keys[:, distinct]
            self._enter(first, len(found))
            part[order] = found[np.cumsum(differs) - 1]
        kept = self.n
        if len(long := np.flatnonzero(~short)):  # these are not kept
            numbers: dict[bytes, int] = {}
            which = np.array([numbers.setdefault(data[a : a + n].tobytes(), len(numbers)) for a, n in zip(start[long].tolist(), size[long].tolist())])
            distinct = long[np.unique(which, return_index=True)[1]]
            part[long] = self._learn(data, start[distinct], size[distinct])[which]
        in_doc = np.searchsorted(start, bounds)
        usable = np.ones(len(start), bool)
        if self.checked and (bad := np.flatnonzero(self.bad[part])).size:
            of = np.searchsorted(bounds, start, side="right")
            usable = ~np.isin(of, of[bad])
        out = []
        for held, edges in zip(self.held, self.edges):
            first = edges[part]
            counts = (edges[part + 1] - first) * usable
            out.append(Ids(held[ragged(first, counts)], np.append(0, np.cumsum(counts))[in_doc]))
        self.n = kept
        return out
