"""Packing of documents into fixed-length sequences by bounded-space best fit.

Documents become token ids in one pass over the texts, and their pieces are placed as they come: each task packs
its share online. Open sequences sit in a bitset by free space, so the best fit for a piece is
the lowest set bit at or above its length. At most ``open_bins`` are open; when one
more is needed, the fullest closes, and its pieces leave the task. Only what a task has open at its end is
shuffled: it is packed once more in the same bounded way, in tasks of up to ``TASK_PIECES`` pieces,
so that many small tasks do not leave many half-empty sequences.

Texts are split where a space or a line feed follows a character that is not white
space. No token of the byte-level tokenizer crosses such a place, so the ids of the
parts, kept in a bounded table (``part_ids``), are those of the whole text.

Defined cases: null and empty texts have the end id alone; a longer document is cut into
full pieces, of which the first may be shorter; equal rows are packed each for itself; an
empty table gives no sequence; a null id is carried; other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .part_ids import ByteLevel, PartIds
from .words import released, slices

SIZE = 2048
END_ID = 0
OPEN_BINS = 256
TASK_PIECES = 100_000  # pieces that one task packs in the second round
SLICE_BYTES = 4 << 20
BATCH_TOKENS = 2 << 20


class _Ids:
    """Ids of texts, as unsigned 32-bit numbers."""

    def __init__(self, path: str):
        side = ByteLevel(path)
        self.tokenizer, self.parts = side.tokenizer, PartIds([side])

    def of_column(self, column: pa.Array, end_id: int | None = None) -> Iterator[memoryview]:
        """Little-endian bytes of the ids of each text, followed by the end id if there is one."""
        ((ids, bounds),) = self.parts.of_column(column)
        if end_id is not None:
            ids, bounds = np.insert(ids.astype("<u4"), bounds[1:], end_id), bounds + np.arange(len(bounds))
        data = memoryview(ids.astype("<u4", copy=False)).cast("B")
        for lo, hi in itertools.pairwise((4 * bounds).tolist()):
            yield data[lo:hi]

    def of_all(self, texts: list[str | None]) -> list[bytes]:
        return [bytes(x) for x in self.of_column(pa.array(texts, pa.string()))]


_LOADED: dict[str, _Ids] = {}


def _ids(path: str) -> _Ids:
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = _Ids(path)
    return _LOADED[path]


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``size``."""
    first = length % size or size
    return [(0, min(first, length)), *((at, size) for at in range(first, length, size))]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Per piece: id, piece, start, length, ``ids_crc32`` and, if asked for, ``ids`` (little-endian unsigned 32 bits)."""
    schema, run = _cutter(docs.schema[id_col], tokenizer, size, end_id, with_ids)
    return docs.select(id_col, text_col).mapInArrow(released(run), schema)


def _cutter(id_field: T.StructField, tokenizer: str, size: int, end_id: int, with_ids: bool) -> tuple[T.StructType, Callable]:
    """The schema of pieces, and the function that makes them from batches of (id, text)."""
    fields = [id_field, *(T.StructField(c, T.LongType()) for c in ("piece", "start", "length", "ids_crc32"))]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(tokenizer).of_column

        def out() -> pa.RecordBatch:
            arrays = [keys.take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in held[:4])]
            return pa.RecordBatch.from_arrays(arrays + [pa.array(held[4], pa.binary())] * with_ids, names=schema.names)

        for batch in batches:
            keys, rows, held, size_held = batch.column(0), [], ([], [], [], [], []), 0
            for first, n in slices(batch.column(1), SLICE_BYTES):
                for row, ids in enumerate(ids_of(batch.column(1).slice(first, n), end_id), first):
                    for piece, (start, length) in enumerate(cuts(len(ids) // 4, size)):
                        part = ids[4 * start : 4 * (start + length)]
                        rows.append(row)
                        for column, value in zip(held, (piece, start, length, zlib.crc32(part), bytes(part) if with_ids else None)):
                            column.append(value)
                        size_held += 4 * length * with_ids
                if size_held > 8 << 20:
                    yield out()
                    rows, held, size_held = [], ([], [], [], [], []), 0
            if rows:
                yield out()

    return schema, run


class Packer:
    """Online best fit into sequences of ``size`` with at most ``open_bins`` open ones."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.bits, self.bins, self.n_open, self.made = 0, [[] for _ in range(size + 1)], 0, 0
        self.closed: list[int] = []  # since the caller last cleared it

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.bits ^= 1 << free
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if length < self.size and self.n_open >= self.open_bins:
                self.closed.append(self._take((self.bits & -self.bits).bit_length() - 1))  # the fullest
            sequence, free = self.made, self.size
            self.made += 1
        if left := free - length:
            self.bins[left].append(sequence)
            self.bits |= 1 << left
            self.n_open += 1
        else:
            self.closed.append(sequence)
        return sequence, self.size - free

    def still_open(self) -> set[int]:
        return {s for same in self.bins for s in same}


def _packed(rows: DataFrame, schema: T.StructType, pieces_of: Callable, size: int, open_bins: int, base: int) -> DataFrame:
    """Pieces, made from ``rows``, with sequence_id, offset and whether the sequence was open at the end of its task.

    A task holds the pieces of open sequences alone.
    """
    fields = [*schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("open", T.BooleanType())]
    place = schema.names.index("length")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held, done, tokens, types = Packer(size, open_bins), {}, [], 0, None
        first = base + (TaskContext.get().partitionId() << 32)

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.name for f in fields])

        for batch in pieces_of(batches):
            types = [*batch.schema.types, pa.int64(), pa.int64(), pa.bool_()]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                sequence, offset = packer.place(row[place])
                held.setdefault(sequence, []).append((*row, first + sequence, offset))
                for closed in packer.closed:
                    done.extend((*r, False) for r in held.pop(closed))
                    tokens += size
                packer.closed.clear()
                if tokens >= BATCH_TOKENS:
                    yield out()
                    done, tokens = [], 0
        done.extend((*r, True) for rest in held.values() for r in rest)
        if done:
            yield out()

    return rows.mapInArrow(run, T.StructType(fields))


def _twice(first: DataFrame, size: int, open_bins: int) -> DataFrame:
    """The pieces of a first round, those of sequences that were open at the end of a task packed again."""
    first = materialize(first)
    left = first.filter("open").drop("sequence_id", "offset", "open")
    keys = [c for c in left.columns if c != "ids"]
    tasks = left.count() // TASK_PIECES + 1
    order = [F.xxhash64(F.lit(7), *keys), *map(F.col, keys)]  # arbitrary, the same in every attempt
    dealt = left.repartition(tasks, F.xxhash64(*keys)).sortWithinPartitions(*order)
    second = _packed(dealt, left.schema, iter, size, open_bins, 1 << 62)
    return first.filter("not open").unionByName(second).drop("open")


def pack_pieces(pieces: DataFrame, size: int = SIZE, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces (id, piece, length, ..) with ``sequence_id`` and ``offset``; sequences hold ``size`` tokens at most."""
    return _twice(_packed(pieces, pieces.schema, iter, size, open_bins, 0), size, open_bins)


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID, open_bins: int = OPEN_BINS, with_ids: bool = False,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ``ids`` (little-endian unsigned 32 bits)."""
    schema, pieces_of = _cutter(docs.schema[id_col], tokenizer, size, end_id, with_ids)
    return _twice(_packed(docs.select(id_col, text_col), schema, pieces_of, size, open_bins, 0), size, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, ids (one binary of at most ``size`` ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("ids")).withColumn("ids", F.unhex("ids"))
