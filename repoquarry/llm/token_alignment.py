"""Alignment of the tokens of two tokenizers, and how often their tokens meet in a corpus.

Both tokenizers read a text once and give spans of the same bytes. A slice of texts becomes two
pandas tables of (document, start), and ``merge_asof``, keyed by the document, finds for
each token start of one side the token of the other side that covers it. Two tokens overlap exactly if
one covers the other's start, so the two directions together give all links; bytes
where tokens of both sides end cut them into groups.

An id pair counts the documents that hold it linked. What a document needs for that, its different pairs and
how often each is linked, is written once in the shared folder (sorted, as deltas of 32 or 64 bits) and read twice: to
count, combined on the map side, and to look counts up. The most frequent pairs, at most ``hot_pairs``, are broadcast;
occurrences of all others are joined by a shuffle. The best count of an id is one row of the first vocabulary.

Byte-level entries stand for a byte with each character. Pieces are UTF-8 with U+2581 for a space and
<0xHH> for a byte; they begin with the space that is added to the text. The first side therefore reads a space and
the text. Strings of special tokens in a text are ordinary text.

Defined cases: null and empty texts, and texts whose tokens of either side do not
spell the space and the text (a normaliser changed them, or U+2581 stands in them), have no tokens, zeros
and an empty digest; equal rows count one by one as documents; null ids are carried; a very long text is
one slice; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shared_folder
from .part_ids import ByteLevel, Ids, PartIds, _byte_characters
from .words import released, slices

HOT_PAIRS = 1 << 20
SLICE_BYTES = 1 << 20
GROUPS = "array<struct<start:long,end:long,a:array<int>,b:array<int>>>"


class Pieces:
    """A sentencepiece tokenizer that adds a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.entries = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) and re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.crosses_spaces = any("▁" in p.lstrip("▁") for p in pieces)
        self.holds_lines = any("\n" in p for p in pieces)
        self.space = self.model.piece_to_id("▁")

    def encode(self, text: str) -> list[int]:
        """Ids of a text that begins with a space, or with a line feed that follows other text."""
        if text == " ":
            return [self.space]  # the model adds no space to nothing
        if text[0] == " ":
            return self.model.encode(text[1:], num_threads=1)
        ids = self.model.encode(text, num_threads=1)
        return ids[1:] if ids[:1] == [self.space] else []  # without the space that the model adds


class BothIds(PartIds):
    """Ids of a space and the text for both sides; none for texts that a side does not spell."""

    def __init__(self, sides: tuple):
        super().__init__(sides, spaces=not sides[1].crosses_spaces, lines=not sides[1].holds_lines, checked=True)

    def of_texts(self, column: pa.Array) -> list[Ids]:
        """Null and empty texts have no ids."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        return self.of_column(pc.if_else(pc.equal(column, nothing), nothing, pc.binary_join_element_wise(space, column, nothing)))

    def of_all(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of both sides for each text, as little-endian 32-bit numbers."""
        found = self.of_texts(pa.array(texts, pa.string()))
        return [tuple(x.ids[x.bounds[i] : x.bounds[i + 1]].astype("<i4").tobytes() for x in found) for i in range(len(texts))]


class Tokens(NamedTuple):
    """Tokens of all usable texts of a slice; places count the bytes of these texts, each after a space."""

    id: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


class Aligned(NamedTuple):
    base: np.ndarray  # place of each text, and the end of the last; unusable texts have no bytes
    a: Tokens
    b: Tokens
    group_a: np.ndarray  # numbered over the slice
    group_b: np.ndarray
    ends: np.ndarray  # place where each group ends
    link_a: np.ndarray  # indices into a and b
    link_b: np.ndarray


def _tokens(ids: Ids, sizes: np.ndarray) -> Tokens:
    flat = ids.ids.astype(np.int64)
    doc = np.repeat(np.arange(len(ids.bounds) - 1), np.diff(ids.bounds))
    end = np.cumsum(sizes[flat])
    return Tokens(flat, doc, end - sizes[flat], end)


def covering(one: Tokens, two: Tokens) -> np.ndarray:
    """For each token of ``one``, the token of ``two`` that covers its start."""
    left = pd.DataFrame({"doc": one.doc, "start": one.start})
    right = pd.DataFrame({"doc": two.doc, "start": two.start, "token": np.arange(len(two.id))})
    return pd.merge_asof(left, right, on="start", by="doc")["token"].to_numpy().astype(np.int64)


class Aligner:
    def __init__(self, byte_level: str, pieces: str):
        self.parts = BothIds((ByteLevel(byte_level), Pieces(pieces)))
        self.n_a, self.n_b = (len(sizes) for sizes in self.parts.sizes)
        self.strings = [f"{i}{c}" for size, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for c in marks for i in range(size)]

    def align(self, texts: pa.Array) -> Aligned:
        a, b = map(_tokens, self.parts.of_texts(texts), self.parts.sizes)
        base = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.bincount(a.doc, weights=a.end - a.start, minlength=len(texts)).astype(np.int64), out=base[1:])
        cover_b, cover_a = covering(a, b), covering(b, a)
        inner = np.flatnonzero(b.start > a.start[cover_a]) if len(b.id) else cover_a  # those that start together are found from the first side
        ends = np.intersect1d(a.end, b.end, assume_unique=True)
        return Aligned(base, a, b, np.searchsorted(ends, a.end), np.searchsorted(ends, b.end), ends, np.concatenate([np.arange(len(a.id)), cover_a[inner]]), np.concatenate([cover_b, inner]))

    def digests(self, x: Aligned) -> list[str]:
        """SHA-256 of the ids in groups, ``a1,a2|b1;a3|b2,b3``."""
        n_groups, n_docs = len(x.ends), len(x.base) - 1
        in_a, in_b = np.bincount(x.group_a, minlength=n_groups), np.bincount(x.group_b, minlength=n_groups)
        code = np.empty(len(x.a.id) + len(x.b.id), np.int64)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (x.group_a, x.group_b))
        code[np.arange(len(x.a.id)) + (np.cumsum(in_b) - in_b)[x.group_a]] = x.a.id + self.n_a * last_a
        code[np.arange(len(x.b.id)) + np.cumsum(in_a)[x.group_b]] = 2 * self.n_a + x.b.id + self.n_b * last_b
        sizes = np.bincount(x.a.doc, minlength=n_docs) + np.bincount(x.b.doc, minlength=n_docs)
        edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        code = code.tolist()
        texts = ("".join(map(self.strings.__getitem__, code[lo:hi]))[:-1] for lo, hi in zip(edges, edges[1:]))
        return [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]

    def groups(self, x: Aligned) -> list[list[dict]]:
        """Groups of each text, with their bytes of the space and the text."""
        out = [[] for _ in x.base[1:]]
        at_a, at_b = (np.searchsorted(g, np.arange(len(x.ends) + 1)) for g in (x.group_a, x.group_b))
        start = 0
        for k, end in enumerate(x.ends.tolist()):
            doc = int(x.a.doc[at_a[k]])
            base = int(x.base[doc])
            out[doc].append({"start": start - base, "end": end - base, "a": x.a.id[at_a[k] : at_a[k + 1]].tolist(), "b": x.b.id[at_b[k] : at_b[k + 1]].tolist()})
            start = end
        return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def _aligner(byte_level: str, pieces: str) -> Aligner:
    """The worker's aligner, with the parts that it knows from tasks before."""
    if (byte_level, pieces) not in _LOADED:
        _LOADED.clear()
        _LOADED[byte_level, pieces] = Aligner(byte_level, pieces)
    return _LOADED[byte_level, pieces]


def token_groups(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``groups`` (bytes of the space and the text, ids of both sides)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        for batch in batches:
            for first, n in slices(batch.column(1), SLICE_BYTES):
                found = aligner.groups(aligner.align(batch.column(1).slice(first, n)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(found, kind)], names=[id_col, "groups"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, groups {GROUPS}")


def _document_pairs(docs: DataFrame, byte_level: str, pieces: str, id_col: str, text_col: str, wide: bool) -> DataFrame:
    """Per row: its numbers, its different id pairs in order, and how often each is linked."""
    id_type, pair = docs.schema[id_col].dataType.simpleString(), "long" if wide else "int"
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    pair_type = pa.int64() if wide else pa.int32()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        for batch in batches:
            for first, n in slices(batch.column(1), SLICE_BYTES):
                x = aligner.align(batch.column(1).slice(first, n))
                link_doc = x.a.doc[x.link_a]
                of_group = np.searchsorted(x.base, x.ends, side="left") - 1
                key = x.a.id[x.link_a] * aligner.n_b + x.b.id[x.link_b]
                size = aligner.n_a * aligner.n_b  # n texts of a slice times this stay far below 2^63
                doc, key = np.divmod(np.sort(link_doc * size + key), size)
                new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))[: len(key)])
                edges = np.searchsorted(doc[new], np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in (key[new].astype(pair_type.to_pandas_dtype()), np.diff(np.append(new, len(key))).astype(np.int32))]
                counts = [pa.array(np.bincount(d, minlength=n).astype(np.int64)) for d in (x.a.doc, x.b.doc, of_group, link_doc)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *counts, pa.array(aligner.digests(x), pa.string()), *lists], names=names)

    numbers = ", ".join(f"{c} long" for c in names[1:5])
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {numbers}, groups_sha256 string, pairs array<{pair}>, times array<int>")


def _hot(counts: DataFrame, hot_pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(pairs in order, counts, whether best, least count) of the most frequent pairs, ``hot_pairs`` at most."""
    sizes = counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("size")).count().orderBy(F.desc("size")).collect()  # a few hundred rows
    least, held = 1 << 62, 0
    for size, n in sizes:
        if (held := held + n) > hot_pairs:
            break
        least = size
    found = counts.filter(F.floor(F.log2("n") * 4) >= least).select("pair", "n", "best").toArrow()
    order = np.argsort(found.column("pair").to_numpy())
    return (*(found.column(c).to_numpy()[order] for c in ("pair", "n", "best")), least)


def alignment_counts(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/alignment-{uuid.uuid4()}"
    sides = Aligner(byte_level, pieces)
    n_b, wide = sides.n_b, sides.n_a * sides.n_b >= 1 << 31
    found = _document_pairs(docs, byte_level, pieces, id_col, text_col, wide)
    found.write.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    counts = stored.select(F.explode("pairs").alias("pair")).groupBy(F.col("pair").cast("long").alias("pair")).agg(F.count("*").alias("n"))
    counts = materialize(counts.withColumn("a", F.expr(f"pair div {n_b}")))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # a row for an entry of the vocabulary at most
    counts = counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    *tables, least = _hot(counts, hot_pairs)
    hot = spark.sparkContext.broadcast(tables)
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "pairs", "times"]
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = hot.value
        for batch in batches:
            rows = batch.num_rows
            lists = [batch.column(c) for c in (6, 7)]
            key, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            doc = np.repeat(np.arange(rows), np.diff(lists[0].offsets.to_numpy()))
            at = np.searchsorted(pair, key)
            known = np.append(pair, -1)[at] == key
            at, of, held = at[known], doc[known], times[known]
            sums = (np.zeros(rows, np.int64), np.zeros(rows, np.int64))
            np.add.at(sums[0], of, held * best[at])
            np.add.at(sums[1], of, held * n[at])
            edges = np.searchsorted(doc[~known], np.arange(rows + 1)).astype(np.int32)
            rare = [pa.ListArray.from_arrays(edges, pa.array(v[~known])) for v in (key, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(5)), *map(pa.array, sums), batch.column(5), *rare], names=names)

    numbers = ", ".join(f"{c} long" for c in names[1:7])
    looked = materialize(stored.mapInArrow(run, f"`{id_col}` {id_type}, {numbers}, groups_sha256 string, pairs array<long>, times array<long>"))
    looked = looked.withColumn("row", F.monotonically_increasing_id())
    rare = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    rest = counts.filter(F.floor(F.log2("n") * 4) < least)
    sums = rare.join(rest, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = looked.drop("pairs", "times").join(sums, "row", "left")
    more = {c: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))}
    return out.select(f"`{id_col}`", "n_a", "n_b", "n_groups", "n_links", more["n_best"], more["count_sum"], "groups_sha256")
