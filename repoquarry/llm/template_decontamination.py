"""Benchmark decontamination by templates.

Words lose the punctuation around them and their case. In a template, numbers, units
after a number, and names (capitalised words inside a sentence) become typed
placeholders; in a second, loose template also capitalised words that begin a sentence, which
may be names or not. Windows of ``WINDOW`` words of benchmark items, as they are and as
templates, are hash-joined with those of all documents. Where template windows match,
the values of their slots are compared along the alignment of item and document: one value of the
item has to stand for one value of the document throughout, and windows with a
deviating slot do not count. So a question asked again with other numbers and names is
found, and a chance match of a common phrase is not.

Template windows with fewer than ``MIN_LITERALS`` words that are not placeholders are dense. Their hash also
holds the operators (``+ - * /`` and the like) that stand alone between their words, and they count only
if, along one alignment, consistent windows cover every word of the item that a template window can
cover. Windows of placeholders alone, without literal words and with few operators, are not made.

A document holds an item if consistent windows cover ``MIN_SHARE`` of the item's words, or
``MIN_WORDS`` of them.

Windows of documents that no item can have are dropped where they are made, by a bitmap
of ``FILTER_BITS`` bits made from the items' windows. Its size is fixed; when many items fill it,
more windows go on to the join, never fewer. Only windows that pass are shuffled; the
texts are not. A passage that a third of the documents share is a hot key on one side of an inner join
whose other side holds one row for each item window, which adaptive execution splits.

Defined cases: null and empty texts hold nothing; items with fewer than ``MIN_ITEM`` words are not
looked for, and those shorter than the window are looked for whole; equal rows give
equal pairs once; null ids are carried; an empty table on either side gives no pair; a very long text is
scanned whole like any other; other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import Words, mix, released, roll, slices, span_hashes, split_words, string_hashes

_U = np.uint64
WINDOW = 8
MIN_ITEM = 4
MIN_LITERALS = 4  # words that are not placeholders, of a template window that counts by itself
MIN_SHARE = 0.5
MIN_WORDS = 25
FILTER_BITS = 23

# Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz t ton tons tonne tonnes ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years % percent "
    "usd eur dollar dollars euro euros cent cents pound pounds yen kmh mph w kw mw v kv a ma hz khz mhz ghz kb mb gb tb "
    "c f k degree degrees celsius fahrenheit pa kpa bar psi j kj cal kcal n mol acre acres hectare hectares"
).split()

LITERAL, NUMBER, UNIT, NAME = range(4)
_MARKS = mix(np.arange(1, 5, dtype=_U) * _U(0xC2B2AE3D27D4EB4F))

_KIND = np.zeros(256, np.uint8)  # 1 digit, 2 letter or byte of one
_KIND[48:58] = 1
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 2
_KIND[ord("%")] = 2  # a unit
_STOPS = np.zeros(256, bool)
_STOPS[list(b'.!?:;"')] = True

_OPERATORS = np.zeros(256, bool)
_OPERATORS[list(b"+-*/=<>^|&~")] = True

PLAIN, TEMPLATE, DENSE = range(3)  # kinds of windows
WINDOWS = "hash long, kind int, n int, pos int, words int, slots array<struct<at:int,value:long>>"
_SLOTS = pa.list_(pa.struct([("at", pa.int32()), ("value", pa.int64())]))


def typed_words(column: pa.Array) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of texts, text, hash, type, loose type, operators before it) of all words with a letter or digit."""
    words = split_words(column)
    kind = _KIND[words.data]
    solid = np.flatnonzero(kind)
    first, last = np.searchsorted(solid, words.start), np.searchsorted(solid, words.end)
    full = last > first
    start, end, doc = solid[first[full]], solid[last[full] - 1] + 1, words.doc[full]
    value = span_hashes(words.data, start, end, lower=True)
    digits = np.concatenate([[0], np.cumsum(kind == 1)])
    n_digits = digits[end] - digits[start]
    letters = (np.concatenate([[0], np.cumsum(kind == 2)]))
    n_letters = letters[end] - letters[start]
    types = np.full(len(start), LITERAL, np.uint8)
    lead = words.data[start] if len(start) else np.zeros(0, np.uint8)
    types[(n_digits > 0) & (kind[start] == 1) & (n_letters <= 3)] = NUMBER
    same = np.concatenate([[False], doc[1:] == doc[:-1]]) if len(doc) else np.zeros(0, bool)
    after_number = same & np.concatenate([[False], types[:-1] == NUMBER])[: len(types)]
    types[after_number & (types == LITERAL) & np.isin(value, string_hashes(UNITS, lower=True))] = UNIT
    follow = words.data[np.minimum(start + 1, len(words.data) - 1)] if len(start) else lead
    capital = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (follow >= 0x80) & (follow <= 0x9E))
    feeds = np.concatenate([[0], np.cumsum(words.data == 10)])
    raw_end = words.end[full]
    inside = same.copy()  # not the first word of a sentence
    if len(start) > 1:
        inside[1:] &= ~_STOPS[words.data[raw_end[:-1] - 1]] & (feeds[start[1:]] == feeds[raw_end[:-1]])
    name = capital & (types == LITERAL) & (end - start > 1)
    loose = np.where(name, np.uint8(NAME), types)
    types[name & inside] = NAME
    return words.n_docs, doc, value, types, loose, _operators(words, full, same)


def _operators(words: Words, full: np.ndarray, same: np.ndarray) -> np.ndarray:
    """For each word that ``full`` chooses, a key of the operators between it and the one before it in its text, or 0."""
    out = np.zeros(len(same) + 1, _U)
    others = np.concatenate([[0], np.cumsum(~_OPERATORS[words.data])])
    signs = np.flatnonzero(~full)
    signs = signs[others[words.end[signs]] == others[words.start[signs]]]
    follow = np.cumsum(full)[signs]  # place of the next word, behind the last one if there is none
    np.add.at(out, follow, span_hashes(words.data, words.start[signs], words.end[signs]) | _U(1))
    own = np.concatenate([words.doc[full], [-1]])
    wrong = signs[own[follow] != words.doc[signs]]
    out[np.cumsum(full)[wrong]] = 0
    out[:-1][~same] = 0
    return out[:-1]


def windows(column: pa.Array, lengths: set[int], whole: bool, keep) -> pa.RecordBatch:
    """Windows of the texts: row, hash, kind (``PLAIN`` as they are, ``TEMPLATE``, ``DENSE``), n, pos, words, slots.

    ``whole``: texts shorter than the window give one window. ``keep`` chooses hashes.
    """
    n_texts, doc, value, types, loose, signs = typed_words(column)
    count = np.bincount(doc, minlength=n_texts)
    begin = np.cumsum(count) - count
    rows: dict[str, list] = {c: [] for c in ("row", "hash", "kind", "n", "pos", "words")}
    slots: list = []

    def add(kind: int, n: int, at: np.ndarray, hashes: np.ndarray, good: np.ndarray, typed: np.ndarray) -> None:
        at, hashes = at[good], hashes[good]
        chosen = keep(hashes)
        if whole:
            chosen &= np.minimum(count[doc[at]], WINDOW) == n
        at, hashes = at[chosen], hashes[chosen]
        for name, x in zip(rows, (doc[at], hashes.view(np.int64), np.full(len(at), kind), np.full(len(at), n), at - begin[doc[at]], count[doc[at]])):
            rows[name].append(x)
        for i in at.tolist():
            places = i + np.flatnonzero(typed[i : i + n] != LITERAL) if kind != PLAIN else ()
            slots.append([{"at": int(p - i), "value": int(value[p].view(np.int64))} for p in places])

    for n, at, hashes in roll(value, doc, lengths):
        add(PLAIN, n, at, mix(hashes), np.ones(len(at), bool), types)
    signed = np.concatenate([[0], np.cumsum(signs != 0)])
    between = {}  # keys of the operators inside the windows, by their second word
    for n, at, hashes in roll(signs, doc, {n - 1 for n in lengths}):
        between[n + 1] = np.zeros(len(doc) + 1, _U)
        between[n + 1][at] = hashes
    strict = np.concatenate([[0], np.cumsum(types != LITERAL)])
    for typed in (types, loose):
        slot = np.concatenate([[0], np.cumsum(typed != LITERAL)])
        for n, at, hashes in roll(np.where(typed == LITERAL, value, _MARKS[typed]), doc, lengths):
            held, operators = slot[at + n] - slot[at], signed[at + n] - signed[at + 1]
            literals, new = n - held, held > (0 if typed is types else strict[at + n] - strict[at])
            enough = literals >= min(MIN_LITERALS, n - 1)
            add(TEMPLATE, n, at, mix(hashes + _U(TEMPLATE)), new & enough, typed)
            told = (literals > 0) | ((operators >= min(MIN_LITERALS, n - 1)) & (typed is types))
            dense = new & ~enough & told
            add(DENSE, n, at, mix(mix(hashes + _U(DENSE)) + between[n][at + 1]), dense, typed)
    columns = {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in rows.items()}
    arrays = [pa.array(columns["row"]), pa.array(columns["hash"]), *(pa.array(columns[c].astype(np.int32)) for c in ("kind", "n", "pos", "words")), pa.array(slots, _SLOTS)]
    return pa.RecordBatch.from_arrays(arrays, names=["row", "hash", "kind", "n", "pos", "words", "slots"])


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> _U(64 - FILTER_BITS)).astype(np.int64), (hashes & _U((1 << FILTER_BITS) - 1)).astype(np.int64)


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All windows of the items, with ``item_id`` and ``needed``, the number of words in template windows; items with fewer than ``MIN_ITEM`` words have none."""
    id_type = items.schema[id_col].dataType.simpleString()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(1)):
                found = windows(batch.column(1).slice(first, n), set(range(MIN_ITEM, WINDOW + 1)), True, lambda h: np.ones(len(h), bool))
                ids = batch.column(0).slice(first, n).take(found.column(0))
                row, kind, size, pos = (found.column(c).to_numpy() for c in ("row", "kind", "n", "pos"))
                typed = kind != PLAIN
                words = np.repeat(pos[typed], size[typed]) + np.concatenate([np.arange(k) for k in size[typed]] or [np.zeros(0, np.int64)])
                reached = np.unique(np.stack([np.repeat(row[typed], size[typed]), words]), axis=1)[0]
                needed = pa.array(np.bincount(reached.astype(np.int64), minlength=n)[row].astype(np.int32))
                yield pa.RecordBatch.from_arrays([ids, *found.columns[1:], needed], names=["item_id", *found.schema.names[1:], "needed"])

    return items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"item_id {id_type}, {WINDOWS}, needed int")


def document_windows(docs: DataFrame, known: DataFrame, lengths: set[int]) -> DataFrame:
    """Windows of (id, key, text) rows that some item may have."""
    shift = 64 - FILTER_BITS
    places = known.select(F.explode(F.array(F.shiftrightunsigned("hash", shift), F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1))).alias("place"))
    found = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)  # fixed size, whatever the items
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def keep(hashes: np.ndarray) -> np.ndarray:
        bits = shared.value.view(_U)
        out = np.ones(len(hashes), bool)
        for place in _bits(hashes):
            out &= (bits[place >> 6] >> (place & 63).astype(_U)) & _U(1) == _U(1)
        return out

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(3)):
                hits = windows(batch.column(3).slice(first, n), lengths, False, keep)
                if hits.num_rows:
                    ids = [batch.column(c).slice(first, n).take(hits.column(0)) for c in (0, 1, 2)]
                    yield pa.RecordBatch.from_arrays([*ids, *hits.columns[1:]], names=["id", "key", "key2", *hits.schema.names[1:]])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "key", "key2", "text").mapInArrow(run, f"id {id_type}, key long, key2 long, {WINDOWS}")


def text_keys(text: Column) -> list[Column]:
    """128 bits that name a text."""
    return [F.xxhash64(text).alias("key"), F.xxhash64(F.lit("template"), text).alias("key2")]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (id, key, key2, item_id) of documents that hold an item, with ``item_words``, ``covered_words`` and ``slots_changed``."""
    known = materialize(item_windows(items, item_col, item_text_col))
    lengths = {r["n"] for r in known.select("n").distinct().collect()}  # at most WINDOW values
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *text_keys(text), text.alias("text"))
    d, i = document_windows(rows, known, lengths).alias("d"), known.alias("i")
    same = (F.col("d.hash") == F.col("i.hash")) & (F.col("d.kind") == F.col("i.kind")) & (F.col("d.n") == F.col("i.n"))
    hits = d.join(i, same).select(
        "d.id", "d.key", "d.key2", "i.item_id", F.col("i.words").alias("item_words"), "i.needed", (F.col("i.kind") == DENSE).alias("dense"), "i.n", F.col("i.pos").alias("item_pos"), (F.col("d.pos") - F.col("i.pos")).alias("diagonal"),
        F.zip_with("i.slots", "d.slots", lambda a, b: F.struct((F.col("i.pos") + a["at"]).alias("at"), a["value"].alias("asked"), b["value"].alias("given"))).alias("slots"),
    )
    hits = materialize(hits.distinct())
    pair, run = ["id", "key", "key2", "item_id"], ["id", "key", "key2", "item_id", "diagonal"]
    slots = hits.filter(F.size("slots") > 0).select(*run, F.explode("slots").alias("slot")).select(*run, "slot.*").distinct()
    votes = slots.groupBy(*run, "asked", "given").agg(F.count("*").alias("votes"))
    chosen = votes.groupBy(*run, "asked").agg(F.max(F.struct("votes", "given")).alias("top")).select(*run, "asked", F.col("top.given").alias("given"))
    maps = chosen.groupBy(*run).agg(F.map_from_entries(F.collect_list(F.struct("asked", "given"))).alias("map"))  # one entry for each value in an item
    nulls_match = [F.col(f"h.{c}").eqNullSafe(F.col(f"m.{c}")) for c in run]
    joined = hits.alias("h").join(maps.alias("m"), nulls_match, "left")
    steady = joined.filter(F.forall("h.slots", lambda s: F.element_at(F.col("m.map"), s["asked"]) == s["given"]))
    changed = F.exists("h.slots", lambda s: s["asked"] != s["given"])
    words = F.explode(F.expr("sequence(h.item_pos, h.item_pos + h.n - 1)")).alias("word")
    cover = steady.select(*(f"h.{c}" for c in run), "h.item_words", "h.needed", "h.dense", changed.cast("int").alias("changed"), words)
    cover = cover.groupBy(*run, "item_words", "needed", "word").agg(F.min("changed").alias("changed"), F.min(F.when(~F.col("dense"), F.col("changed"))).alias("alone"))
    cover = cover.groupBy(*run, "item_words", "needed").agg(F.collect_list(F.struct("word", "changed", "alone")).alias("words"))  # one entry for each word of an item
    cover = cover.select(*pair, "item_words", (F.size("words") >= F.col("needed")).alias("whole"), F.explode("words").alias("w"))
    cover = cover.select(*pair, "item_words", "w.word", F.when(F.col("whole"), F.col("w.changed")).otherwise(F.col("w.alone")).alias("changed"))
    cover = cover.filter("changed IS NOT NULL").groupBy(*pair, "item_words", "word").agg(F.min("changed").alias("changed"))
    out = cover.groupBy(*pair, "item_words").agg(F.count("*").alias("covered_words"), F.sum("changed").alias("slots_changed"))
    return out.filter((F.col("covered_words") >= MIN_SHARE * F.col("item_words")) | (F.col("covered_words") >= MIN_WORDS))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows whose text holds no item, with all their columns."""
    found = contaminated(docs, items, id_col, text_col, item_col, item_text_col)
    found = materialize(found.select(F.col("key").alias("__key"), F.col("key2").alias("__key2")).distinct())
    key, key2 = text_keys(F.col(f"`{text_col}`"))
    return docs.join(found, (F.col("__key") == key) & (F.col("__key2") == key2), "left_anti")
