"""Similarity join of word-shingle sets by parity sketches.

Two sets with Jaccard similarity of at least t differ in at most
D = min(|A|, |B|) * (1 - t) / t shingles. Sets are grouped in bands of similar size; a
set is entered in its own band and in those that a smaller partner may lie in. In a
band every shingle belongs, by its hash, to one block of a sketch, and flips a bit there;
a block is kept as the XOR of the hashes of its bits. Each shingle in which two sets
differ changes one block, so of D + 1 + z blocks at least z + 1 agree. Entered are the
D + 1 blocks that hold most shingles: the fullest of the agreeing blocks is then entered
by both sets, and blocks with hardly any shingle are not.

Blocks that different sets share give candidates. They are not paired with each other:

1. every member of a shared block is compared with the block's first member only;
2. links found so far make components; a block whose members are all in one is done;
3. in the others, members of other components than the largest are compared with one member of that;
4. when a round has not halved the pairs that are left, or these are no more than the entries of
   blocks, members outside a block's largest component are compared with all members of other components.

Near copies that lie just under the limit share many blocks. In step 4 an entry therefore carries the ``BEFORE``
blocks before it, in an order that is the same for all sets, and a pair is passed over
where both sides have one of these in common: the first block they share forms it. Until then entries are narrow, and sketches are one
row a set. Before a comparison, sizes and a parity sketch of 1,024 bits (whose Hamming distance never exceeds the
number of differing shingles) rule pairs out; what remains is compared exactly on the
whole texts. In steps 1 to 3, where sketches travel with pairs, they are folded to 256 bits, which are full from about 500 shingles on. Step 4 makes the result whole: no pair that shares a block is left out
unless both sides are already in one component.

Equal sets are one node throughout. The keys of shared blocks pass through the driver
only as a bitmap of ``FILTER_BITS`` bits, which keeps rows without a partner out of the second
shuffle; it lets some more through when full, never fewer.

Defined cases: null texts and texts without words are the empty set, linked with nothing;
texts with fewer words than a shingle have one shingle, the whole sequence; equal rows
are in one class; rows with a null id get a class but never name one; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release
from .components import compact, connected
from .words import mix, released, roll, slices, split_words, word_hashes

_U = np.uint64
FILTER_BITS = 26
SPARE = 0.25  # further blocks, so that the emptiest need not be entered
BAND_RATIO = 1.5
BEFORE = 8  # blocks before a block that its entry carries in the last step
SKETCH = tuple(f"s{i}" for i in range(16))
FOLDED = 4  # words of a folded sketch


class Sets(NamedTuple):
    """Distinct shingle hashes of the texts of a slice, sorted by text."""

    doc: np.ndarray
    key: np.ndarray
    size: np.ndarray


def shingle_sets(column: pa.Array, k: int) -> Sets:
    words = split_words(column)
    n_words = np.bincount(words.doc, minlength=words.n_docs)
    docs, keys = [], []
    for n, at, rolled in roll(word_hashes(words, lower=True), words.doc, range(1, k + 1)):
        wanted = np.ones(len(at), bool) if n == k else n_words[words.doc[at]] == n
        docs.append(words.doc[at][wanted])
        keys.append(rolled[wanted])
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.argsort(key)
    small = doc.astype(np.uint16) if words.n_docs < 1 << 16 else doc
    order = order[np.argsort(small[order], kind="stable")]
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    doc, key = doc[new], key[new]
    return Sets(doc, key, np.bincount(doc, minlength=words.n_docs))


def set_ids(sets: Sets) -> np.ndarray:
    """A 64-bit id of each set."""
    out = np.zeros(len(sets.size), _U)
    np.add.at(out, sets.doc, mix(sets.key ^ _U(0x5851F42D4C957F2D)))
    return mix(out + sets.size.astype(_U))


def sketches(sets: Sets) -> np.ndarray:
    """64-bit words of a set: the parity of the shingles that fall on each of their bits."""
    n = len(SKETCH)
    out = np.zeros((len(sets.size), n), _U)
    bit = mix(sets.key ^ _U(0x2545F4914F6CDD1D))
    np.bitwise_xor.at(out.reshape(-1), sets.doc * n + (bit & _U(n - 1)).astype(np.int64), _U(1) << (bit >> _U(58)))
    return out


class Bands:
    """Size bands and their numbers of blocks for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int, largest: int):
        self.percent, low = percent, [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, int(low[-1] * BAND_RATIO)))
        self.low = np.array(low)
        high = self.low[1:] - 1
        self.differ = high * (100 - percent) // percent
        self.blocks = self.differ + 1 + (SPARE * (self.differ + 1)).astype(np.int64)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1


def entries(sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, block key) of all blocks that are entered."""
    bands = Bands(percent, int(sets.size.max(initial=1)))
    own = bands.of(sets.size)
    least = np.maximum(1, -(-sets.size * percent // 100))
    first = np.cumsum(sets.size) - sets.size
    out_doc, out_key = [], []
    lowest = bands.of(least)
    for back in range(int((own - lowest).max(initial=0)) + 1):
        band = own - back
        live = np.flatnonzero((sets.size > 0) & (band >= lowest) & (bands.differ[np.maximum(band, 0)] > 0))
        if not len(live):
            continue
        band = band[live]
        blocks, enter = bands.blocks[band], bands.differ[band] + 1
        base = np.cumsum(blocks) - blocks
        sizes = sets.size[live]
        at = np.repeat(first[live] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        owner = np.repeat(np.arange(len(live)), sizes)
        key = mix(sets.key[at] + (band[owner].astype(_U) << _U(40)))
        place = base[owner] + ((key >> _U(32)) * blocks[owner].astype(_U) >> _U(32)).astype(np.int64)
        total = int(blocks.sum())
        value, held = np.zeros(total, _U), np.bincount(place, minlength=total)
        np.bitwise_xor.at(value, place, mix(key + _U(1)))
        of = np.repeat(np.arange(len(live)), blocks)
        number = (np.arange(total) - base[of]).astype(_U)
        value = mix(value + mix((band[of].astype(_U) << _U(32)) + number + _U(0x9E3779B9)))
        order = np.lexsort((value, -held, of))  # fullest first; the order depends on a block's content alone
        rank = np.arange(total) - base[of]
        entered = order[rank < enter[of]]
        out_doc.append(live[of[entered]])
        out_key.append(value[entered])
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(out_doc), np.concatenate(out_key)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _bitmap(df: DataFrame, column: str):
    """Broadcast bitmap of the low ``FILTER_BITS`` bits of a long column: bounded, whatever the rows."""
    place = F.col(column).bitwiseAND((1 << FILTER_BITS) - 1)
    words = df.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 AS int))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return df.sparkSession.sparkContext.broadcast(out)


def _in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & _U((1 << FILTER_BITS) - 1)
    return (bits.view(_U)[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == _U(1)


def _row_keys(ids: pa.Array, sid: np.ndarray) -> np.ndarray:
    """A hash of (id, set); a null id counts as 0."""
    return mix(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(_U) ^ sid)


def _folded(nodes: DataFrame) -> DataFrame:
    """(sid, n) and the sketch folded to ``FOLDED`` words: the parity of several bits is one bit."""
    def word(i: int) -> Column:
        out = F.col(SKETCH[i])
        for name in SKETCH[i + FOLDED :: FOLDED]:
            out = out.bitwiseXOR(F.col(name))
        return out

    return nodes.select("sid", "n", *(word(i).alias(SKETCH[i]) for i in range(FOLDED)))


def _can_link(a: str, b: str, percent: int, words: Sequence[str] = SKETCH) -> Column:
    """Whether sizes and sketches allow the similarity."""
    least, most = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in words), F.lit(0))
    # |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|)
    return (most * percent <= least * 100) & (differ * (100 + percent) <= (least + most) * (100 - percent))


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. ``texts``: sid, text."""
    left = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
    wide = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(2)):
                one, two = (shingle_sets(batch.column(c).slice(first, n), k) for c in (2, 3))
                doc, key = np.concatenate([one.doc, two.doc]), np.concatenate([one.key, two.key])
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
                same = (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])
                shared = np.bincount(doc[1:][same], minlength=n)
                good = 100 * shared >= percent * (one.size + two.size - shared)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(first, n) for c in (0, 1)], names=["a", "b"]).filter(pa.array(good))

    return wide.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles`` and ``component_id`` (the smallest id reachable by links). Ids are longs."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    @released
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(first, n), shingle)
                sid, sketch = pa.array(set_ids(sets).view(np.int64), mask=sets.size == 0), sketches(sets)
                arrays = [batch.column(0).slice(first, n), pa.array(sets.size.astype(np.int64)), sid, *(_long(np.ascontiguousarray(sketch[:, i])) for i in range(len(SKETCH)))]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "sid", *SKETCH])

    @released
    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0)):
                sets = shingle_sets(batch.column(0).slice(first, n), shingle)
                doc, key = entries(sets, percent)
                yield pa.RecordBatch.from_arrays([_long(key), _long(set_ids(sets)[doc])], names=["key", "sid"])

    sets = materialize(rows.mapInArrow(measured, "id long, n long, sid long, " + ", ".join(f"{c} long" for c in SKETCH)))
    nodes = sets.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("rep"), *(F.max(c).alias(c) for c in ("n", *SKETCH)))
    nodes = materialize(nodes)
    release(rows.sparkSession)
    keys = rows.select("text").mapInArrow(entered, "key long, sid long").groupBy("key").agg(F.min("sid").alias("leader"), F.max("sid").alias("last"))
    shared = materialize(keys.filter("leader < last").select("key", "leader"))
    release(rows.sparkSession)  # of the entries of all blocks
    with_partner = _bitmap(shared, "key")

    @released
    def entered_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(0)):
                sets = shingle_sets(batch.column(0).slice(first, n), shingle)
                doc, key = entries(sets, percent)
                found = _in_bitmap(with_partner.value, key)
                yield pa.RecordBatch.from_arrays([_long(key[found]), _long(set_ids(sets)[doc[found]])], names=["key", "sid"])

    members = rows.select("text").mapInArrow(entered_again, "key long, sid long").distinct()
    members = materialize(members.join(shared, "key"))
    del shared
    release(rows.sparkSession)
    found = _links(members, rows, nodes, shingle, percent)
    roots = nodes.join(found, nodes.sid == found.node, "left").select("sid", "rep", F.coalesce("root", "sid").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = roots.join(smallest, "root").select("sid", "component_id")
    out = sets.join(named, "sid", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but the smallest id of every class, with all their columns.

    Of rows that share an id and the text one stays. Rows with a null id stay, as no class can be named by them.
    """
    placed = classes(docs, id_col, text_col, shingle, percent).select(F.col(id_col).alias("__id"), "component_id")
    placed = materialize(placed.filter("__id IS NOT NULL"))
    same = F.col(f"`{id_col}`") == F.col("__id")
    kept = docs.join(placed.filter("__id <> component_id").select("__id").distinct(), same, "left_anti")
    twice = materialize(placed.groupBy("__id").count().filter("count > 1").select("__id"))
    release(docs.sparkSession)
    if not twice.count():
        return kept
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates([id_col, text_col]))


def _texts(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """(sid, text) of the sets in ``pairs``, from one row each."""
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    reps = compact(nodes.join(wanted, "sid").select("sid", F.coalesce("rep", F.lit(0)).alias("rep")))
    marks = _bitmap(reps.mapInArrow(_marks, "mark long"), "mark")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in slices(batch.column(1)):
                part = batch.slice(first, n)
                sets = shingle_sets(part.column(1), shingle)
                sid = set_ids(sets)
                found = _in_bitmap(marks.value, _row_keys(part.column(0), sid)) & (sets.size > 0)
                ids = part.column(0).fill_null(0)
                yield pa.RecordBatch.from_arrays([ids, _long(sid), part.column(1)], names=["rep", "sid", "text"]).filter(pa.array(found))

    texts = rows.select("id", "text").mapInArrow(run, "rep long, sid long, text string")
    return texts.join(reps, ["sid", "rep"], "left_semi").dropDuplicates(["sid"]).select("sid", "text")


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([_long(_row_keys(batch.column(1), batch.column(0).to_numpy().view(_U)))], names=["mark"])


def _with_one(members: DataFrame, one: str, nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of each row's ``sid`` with its ``one`` that can reach the similarity."""
    pairs = members.filter(F.col("sid") != F.col(one)).select(F.least("sid", one).alias("a"), F.greatest("sid", one).alias("b")).distinct()
    folded = _folded(nodes)
    both = pairs.join(folded.alias("x"), F.col("a") == F.col("x.sid")).join(folded.alias("y"), F.col("b") == F.col("y.sid"))
    return both.filter(_can_link("x", "y", percent, SKETCH[:FOLDED])).select("a", "b")


def _with_all(unsettled: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of a block that are in different components and can reach the similarity.

    Near copies share many blocks. The first that two sets share, by key, forms their pair; where both sides have one of the
    few before a block in common, the pair is not formed again. (Blocks that are settled already lie in one component, so those
    left out here form no pair.)
    """
    earlier = Window.partitionBy("sid").orderBy("key").rowsBetween(-BEFORE, -1)
    wide = unsettled.withColumn("before", F.collect_list("key").over(earlier)).join(nodes.drop("rep"), "sid")
    wide = materialize(wide)
    new = ~F.arrays_overlap("x.before", "y.before") & F.expr("x.root <> y.root AND (y.root = y.top OR x.sid < y.sid)")
    joined = wide.filter("root <> top").alias("x").join(wide.alias("y"), (F.col("x.key") == F.col("y.key")) & _can_link("x", "y", percent) & new)
    return joined.select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")).distinct()


def _links(members: DataFrame, rows: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Components (node, root) of all links."""
    pairs = _with_one(members, "leader", nodes, percent)
    members = members.drop("leader")
    found, n_members, before, whole = None, members.count(), None, False
    pairs = compact(pairs)
    for step in itertools.count(1):
        release(rows.sparkSession)
        new = _verified(pairs, _texts(rows, nodes, pairs, shingle), shingle, percent)
        # Components so far stand for the links that made them.
        found = connected(new if found is None else new.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        if whole:
            return found
        release(rows.sparkSession)  # of the texts of all pairs
        placed = materialize(members.join(found, members.sid == found.node, "left").select("key", "sid", F.coalesce("root", "sid").alias("root")))
        sizes = placed.groupBy("key", "root").agg(F.count("*").alias("held"), F.max_by("sid", F.xxhash64("sid", F.lit(step))).alias("one"))
        largest = sizes.groupBy("key").agg(F.max_by(F.struct("root", "one"), F.struct("held", "root")).alias("top"), F.sum("held").alias("all"), F.max("held").alias("most"))
        largest = compact(largest.filter("all > most").select("key", F.col("top.root").alias("top"), F.col("top.one").alias("one"), "all", "most"))
        work = largest.agg(F.sum((F.col("all") - F.col("most")) * F.col("all"))).first()[0]
        if not work:
            return found
        unsettled = placed.join(largest.select("key", "top", "one"), "key")
        # All pairs of a block in different components, once no more than the members are left or a round has not settled half of them.
        whole = work <= n_members or before is not None and 2 * work > before
        pairs = compact(_with_all(unsettled, nodes, percent) if whole else _with_one(unsettled.filter("root <> top"), "one", nodes, percent))
        before = work
        del new, placed, sizes, largest, unsettled
