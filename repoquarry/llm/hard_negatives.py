"""Hard negatives of anchors by disjoint score slots.

Vectors become integers, floor(``scale`` * x), and a row's score for an anchor is their
inner product. An anchor's positives are its first rows of the same label; each
allows negatives (rows of another label) between ``low`` % and ``high`` % of its own score.
These windows overlap. Their upper limits cut the scores into disjoint slots, one for each
different limit, and a score belongs to the slot of the lowest limit that is not below it.
Whatever a window asks for lies at the head of its own slot and of the slots below it, so
the first ``negatives`` rows of every slot answer all windows: those lists, merged in falling
order from a window's slot on, begin with its best rows, and its lower limit cuts the end.

Anchors meet rows in blocks. Rows and anchors are dealt by hash to blocks of bounded size whose
number follows from counts, each pair of blocks is one task's matrix product, and it passes on
no more than the head of each slot. Spark merges the heads (its window limit cuts them
in every task before the shuffle). Positives come from blocks of rows of like labels, dealt by a hash of the
label and then, as one label may hold a third of all rows, of the row. Neither vectors nor
anchors are broadcast or pass through the driver; only the sizes of the blocks do.

Products are exact: in double precision while no sum can reach 2^53, in whole numbers of any size
beyond; a score outside 64 bits stops the run.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take
no part; a shorter vector has zeros at its end; rows that agree in id, label and vector count once, rows that
share an id and differ are rows of their own, but neither is found for the other; of equal scores
the smaller id comes first; an anchor without positives, and a positive without negatives in its
window, give no row; a positive of negative score allows nothing; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

ROWS, ANCHORS = 8192, 1024  # of a block, on average
TASKS = 50_000  # at most; then one takes several pairs of blocks, one after the other
STEP = 1 << 20  # scores that are held at once
_LEAST = np.iinfo(np.int64).min


def whole_vectors(column: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of list vectors, as doubles with whole values; shorter ones are filled with zeros."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], object).reshape(a.shape) @ np.array([[int(x) for x in row] for row in b], object).reshape(b.shape).T
    return exact.astype(np.int64)  # raises an error beyond 64 bits


def _heads(scores: np.ndarray, wanted: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each row, the columns of its first ``n`` wanted scores, best first, earlier columns first where equal."""
    for line, good in zip(scores, wanted):
        at = np.flatnonzero(good)
        if len(at) > n:
            least = np.partition(line[at], len(at) - n)[len(at) - n]
            above = at[line[at] > least]
            at = np.concatenate([above, at[line[at] == least][: n - len(above)]])
        yield at[np.argsort(-line[at], kind="stable")]


def _steps(anchors: pa.Table, rows: pa.Table, scale: float) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """(first anchor, rows by id, scores) of groups of anchors that keep the matrix small."""
    rows = rows.sort_by("id")
    a, b = (whole_vectors(t.column("vector").combine_chunks(), scale) for t in (anchors, rows))
    step = max(1, STEP // max(len(b), 1))
    for first in range(0, len(a), step):
        yield first, rows, inner_products(a[first : first + step], b)


def _codes(one: pa.Table, two: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where labels are."""
    labels = pa.chunked_array([*one.column("label").chunks, *two.column("label").chunks], one.schema.field("label").type).combine_chunks().dictionary_encode().indices.to_numpy()
    return labels[: len(one)], labels[len(one) :]


def _meet(rows: DataFrame, anchors: DataFrame, by: Column | None, found, schema: str, extra: list[str]) -> DataFrame:
    """Every anchor with every row, or with every row of the same ``by``, block by block, through ``found(key, anchors, rows)``."""
    blocks = F.ceil(F.col("r") / ROWS).alias("of_rows"), F.ceil(F.col("a") / ANCHORS).alias("of_anchors")
    if by is None:
        sizes = rows.sparkSession.createDataFrame([(rows.count(), anchors.count())], "r long, a long").select(*blocks)
        of_rows, of_anchors = sizes.first()
        rows, anchors = (t.select("*", F.lit(0).alias("by"), F.lit(of_rows).alias("of_rows"), F.lit(of_anchors).alias("of_anchors")) for t in (rows, anchors))
    else:
        rows, anchors = (t.withColumn("by", by) for t in (rows, anchors))
        counted = rows.groupBy("by").agg(F.count("*").alias("r")).join(anchors.groupBy("by").agg(F.count("*").alias("a")), "by")
        sizes = materialize(counted.select("by", *blocks))
        rows, anchors = (t.join(sizes, "by") for t in (rows, anchors))
    pairs = sizes.agg(F.sum(F.col("of_rows") * F.col("of_anchors"))).first()[0] or 1

    def own(parts: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(11), F.col("id")), F.col(parts))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    key, data = ["by", "i", "j"], ["id", "label", "vector"]
    right = rows.filter("of_anchors > 0").select("by", *data, own("of_rows").alias("i"), every("of_anchors").alias("j"))
    left = anchors.filter("of_rows > 0").select("by", *data, "uid", *extra, every("of_rows").alias("i"), own("of_anchors").alias("j"))
    tasks = max(min(pairs, TASKS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left, right = (t.repartition(tasks, *key).groupBy(*key) for t in (left, right))
    return left.cogroup(right).applyInArrow(found, schema)


def mine(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = 256.0,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``id``. Ids are longs; labels are of any type that can be compared.
    """
    label_type = vectors.schema[label_col].dataType.simpleString()
    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = own.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    if rows.groupBy("id").count().filter("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["id", "label", "vector"])
    anchors = materialize(rows.filter(is_anchor).withColumn("uid", F.xxhash64("label", "vector")))
    buckets = rows.count() // (ROWS // 4) + 16

    def best_alike(key, one: pa.Table, two: pa.Table) -> pa.Table:
        of, to = _codes(one, two.sort_by("id"))
        left, names = one.select(["id", "uid"]), ["id", "uid", "other", "score"]
        at, other, score = [], [], []
        ids = one.column("id").to_numpy()
        for first, table, scores in _steps(one, two, scale):
            theirs, last = table.column("id").to_numpy(), first + len(scores)
            wanted = (of[first:last, None] == to) & (ids[first:last, None] != theirs)
            for k, columns in enumerate(_heads(scores, wanted, positives)):
                at.append(np.full(len(columns), first + k))
                other.append(theirs[columns])
                score.append(scores[k, columns])
        at, other, score = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (at, other, score))
        picked = left.take(pa.array(at))
        return pa.Table.from_arrays([*picked.columns, pa.array(other), pa.array(score)], names=names)

    alike = _meet(rows, anchors, F.pmod(F.xxhash64("label"), F.lit(buckets)), best_alike, "id long, uid long, other long, score long", [])
    place = F.expr("row_number() OVER (PARTITION BY id, uid ORDER BY score DESC, other)")
    first = alike.withColumn("place", place).filter(F.col("place") <= positives)
    # Windows in whole numbers: low * p <= 100 * n <= high * p.
    window = F.struct(F.col("other").alias("id"), "score", F.expr(f"({low} * score + 99) div 100").alias("least"), F.expr(f"({high} * score) div 100").alias("most"))
    wanted = first.filter("score >= 0").groupBy("id", "uid").agg(F.array_sort(F.collect_list(window)).alias("positives"))
    wanted = wanted.withColumn("limits", F.reverse(F.array_sort(F.array_distinct(F.col("positives.most"))))).withColumn("least", F.array_min("positives.least"))
    wanted = materialize(wanted)

    def heads(key, one: pa.Table, two: pa.Table) -> pa.Table:
        of, to = _codes(one, two.sort_by("id"))
        left, names = one.select(["id", "uid"]), ["id", "uid", "slot", "other", "score"]
        limits, least = one.column("limits").to_pylist(), one.column("least").to_pylist()
        at, slot, other, score = [], [], [], []
        for first, table, scores in _steps(one, two, scale):
            theirs, ids = table.column("id").to_numpy(), one.column("id").to_numpy()
            for k, line in enumerate(scores, first):
                bounds = limits[k]
                live = np.flatnonzero((line <= bounds[0]) & (line >= least[k]) & (to != of[k]) & (theirs != ids[k]))
                values = line[live]
                slots = len(bounds) - 1 - np.searchsorted(np.array(bounds[::-1]), values)  # the lowest limit that is not below
                inside = slots == np.arange(len(bounds))[:, None]
                for s, columns in enumerate(_heads(np.broadcast_to(values, inside.shape), inside, negatives)):
                    at.append(np.full(len(columns), k))
                    slot.append(np.full(len(columns), s))
                    other.append(theirs[live[columns]])
                    score.append(values[columns])
        at, slot, other, score = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (at, slot, other, score))
        picked = left.take(pa.array(at))
        return pa.Table.from_arrays([*picked.columns, pa.array(slot), pa.array(other), pa.array(score)], names=names)

    asking = anchors.join(wanted.select("id", "uid", "limits", "least"), ["id", "uid"])
    found = _meet(rows, asking, None, heads, "id long, uid long, slot long, other long, score long", ["limits", "least"])
    place = F.expr("row_number() OVER (PARTITION BY id, uid, slot ORDER BY score DESC, other)")
    tops = found.withColumn("place", place).filter(F.col("place") <= negatives)
    # At most (positives x negatives) rows an anchor, merged from the highest slot down.
    entry = F.struct("slot", (-F.col("score")).alias("minus"), "other")
    merged = tops.groupBy("id", "uid").agg(F.array_sort(F.collect_list(entry)).alias("merged")).join(wanted, ["id", "uid"])
    each = merged.select("id", "uid", "merged", "limits", F.explode("positives").alias("p")).withColumn("from", F.array_position("limits", F.col("p.most")) - 1)
    suffix = F.filter("merged", lambda x: (x["slot"] >= F.col("from")) & (-x["minus"] >= F.col("p.least")))
    out = each.select("id", "p", F.posexplode(F.slice(suffix, 1, negatives)).alias("at", "n"))
    return out.select(
        F.col("id").alias("anchor_id"), F.col("p.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("n.other").alias("negative_id"),
        F.col("p.score").alias("positive_score"), (-F.col("n.minus")).alias("negative_score"),
    )
