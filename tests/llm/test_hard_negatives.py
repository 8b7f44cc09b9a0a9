"""Hard negatives against all scores, on ties, repeated rows, hot labels and rows that break things."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repoquarry.llm import hard_negatives

ANCHOR = "id % 10 = 0"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    """Over distinct usable rows; anchors are those whose id is divisible by 10."""
    usable = {(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v), c) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, v, c in usable:
        if i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, d) for j, w, d in usable if j != i)
        for p, j, _ in [x for x in scored if x[2] == c][:positives]:
            found = [(n, k) for n, k, d in scored if d != c and low * -p <= 100 * -n <= high * -p][:negatives]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(found, 1)]
    return sorted(out)


def mined(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = hard_negatives.mine(df, F.expr(ANCHOR))
    assert found.columns == names
    return sorted(tuple(r) for r in found.collect())


def draw(n, seed, labels=4, grid=4):
    r = random.Random(seed)
    # few different values: many equal scores; label 0 holds half of the rows
    return [(i, [r.randint(-grid, grid) / grid for _ in range(6)], r.choice([0, *range(labels)])) for i in range(n)]


def test_against_all_scores_with_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    rows = draw(400, 1) + [(i, [0.5] * 6, 1) for i in range(400, 480)]  # and a group of equal vectors
    found = mined(spark.createDataFrame(rows, SCHEMA))
    assert found == brute(rows) and len(found) > 500


def test_rows_that_break_things(spark):
    rows = draw(40, 2) + [
        (50, None, 1), (60, [1.0, None, 0.0], 1), (70, [float("nan")] * 6, 1), (80, [float("inf")] * 6, 0), (None, [1.0] * 6, 1), (90, [1.0] * 6, None),
        (100, [], 1), (110, [1.0], 2), (120, [1.0] * 9, 2), (130, [-1.0] * 6, 3), (140, [0.0] * 6, 0), (150, [300.0, -0.004, 0.5], 1),
    ]
    twice = rows + rows[:25]
    df = spark.createDataFrame(twice, SCHEMA).select("*", *(F.lit(1).alias(c) for c in ("id", "vector", "uid", "score", "i", "j", "slot", "__by", "rank", "limits")))
    found = mined(df)
    assert found == brute(rows) and found
    assert mined(df.limit(0)) == []


def test_rows_that_share_an_id(spark):
    rows = draw(30, 3) + [(10, [0.25] * 6, 0), (10, [0.25] * 6, 1), (11, [0.75] * 6, 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_products_are_exact():
    big = np.array([[2.0**52, 1.0], [3.0, 5.0]])
    assert hard_negatives.inner_products(big, np.array([[3.0, 7.0]])).tolist() == [[3 * 2**52 + 7], [44]]
    with pytest.raises(OverflowError):
        hard_negatives.inner_products(np.array([[2.0**62]]), np.array([[4.0]]))
    column = pa.array([[0.5, -0.001], [], [1.0]], pa.list_(pa.float32()))
    assert hard_negatives.whole_vectors(column.slice(1), 256).tolist() == [[0.0], [256.0]]


def test_heads_keep_order_among_equals():
    scores = np.array([[5, 7, 5, 5, 9, 5]])
    wanted = np.array([[True, True, True, True, False, True]])
    assert [h.tolist() for h in hard_negatives._heads(scores, wanted, 3)] == [[1, 0, 2]]
    assert [h.tolist() for h in hard_negatives._heads(scores, wanted, 9)] == [[1, 0, 2, 3, 5]]


def test_neither_side_is_broadcast(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = hard_negatives.mine(spark.createDataFrame(draw(50, 4), SCHEMA), F.expr(ANCHOR))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "WindowGroupLimit" in plan
