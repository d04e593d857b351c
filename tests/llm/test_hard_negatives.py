from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmill.llm import hard_negatives, queries

COLUMNS = "vec_id long, embedding array<double>, label int"


def as_long(n):
    return max(min(n, (1 << 63) - 1), -(1 << 63))


def plain(rows, first=5, every=100):
    """The contract's result by comparing every anchor with all rows."""
    usable = {}
    for vec, embedding, label in rows:
        if None not in (vec, embedding, label) and all(x is not None and math.isfinite(x) for x in embedding):
            label = (label + 1) % 10 if vec % 7 == 0 else label
            usable[vec, label, tuple(as_long(math.floor(256 * x)) for x in embedding)] = None
    out = []
    for anchor, label, q in usable:
        if anchor % every:
            continue
        scored = [
            (-as_long(sum(x * y for x, y in zip(q, own))), vec, own_label)
            for vec, own_label, own in usable
            if vec != anchor and len(own) == len(q)
        ]
        for minus, positive, _ in sorted(s for s in scored if s[2] == label)[:first]:
            fits = sorted(s for s in scored if s[2] != label and -80 * minus <= -100 * s[0] <= -100 * minus)[:first]
            out += [(anchor, positive, k, vec, -minus, -s) for k, (s, vec, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors(seed, n, dim, copies=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    rows = []
    for vec in range(n):
        near = centres[draw.integers(6)] + 0.2 * draw.normal(size=dim)
        if draw.random() < copies:
            near = centres[0]
        rows.append((vec * 5, [float(x) for x in near], int(draw.integers(3)) if draw.random() < 0.9 else 9))
    return rows


@pytest.fixture
def odd_rows():
    rows = vectors(1, 400, 6)
    rows += rows[:15]
    rows += [(100, rows[3][1], 1), (7000, None, 1), (7100, [1.0] * 6, None), (7200, [None] * 6, 2), (7300, [float("nan")] * 6, 1)]
    rows += [(7400, [float("inf")] + [0.0] * 5, 1), (None, [1.0] * 6, 1), (7500, [], 1), (7505, [], 2), (7510, [], 1)]
    rows += [(8000 + 5 * k, [0.5 * k, 1.0], k % 2) for k in range(40)] + [(-100, rows[8][1], 0)]
    return rows


def test_query_against_all_pairs(spark, odd_rows, tmp_path):
    df = spark.createDataFrame(odd_rows, COLUMNS).withColumn("key", F.lit("x")).withColumn("id", F.lit(1))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op11_hard_negatives(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == plain(odd_rows)
    assert len(plain(odd_rows)) > 100


@pytest.mark.parametrize("tree_rows, first", [(64, 2), (150, 5)])
def test_many_small_trees_and_blocks(spark, monkeypatch, tree_rows, first):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "ROOTS", 3)
    rows = vectors(2, 900, 8, copies=0.1)
    prepared = hard_negatives.prepared(spark.createDataFrame(rows, COLUMNS).repartition(9))
    moved = prepared.withColumn("label", F.expr("CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    found = hard_negatives.mined(moved, F.col("id") % 50 == 0, first, tree_rows)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, first, 50)


def test_scores_beyond_doubles_and_longs(spark):
    rows = [(100 * k, [1e12 + k, -3e12 * (k % 4), 1.0], k % 3) for k in range(12)]
    rows += [(5000, [1e300, 1.0, 1.0], 1), (5100, [-1e300, 1.0, 1.0], 1)]
    prepared = hard_negatives.prepared(spark.createDataFrame(rows, COLUMNS))
    moved = prepared.withColumn("label", F.expr("CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    found = hard_negatives.mined(moved, F.col("id") % 100 == 0)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows) != []


def test_empty_and_no_anchors(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    assert queries.op11_hard_negatives(spark, f"{tmp_path}/a").count() == 0
    spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], COLUMNS).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert queries.op11_hard_negatives(spark, f"{tmp_path}/b").count() == 0


def test_boxes_are_skipped():
    """The queue reads few pages where rows lie in clusters."""
    draw = np.random.default_rng(4)
    q = np.concatenate([draw.integers(-20, 20, (512, 8)) + 1000 * draw.integers(-3, 4, 8) for _ in range(8)])
    q = q[hard_negatives.tiled(q)]
    tree = hard_negatives.Tree(np.arange(len(q)), q)
    scores = q @ q[17]
    wanted = sorted(zip((-scores).tolist(), range(len(q))))[1:6] if scores.argmax() == 17 else None
    found = [(-s, row) for _, _, s, row in tree.search(q[17:18], [17], [[hard_negatives._ALL]], 5)]
    if wanted:
        assert found == wanted
    low, high = hard_negatives._intervals(q[17:18].astype(float), *tree.levels[0])
    assert (high[0] < -found[-1][0]).mean() > 0.5 and (low <= high).all()
    assert sorted(hard_negatives.tiled(q).tolist()) == list(range(len(q)))
