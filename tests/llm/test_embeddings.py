from __future__ import annotations

import numpy as np
import pytest

from fieldmill.llm import embeddings


def plain(rows):
    usable = [
        (i, label, np.array(v, float))
        for i, label, v in rows
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, root = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}
    for a, la, x in usable:
        for b, lb, y in usable:
            if a != b and la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                links[a] += 1
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return {i: (links[i], root[i]) for i in links}


def vectors():
    draw = np.random.default_rng(4)
    rows = []
    for k in range(220):
        base = np.random.default_rng(k // 4).normal(size=16)
        rows.append((len(rows), k % 3 if k % 8 else 0, (base + draw.normal(size=16) * [0.01, 0.12, 0.17, 0.3][k % 4]).astype(np.float32).tolist()))
    rows += [(1000 + k, 1, rows[1][2]) for k in range(30)]
    odd = [None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, None], rows[1][2][:8], [-0.0] + [1.0] * 15, [0.0] + [1.0] * 15]
    rows += [(2000 + k, 1, v) for k, v in enumerate(odd)]
    rows += [(3000, None, rows[1][2]), (3001, None, rows[1][2])]
    return rows


@pytest.mark.parametrize("tile", [16, 1024])
def test_agrees_with_all_pairs(spark, tile):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumnRenamed("x", "links")
    found = {r["id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(table, tile=tile).collect()}
    assert found == plain(rows)


def test_bounds_hold_and_select():
    draw = np.random.default_rng(2)
    a = draw.normal(size=(300, 64))
    a[150:] = a[:150] + draw.normal(size=(150, 64)) * 0.15
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    codes, scale, part, error = embeddings.quantised(unit)
    bound = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale + part[:, None] * error + error[:, None]
    assert (bound + 1e-9 >= unit @ unit.T).all() and (bound - unit @ unit.T).max() < 0.05
    i, j = embeddings.linked_pairs(a, a)
    near = a @ a.T / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(a, axis=1) >= 0.98
    assert {(x, y) for x, y in zip(i, j)} == set(zip(*np.nonzero(near)))


def test_empty_table_and_rows_without_an_id(spark):
    table = spark.createDataFrame([(None, 1, [1.0, 2.0]), (5, 1, [1.0, 2.0])], "vec_id long, label int, embedding array<float>")
    assert sorted(map(tuple, embeddings.near_vectors(table).collect()), key=repr) == [(5, 0, 5), (None, 0, None)]
    assert embeddings.near_vectors(table.limit(0)).count() == 0
