"""Near-duplicate vectors of equal label by tile products of int8-quantised vectors with rigorous error bounds.

Every vector is scaled to length one and quantised to int8 with a scale of its own, and the exact length of its
quantisation error is kept. For x = q + e and y = p + d (q, p the quantised parts) the cosine is at most
``q.p + |q||d| + |e|`` since ``|y| = 1``; only pairs whose bound reaches the threshold are computed in full precision.

Equal vectors of a label are one class from the start. The classes of a label are dealt into blocks of about
``TILE`` and every two blocks meet in one tile, so a label of any size is spread over many small tasks. A tile
returns one row per vector, its number of links there and a spanning forest of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.components import components
from fieldmill.llm.storage import step

THRESHOLD, TILE = 0.98, 1024
_FULL_PRECISION_ROWS = 32_768


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of the quantised parts and of the errors of vectors of length one."""
    scale = np.maximum(np.abs(unit).max(1), 1e-300) / 127
    codes = np.rint(unit / scale[:, None])
    part = codes * scale[:, None]
    return codes.astype(np.int8), scale, np.linalg.norm(part, axis=1), np.linalg.norm(unit - part, axis=1)


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of vectors whose cosine in double precision is ``threshold`` or more."""
    norms = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    a, scale_a, part_a, error_a = quantised(left / norms[0][:, None])
    b, scale_b, _, error_b = quantised(right / norms[1][:, None])
    exact = left.shape[1] * 127 * 127 < 1 << 24  # then sums of int8 products are exact in single precision
    kind = np.float32 if exact else np.float64
    bound = (a.astype(kind) @ b.astype(kind).T) * scale_a[:, None] * scale_b
    bound += part_a[:, None] * error_b + error_a[:, None]
    i, j = np.nonzero(bound >= threshold - 1e-9)  # beyond the rounding of the bound itself
    near = [np.empty(0, bool)]
    for low in range(0, len(i), _FULL_PRECISION_ROWS):
        p, q = i[low : low + _FULL_PRECISION_ROWS], j[low : low + _FULL_PRECISION_ROWS]
        near.append(np.einsum("nd,nd->n", left[p], right[q]) / (norms[0][p] * norms[1][q]) >= threshold)
    near = np.concatenate(near)
    return i[near], j[near]


def _forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``size`` nodes the smallest node it is connected to by the edges."""
    root = np.arange(size)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        open_edges = root[i] != root[j]
        if not open_edges.any():
            break
        i, j = i[open_edges], j[open_edges]
    while (root != root[root]).any():
        root = root[root]
    return root


def _tile(table: pa.Table, threshold: float) -> pa.Table:
    """Links of the first with the second block of a tile; a block with itself counts each pair once."""
    table = table.combine_chunks()
    first = table["side"].to_numpy() == 0
    vectors = np.array(table["vector"].to_pylist(), np.float64).reshape(table.num_rows, -1)
    copies = table["copies"].to_numpy()
    own, other = np.flatnonzero(first), np.flatnonzero(~first)
    alone = not len(other)
    if alone:
        other = own
    i, j = linked_pairs(vectors[own], vectors[other], threshold)
    i, j = own[i], other[j]
    if alone:
        i, j = i[i < j], j[i < j]
    links = np.bincount(i, copies[j], table.num_rows) + np.bincount(j, copies[i], table.num_rows)
    root = _forest(table.num_rows, i, j)
    used = np.flatnonzero(links)
    ids = table["id"].combine_chunks() if isinstance(table["id"], pa.ChunkedArray) else table["id"]
    return pa.table(
        {
            "id": ids.take(pa.array(used)),
            "root": ids.take(pa.array(root[used])),
            "links": pa.array(links[used].astype(np.int64)),
        }
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """``(id, n_links, component_id)``, one row per row of ``vectors``.

    Only vectors with an equal, non-null label and the same number of components are compared. A vector that is null,
    empty or zero, or holds a null or non-finite component, links with nothing and is its own component, as is a
    row without an id. ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the smallest
    id reachable. Ids name rows: rows that share an id belong to one component. Other columns are ignored.
    """
    rows = vectors.select(
        vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vector_col].cast("array<double>").alias("vector")
    )
    fine = "id is not null and label is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(vector, x -> x <> 0)"
    usable = F.coalesce(F.expr(fine), F.lit(False))
    key = F.sha2(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string"))), 256)
    kept = step(rows.filter(usable).withColumn("key", key), "vectors")
    classes = kept.groupBy("label", "key").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    chosen = classes.select("label", "key", F.col("id").alias("first"), "copies")
    nodes = kept.join(chosen, ["label", "key"]).filter("id = first").dropDuplicates(["label", "key"])
    nodes = nodes.select("id", "label", F.size("vector").alias("width"), "vector", "copies")
    sizes = nodes.groupBy("label", "width").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    placed = nodes.join(sizes, ["label", "width"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = placed.select(
        "label",
        "width",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "id",
        "vector",
        "copies",
    )
    kind = rows.schema["id"].dataType.simpleString()
    met = tiles.groupBy("label", "width", "one", "two").applyInArrow(
        lambda table: _tile(table, threshold), f"id {kind}, root {kind}, links long"
    )
    met = step(met, "tiles")
    links = met.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "first")
    found = components(met.select(F.col("id").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "first")
    summary = chosen.join(links, "first", "left").join(found, "first", "left")
    own = kept.select("id", "label", "key").join(summary, ["label", "key"])
    linked = own.select(
        "id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id")
    )
    rest = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(rest)
