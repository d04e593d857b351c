"""Hard negatives: for an anchor and each of its best rows, the best rows of other labels in a window below.

Scores are integer inner products. Rows are packed into R-trees by sort-tile-recursive tiling:

1. *Tiles.* One range sort by label and first coordinates; each run of ``TREE`` rows in it is tiled by its widest
   coordinates into pages of ``LEAF`` rows, pages into nodes of ``FAN``. A bounding box gives each coordinate's least and
   largest product with the anchor's, hence an interval for the scores inside.
2. *Bounds.* An anchor searches the tree it lies in; its fifth score there bounds those of its positives from below.
3. *Pruning.* Blocks of anchors meet blocks of root boxes; an anchor goes only to trees whose interval reaches its bound
   (positives) or one of its windows (negatives).
4. *Search.* A queue per anchor and window takes the pages with the highest possible scores first, a few at a time, and
   leaves boxes outside the window or strictly below the k-th score found, so that ties still go by id. A page's scores
   are one product for all anchors of a block, made when the first of them asks.

Of rows with one label and one vector only the ``2 + k - 1`` with the smallest ids can be among the first ``k`` others, and
only those are packed; that is exact, and a vector that a third of all rows share costs no more than another.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step

TREE, LEAF, FAN, FIRST = 8192, 64, 8, 5
ANCHORS, ROOTS = 1024, 512
_EXACT = 1 << 53
_PACKED = (
    "kind int, dim int, label long, tree long, part int, key long, id long, q array<long>, high array<long>, bound long"
)
_ROW, _BOX, _ANCHOR = range(3)


def _vectors(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), dim)


def _largest(part: np.ndarray) -> int:
    return max(abs(int(part.max())), abs(int(part.min()))) if part.size else 1


def _computable(anchors: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles if the inner products of anchors with the others are exact in doubles, else as Python's integers."""
    most = _largest(anchors) * max(map(_largest, others)) * max(anchors.shape[1], 1)
    return [part.astype(np.float64 if most < _EXACT else object) for part in (anchors, *others)]


def _as_long(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long become the nearest long."""
    return np.minimum(np.maximum(scores, -(1 << 63)), (1 << 63) - 1) if scores.dtype == object else scores


def _intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest score of each anchor with each box."""
    above, below = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _as_long(above @ low.T + below @ high.T), _as_long(above @ high.T + below @ low.T)


def tiled(vectors: np.ndarray, leaf: int = LEAF, levels: int = 3) -> np.ndarray:
    """The order of the rows in which each ``leaf`` of them is a page: slabs by the widest coordinate, tiled by the next."""
    if not vectors.shape[1]:
        return np.arange(len(vectors))
    spread = vectors.max(0).astype(float) - vectors.min(0)
    axes = np.argsort(-spread, kind="stable")[:levels]

    def tile(rows: np.ndarray, axes: np.ndarray) -> list[np.ndarray]:
        pages = ceil(len(rows) / leaf)
        if pages <= 1 or not len(axes):
            return [rows]
        rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
        slab = leaf * ceil(pages / ceil(round(pages ** (1 / len(axes)), 9)))
        return [part for low in range(0, len(rows), slab) for part in tile(rows[low : low + slab], axes[1:])]

    return np.concatenate(tile(np.arange(len(vectors)), axes))


class Tree:
    """The nodes over rows in tiled order, level by level from pages to the root."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.ids, self.vectors, self.leaf, self.fan = ids, vectors, leaf, fan
        self.levels, low, high, size = [], vectors, vectors, leaf
        while True:
            cuts = np.arange(0, len(low), size)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((low, high))
            if len(low) == 1:
                break
            size = fan

    def search(
        self, anchors: np.ndarray, own: list[int | None], windows: list[list[tuple[int, int]]], first: int
    ) -> Iterator[tuple[int, int, int, int]]:
        """(anchor, window, score, id) of the ``first`` best rows per anchor and window; ``own`` ids are left out.

        A window is (least, largest) score. Higher scores come first, then smaller ids.
        """
        anchors, vectors, *boxes = _computable(anchors, self.vectors, *(box for level in self.levels for box in level))
        lows, highs = _intervals(anchors, boxes[0], boxes[1])
        pages = lows.shape[1]
        # a page lies under successive nodes; the boxes above it say what the page's own say, for fewer products
        fits = [_intervals(anchors, boxes[2 * k], boxes[2 * k + 1]) for k in range(len(self.levels) - 1, 0, -1)]
        scores, known = np.empty((len(anchors), len(vectors)), anchors.dtype), np.zeros(pages, bool)
        for a, wanted in enumerate(windows):
            for w, (least, largest) in enumerate(wanted):
                inside = np.ones(1, bool)
                for low, high in fits:
                    inside = np.repeat(inside, self.fan)[: low.shape[1]]
                    inside &= ((low[a] <= largest) & (high[a] >= least)).astype(bool)
                inside = np.flatnonzero(np.repeat(inside, self.fan if fits else 1)[:pages])
                inside = inside[((lows[a, inside] <= largest) & (highs[a, inside] >= least)).astype(bool)]
                reach = np.minimum(highs[a, inside], largest)
                queue = np.argsort(-reach, kind="stable")
                inside, reach = inside[queue], reach[queue]
                best_scores, best_ids = np.empty(0, anchors.dtype), np.empty(0, np.int64)
                bottom, taken, some = least, 0, 2
                while taken < len(inside) and (len(best_ids) < first or reach[taken] >= bottom):
                    some, now = 2 * some, inside[taken : taken + some]
                    taken += len(now)
                    for page in now[~known[now]].tolist():
                        rows = slice(page * self.leaf, (page + 1) * self.leaf)
                        scores[:, rows] = _as_long(anchors @ vectors[rows].T)
                        known[page] = True
                    rows = (now[:, None] * self.leaf + np.arange(self.leaf)).ravel()
                    rows = rows[rows < len(vectors)]
                    own_scores = scores[a, rows]
                    rows = rows[((own_scores >= bottom) & (own_scores <= largest)).astype(bool)]
                    best_scores, best_ids = np.append(best_scores, scores[a, rows]), np.append(best_ids, self.ids[rows])
                    if own[a] is not None:
                        other = best_ids != own[a]
                        best_scores, best_ids = best_scores[other], best_ids[other]
                    order = np.lexsort((best_ids, -best_scores))[:first]
                    best_scores, best_ids = best_scores[order], best_ids[order]
                    if len(best_ids) == first:
                        bottom = best_scores[-1]
                for score, row in zip(best_scores.tolist(), best_ids.tolist()):
                    yield a, w, int(score), row


_ALL = (-(1 << 200), 1 << 200)


def _table(columns: list, schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [pa.field(*f.split(" ")[:1], kinds[f.split(" ")[1]]) for f in schema.split(", ")]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], pa.schema(fields))


def _lists(vectors: np.ndarray) -> pa.Array:
    ends = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.reshape(-1), pa.int64()))


def _pack(batches: Iterator[pa.RecordBatch], tree_rows: int, first: int) -> Iterator[pa.RecordBatch]:
    """Trees of successive rows of one label, and the anchors among them with the ``first``-th score there."""
    part = TaskContext.get().partitionId()
    tree, held, held_key = part << 33, [], None

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal tree, held
        if not held:
            return
        dim, label = held_key
        whole = pa.Table.from_batches(held).combine_chunks()
        kind, ids = whole.column("kind").to_numpy(), whole.column("id").to_numpy()
        q = _vectors(whole.column("q"), dim)
        rows, anchors = np.flatnonzero(kind == _ROW), np.flatnonzero(kind == _ANCHOR)
        bound: list[int | None] = [None] * len(anchors)
        parts = []
        if len(rows):
            rows = rows[tiled(q[rows])]
            own = Tree(ids[rows], q[rows])
            low, high = own.levels[-1]
            parts.append((_ROW, ids[rows], q[rows], None, None))
            parts.append((_BOX, [None], low, high, None))
            found: list[list[int]] = [[] for _ in anchors]
            for a, _, score, _ in own.search(q[anchors], ids[anchors].tolist(), [[_ALL]] * len(anchors), first):
                found[a].append(score)
            bound = [scores[-1] if len(scores) == first else None for scores in found]
        if len(anchors):
            parts.append((_ANCHOR, ids[anchors], q[anchors], None, bound))
        for which, names, vectors, other, bounds in parts:
            n = len(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, which), pa.int32()),
                    pa.array(np.full(n, dim), pa.int32()),
                    pa.array(np.full(n, label), pa.int64()),
                    pa.array(np.full(n, tree), pa.int64()),
                    pa.array(np.full(n, part), pa.int32()),
                    pa.array(tree + np.arange(n), pa.int64()),
                    pa.array(names, pa.int64()),
                    _lists(vectors),
                    pa.nulls(n, pa.list_(pa.int64())) if other is None else _lists(other),
                    pa.nulls(n, pa.int64()) if bounds is None else pa.array(bounds, pa.int64()),
                ],
                ["kind", "dim", "label", "tree", "part", "key", "id", "q", "high", "bound"],
            )
        tree, held = tree + 2 * tree_rows + 2, []

    n_rows = n_anchors = 0
    for batch in batches:
        dims, labels = batch.column("dim").to_numpy(), batch.column("label").to_numpy()
        kinds = batch.column("kind").to_numpy()
        low = 0
        while low < batch.num_rows:
            key = int(dims[low]), int(labels[low])
            if key != held_key or n_rows >= tree_rows or n_anchors >= tree_rows:
                yield from flush()
                held_key, n_rows, n_anchors = key, 0, 0
            other = np.flatnonzero((dims[low:] != key[0]) | (labels[low:] != key[1]))
            room = tree_rows - max(n_rows, n_anchors)
            high = min(low + room, low + int(other[0]) if len(other) else batch.num_rows)
            held.append(batch.slice(low, high - low))
            n_rows += int((kinds[low:high] == _ROW).sum())
            n_anchors += int((kinds[low:high] == _ANCHOR).sum())
            low = high
    yield from flush()


def _met(anchors: pa.Table, roots: pa.Table, same_label: bool) -> pa.Table:
    """``(key, tree)`` of anchors and the roots whose interval reaches their bound, or one of their windows."""
    schema = "key long, tree long"
    if not anchors.num_rows or not roots.num_rows:
        return _table([[], []], schema)
    dim = roots.column("dim")[0].as_py()
    q, low, high = _computable(*(_vectors(c, dim) for c in (anchors.column("q"), roots.column("q"), roots.column("high"))))
    least, most = _intervals(q, low, high)
    labels = anchors.column("label").to_numpy()[:, None] == roots.column("label").to_numpy()[None, :]
    if same_label:
        bound = np.array([_ALL[0] if b is None else b for b in anchors.column("bound").to_pylist()], most.dtype)
        fits = labels & (most >= bound[:, None]).astype(bool)
    else:
        fits = np.zeros(least.shape, bool)
        windows = [[(-(-80 * s // 100), s) for s in own] for own in anchors.column("scores").to_pylist()]
        for a, own in enumerate(windows):
            for lowest, largest in own:
                fits[a] |= ((least[a] <= largest) & (most[a] >= lowest)).astype(bool)
        fits &= ~labels
    a, r = np.nonzero(fits)
    return _table([anchors.column("key").to_numpy()[a], roots.column("tree").to_numpy()[r]], schema)


_HITS = "key long, wanted long, score long, id long"


def _searched(anchors: pa.Table, rows: pa.Table, same_label: bool, first: int) -> pa.Table:
    """``(key, wanted, score, id)``: the best rows of a tree for each anchor, in each of its windows unless labels are the same."""
    if not anchors.num_rows or not rows.num_rows:
        return _table([[], [], [], []], _HITS)
    dim = rows.column("dim")[0].as_py()
    order = np.argsort(rows.column("key").to_numpy())
    tree = Tree(rows.column("id").to_numpy()[order], _vectors(rows.column("q"), dim)[order])
    keys, ids = anchors.column("key").to_pylist(), anchors.column("id").to_pylist()
    if same_label:
        bounds = anchors.column("bound").to_pylist()
        scores = [[None]] * len(keys)
        windows = [[(_ALL[0] if b is None else b, _ALL[1])] for b in bounds]
        own = ids
    else:
        scores = anchors.column("scores").to_pylist()
        windows = [[(-(-80 * s // 100), s) for s in wanted] for wanted in scores]
        own = [None] * len(keys)
    out: list[list] = [[], [], [], []]
    for a, w, score, row in tree.search(_vectors(anchors.column("q"), dim), own, windows, first):
        for column, value in zip(out, (keys[a], scores[a][w], score, row)):
            column.append(value)
    return _table(out, _HITS)


def prepared(
    rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(id, label, dim, q)``: rows that take part, each once; ``q`` is the floor of ``scale`` times each component.

    Rows without an id, a label or a vector, and those with a null or non-finite component, are left out.
    """
    vector = rows[vector_col].cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.filter(rows[id_col].isNotNull() & rows[label_col].isNotNull() & rows[vector_col].isNotNull() & usable)
        .select(
            rows[id_col].cast("long").alias("id"),
            rows[label_col].cast("long").alias("label"),
            F.size(vector).alias("dim"),
            F.transform(vector, lambda x: F.floor(x * float(scale))).alias("q"),
        )
        .dropDuplicates()
    )


def packed(rows: DataFrame, anchors: DataFrame, first: int = FIRST, tree_rows: int = TREE) -> DataFrame:
    """The R-trees: their rows (kind 0), root boxes (1, ``q`` to ``high``) and the anchors in their place (2)."""
    ship(rows.sparkSession)
    order = Window.partitionBy("label", "q").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= first + 1).drop("n")
    both = few.withColumn("kind", F.lit(_ROW)).union(anchors.withColumn("kind", F.lit(_ANCHOR)))
    placed = both.withColumns({f"q{k}": F.get("q", F.lit(k)) for k in range(3)})
    by = ["dim", "label", "q0", "q1", "q2", "id", "kind"]
    return step(
        placed.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select("kind", "dim", "label", "id", "q")
        .mapInArrow(lambda batches: _pack(batches, tree_rows, first), _PACKED),
        "packed",
    )


def _renewed(df: DataFrame, *names: str) -> DataFrame:
    """The columns under new identities, so that rows of one table can meet each other."""
    return df.select(*[F.col(name).alias(name) for name in names])


def _hits(trees: DataFrame, anchors: DataFrame, extra: str, same_label: bool, first: int) -> DataFrame:
    """The best rows per anchor (and window), of all trees; ``extra`` is what an anchor's search starts from."""
    roots = _renewed(trees.filter(F.col("kind") == _BOX), "dim", "label", "tree", "part", "q", "high")
    sizes = trees.groupBy().agg(
        F.count_if(F.col("kind") == _ANCHOR), F.count_if(F.col("kind") == _BOX), F.max("part")
    ).first()
    n_parts = (sizes[2] or 0) + 1
    of_anchors, of_roots = min(n_parts, ceil(sizes[0] / ANCHORS) or 1), min(n_parts, ceil(sizes[1] / ROOTS) or 1)

    def block(n: int) -> F.Column:
        return F.floor(F.col("part") * n / n_parts).cast("int")

    asked = anchors.select("dim", "label", "key", "id", "q", extra, block(of_anchors).alias("a"))
    left = asked.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(of_roots - 1))))
    right = roots.withColumn("r", block(of_roots)).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(of_anchors - 1))))
    met = (
        left.groupBy("dim", "a", "r")
        .cogroup(right.groupBy("dim", "a", "r"))
        .applyInArrow(lambda x, y: _met(x, y, same_label), "key long, tree long")
    )
    sent = step(met.join(asked, "key").select("tree", "a", "key", "id", "q", extra), "sent")
    wanted = sent.select(F.col("tree").alias("t"), F.col("a").alias("b")).distinct()
    rows = _renewed(trees.filter(F.col("kind") == _ROW), "dim", "tree", "key", "id", "q").join(wanted, F.col("tree") == F.col("t"))
    found = (
        sent.groupBy("tree", "a")
        .cogroup(rows.groupBy("t", "b"))
        .applyInArrow(lambda x, y: _searched(x, y, same_label, first), _HITS)
    )
    order = Window.partitionBy("key", "wanted").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)


def mined(rows: DataFrame, anchors: F.Column, first: int = FIRST, tree_rows: int = TREE) -> DataFrame:
    """Hard negatives of the :func:`prepared` rows for which ``anchors`` holds.

    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: an anchor's positives are its ``first``
    best other rows of its label; for each, the ``first`` best rows of other labels with 0.8 to 1 times the positive's
    score. Fewer rows give fewer; ties go by id. Only vectors with as many components as the anchor's have a score with
    it. Rows with one id but different vectors or labels are different rows, none of them another's partner. Scores
    beyond a long count as the nearest long, as do such components. Without anchors, or rows, the result is empty.
    """
    rows = step(rows, "rows")
    trees = packed(rows, rows.filter(anchors), first, tree_rows)
    asking = trees.filter(F.col("kind") == _ANCHOR).select("dim", "label", "part", "key", "id", "q", "bound")
    positives = step(_hits(trees, asking, "bound", True, first).select("key", "score", F.col("id").alias("positive_id")), "positives")
    scores = positives.groupBy("key").agg(F.collect_set("score").alias("scores"))
    negatives = _hits(trees, asking.join(scores, "key"), "scores", False, first).select(
        "key", F.col("wanted").alias("score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return (
        positives.join(negatives, ["key", "score"])
        .join(asking.select("key", F.col("id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")
    )
