"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its runs of five words; a shingle weighs its count in the text times an
inverse document frequency. Each text gets ``HASHES`` weighted samples; two texts agree in a sample with the
probability of their weighted Jaccard similarity. Samples are taken in bands of ``ROWS``; texts that share a whole
band meet, and every pair that is looked at is verified by the exact weighted Jaccard similarity.

Document frequencies are counted over all texts in a table of fixed size (hashed features), so what the
tasks need of it is a megabyte at every input size. A shingle in up to ``COMMON`` of the texts weighs one; beyond that
its weight falls with the logarithm of its frequency to one half where every text has it. So boilerplate counts
less, and a large group of near copies still counts as similar.

Equal texts are one node from the start. Within a band's bucket nothing is paired all against all: every member
is compared with the bucket's hub, those unlike it with the hub of the rest, and what stays open after ``STAR_ROUNDS``
rounds only with texts it could be similar to at all (see :func:`linked_nodes`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.components import components
from fieldmill.llm.storage import step
from fieldmill.llm.words import ALPHANUMERIC, LOWER, find_words, mix, text_slices

SHINGLE, SIMILAR = 5, 0.8
HASHES, ROWS = 64, 4
STAR_ROUNDS = 3
COMMON = 0.02
_TABLE_BITS, _HASH_BITS, _POOL_BITS = 18, 44, 16
_LOW = np.uint64((1 << _HASH_BITS) - 1)


def weighted_shingles(
    data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 44-bit shingle hash, count) of each row's distinct shingles, in that order.

    Words are lower-cased runs of letters and digits. A text of fewer words than ``size`` is one shingle.
    """
    words = find_words(data, offsets, ALPHANUMERIC, LOWER)
    at, hashes = words.windows(size)
    row = words.row_of_word()[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = [mix(words.hashes[words.first[r] : words.first[r + 1]] + np.uint64(1)).sum(dtype=np.uint64) for r in short]
        row, hashes = np.append(row, short), np.append(hashes, mix(np.array(whole, np.uint64)))
    keys, counts = np.unique(
        (row.astype(np.uint64) << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS)), return_counts=True
    )
    return (keys >> np.uint64(_HASH_BITS)).astype(np.int64), keys & _LOW, counts


def _table_place(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(_HASH_BITS - _TABLE_BITS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << _TABLE_BITS, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            table += np.bincount(_table_place(weighted_shingles(data, offsets, size)[1]), minlength=len(table))
    used = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(table[used])], ["place", "n"])


def inverse_frequencies(texts: DataFrame, size: int = SHINGLE, common: float = COMMON) -> np.ndarray:
    """The weight of each of the 2^18 places of the frequency table, from every text."""
    spark = texts.sparkSession
    counted = (
        texts.select("text").mapInArrow(lambda b: _frequencies(b, size), "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    )
    total = texts.count()
    least = max(common * total, 1)
    frequent = counted.filter(F.col("n") > least).toArrow()  # at most one row a place
    weights = np.ones(1 << _TABLE_BITS, np.float32)
    share = np.log(np.minimum(frequent["n"].to_numpy(), total) / least) / np.log(max(total / least, 2.0))
    weights[frequent["place"].to_numpy()] = 1 - 0.5 * share
    return weights


class Sampler:
    """Consistent weighted samples, ``bands`` of ``rows`` each.

    For a shingle of weight S a sample is ``ln a(S) = ln a(1) - r t`` with ``t = floor(ln S / r + b)``, the improved
    scheme written from the sample at weight one, which is exponentially distributed. The pairs (r, b) come from
    a pool of 65,536 draws in the order of their ``a(1)``, so that they keep their joint distribution with it.
    """

    def __init__(self, hashes: int = HASHES, rows: int = ROWS, seed: int = 7):
        draw = np.random.default_rng(seed)
        n = 1 << _POOL_BITS
        r, c, b = draw.gamma(2.0, size=n), draw.gamma(2.0, size=n), draw.random(n)
        order = np.argsort(np.log(c) - r * (1 - b))
        self.r, self.b = r[order], b[order]
        self.salts = draw.integers(0, 1 << 63, hashes, dtype=np.uint64)
        self.odd = draw.integers(0, 1 << 63, hashes, dtype=np.uint64) | np.uint64(1)
        self.rows = rows

    def samples(self, row: np.ndarray, shingles: np.ndarray, weights: np.ndarray, rows: int) -> np.ndarray:
        """[rows, hashes] samples; a row without shingles has none that equals another's (its row number)."""
        first = np.flatnonzero(np.diff(row, prepend=-1))
        present = row[first]
        base = mix(shingles)
        other = np.flatnonzero(weights != 1)
        log_weight = np.log(weights[other])
        out = np.tile(mix(np.arange(rows, dtype=np.uint64))[:, None], (1, len(self.odd)))
        for k, (salt, odd) in enumerate(zip(self.salts, self.odd)):
            value = (base ^ salt) * odd
            value ^= value >> np.uint64(32)
            value *= odd
            if len(other):
                own = value[other]
                place = (own >> np.uint64(64 - _POOL_BITS)).astype(np.int64)
                r, b = self.r[place], self.b[place]
                steps = np.floor(log_weight / r + b)
                moved = steps != 0
                rate = -np.log1p(-np.minimum(own[moved] / 2.0**64, 1 - 2.0**-53)) * np.exp(-r[moved] * steps[moved])
                own[moved] = np.minimum(-np.expm1(-rate) * 2.0**64, 2.0**64 - 4096).astype(np.uint64)
                value[other] = own
            if len(first):
                out[present, k] = np.minimum.reduceat(value, first)
        return out

    def bands(self, samples: np.ndarray) -> np.ndarray:
        """[rows, bands] one hash for the samples of each band."""
        parts = samples.reshape(len(samples), -1, self.rows)
        key = np.zeros(parts.shape[:2], np.uint64) + np.arange(parts.shape[1], dtype=np.uint64)
        for j in range(self.rows):
            key = mix(key ^ parts[:, :, j])
        return key


def _sketch(batches: Iterator[pa.RecordBatch], shipped, size: int) -> Iterator[pa.RecordBatch]:
    sampler, weights = Sampler(), shipped.value
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column(2)):
            row, shingles, counts = weighted_shingles(data, offsets, size)
            samples = sampler.samples(row, shingles, counts * weights[_table_place(shingles)], high - low)
            keys = sampler.bands(samples).view(np.int64)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel())
            )
            none = pa.array(np.bincount(row, minlength=high - low) == 0)
            bands = pa.ListArray.from_arrays(bands.offsets, bands.values, mask=none)
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), bands], ["doc", "node", "bands"])


def _keyed_weights(column: pa.Array, table: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row and shingle in one key, weight) of a column's shingles, in the order of the keys."""
    keys, values = [np.empty(0, np.uint64)], [np.empty(0)]
    for first, _, data, offsets in text_slices(column):
        row, shingles, counts = weighted_shingles(data, offsets, size)
        keys.append(((row + first).astype(np.uint64) << np.uint64(_HASH_BITS)) | shingles)
        values.append(counts * table[_table_place(shingles)].astype(np.float64))
    return np.concatenate(keys), np.concatenate(values)


def _outside(shingles: np.ndarray, weights: np.ndarray, table: np.ndarray, droppable: float) -> np.ndarray:
    """The shingles without the most frequent ones that together weigh under ``droppable``.

    All texts drop in the same order, so the rarest shingle that two texts share is kept by both.
    """
    order = np.lexsort((shingles, table[_table_place(shingles)]))
    keep = np.cumsum(weights[order]) >= droppable if droppable > 0 else np.ones(len(order), bool)
    return shingles[order][keep].astype(np.int64)


def _compare(batches: Iterator[pa.RecordBatch], shipped, size: int, similar: float) -> Iterator[pa.RecordBatch]:
    """Compares text a with text b of each row exactly.

    ``linked``; the ``weight`` of a and the share of it that lies ``inside`` b; and of the shingles of a outside b those
    by which any third text similar to a can be found that doesn't owe it to what a shares with b (see
    :func:`linked_nodes`).
    """
    table = shipped.value
    for batch in batches:
        step_rows = max(1, batch.num_rows * (1 << 20) // max(1, batch.nbytes))
        for low in range(0, batch.num_rows, step_rows):
            part = batch.slice(low, step_rows)
            n = part.num_rows
            keys_a, weight_a = _keyed_weights(part.column(2), table, size)
            keys_b, weight_b = _keyed_weights(part.column(3), table, size)
            row_a = (keys_a >> np.uint64(_HASH_BITS)).astype(np.int64)
            row_b = (keys_b >> np.uint64(_HASH_BITS)).astype(np.int64)
            whole_a, whole_b = np.bincount(row_a, weight_a, n), np.bincount(row_b, weight_b, n)
            _, at_a, at_b = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
            shared = np.zeros(len(keys_a))
            shared[at_a] = np.minimum(weight_a[at_a], weight_b[at_b])
            common = np.bincount(row_a, shared, n)
            linked = (common > 0) & (common >= similar * (whole_a + whole_b - common))
            left = weight_a - shared
            first = np.searchsorted(row_a, np.arange(n + 1))
            outside = []
            for r in range(n):
                own = slice(first[r], first[r + 1])
                out = left[own] > 0
                outside.append(_outside(keys_a[own][out] & _LOW, left[own][out], table, similar * whole_a[r] - common[r]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(linked),
                    pa.array(whole_a),
                    pa.array(common / np.maximum(whole_a, 1e-300)),
                    pa.array(outside, pa.list_(pa.int64())),
                ],
                ["a", "b", "linked", "weight", "inside", "outside"],
            )


def _compared(pairs: DataFrame, texts: DataFrame, shipped, size: int, similar: float) -> DataFrame:
    own = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = own.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        lambda batches: _compare(batches, shipped, size, similar),
        "a string, b string, linked boolean, weight double, inside double, outside array<bigint>",
    )


def _third_texts(compared: DataFrame, open_pairs: DataFrame, known: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) of texts of one hub that may be similar, one of them open (unlike the hub).

    ``known`` has the ``component`` of each linked text ``a``; pairs within one are left out.

    Similar texts x and y share at least ``t (w(x) + w(y))`` of their weights, ``t = similar / (1 + similar)``. What both
    share with the hub bounds what they can share inside it; so either they share a shingle outside it, or the
    hub holds enough of both, and then their weights are as the conditions on weights say (of two texts of
    which the hub holds less than ``2 t`` neither can be the lighter one).
    """
    t = similar / (1 + similar)
    hubs = open_pairs.select(F.col("hub").alias("b")).distinct()
    still_open = open_pairs.select(F.col("node").alias("a"), F.col("hub").alias("b"), F.lit(True).alias("open"))
    group = compared.join(hubs, "b").join(still_open, ["a", "b"], "left")
    group = group.join(known, "a", "left").select(
        "b", "a", "weight", "inside", "outside", F.coalesce("open", F.lit(False)).alias("open"), F.coalesce("component", "a").alias("own")
    )
    several = group.groupBy("b").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low < high").select("b")
    group = step(group.join(several, "b"), "groups")
    unlike = group.filter("open")
    left = unlike.select("b", F.col("a").alias("x"), F.col("own").alias("of_x"), F.explode("outside").alias("shingle"))
    right = group.select("b", "open", F.col("a").alias("y"), F.col("own").alias("of_y"), F.explode("outside").alias("shingle"))
    outside = left.join(right, ["b", "shingle"]).filter("of_x <> of_y and (x < y or not open)").select("x", "y")
    lightest = group.filter(F.col("inside") >= 2 * t).groupBy("b").agg(F.min("weight").alias("least"))
    reach = (F.col("inside") / t - 1) * F.col("weight")
    unlike = unlike.filter(F.col("inside") >= similar).join(lightest, "b", "left")
    x = unlike.filter((F.col("inside") >= 2 * t) | (F.col("least") <= reach)).select("b", F.col("a").alias("x"), F.col("own").alias("of_x"), F.col("weight").alias("wx"), F.col("inside").alias("fx"))
    y = group.filter(F.col("inside") >= similar).select("b", F.col("a").alias("y"), F.col("own").alias("of_y"), F.col("weight").alias("wy"), F.col("inside").alias("fy"))
    both = t * (F.col("wx") + F.col("wy"))
    inside = (
        x.join(y, "b")
        .filter("of_x <> of_y")
        .filter((F.col("wy") >= similar * F.col("wx")) & (F.col("wx") >= similar * F.col("wy")))
        .filter((F.col("fx") * F.col("wx") >= both) & (F.col("fy") * F.col("wy") >= both))
        .select("x", "y")
    )
    pairs = outside.union(inside)
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _common_hubs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """The hub of a bucket of three or more becomes the best hub that any of its members meets in any bucket.

    A group of near copies falls into many buckets; so they share one hub, to which all are compared.
    """
    known = members.join(hubs, "band")
    best = known.groupBy("node").agg(F.max("top").alias("best"))
    larger = known.filter("n > 2").join(best, "node").groupBy("band").agg(F.max("best").alias("top"), F.max("n").alias("n"))
    return larger.union(hubs.filter("n = 2").select("band", "top", "n"))


def _central_texts(compared: DataFrame) -> DataFrame:
    """``(hub, central)`` for hubs of three or more texts of which some are unlike it.

    Shingles outside the hub that a quarter of its group has are common to the group; central is the text that
    consists of common shingles and the hub's own most.
    """
    sizes = compared.groupBy("b").agg(F.count("*").alias("size"), F.count_if(~F.col("linked")).alias("open"))
    group = compared.join(sizes.filter("size > 2 and open > 0"), "b")
    outside = group.select("b", "a", "size", F.explode("outside").alias("shingle"))
    counts = outside.groupBy("b", "shingle").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    common = counts.filter(F.col("n") * 4 >= F.col("size")).select("b", "shingle")
    held = outside.join(common, ["b", "shingle"]).groupBy("b", "a").agg(F.count("*").alias("held"))
    share = F.coalesce("held", F.lit(0)) / F.greatest(F.size("outside"), F.lit(1))
    scored = group.join(held, ["b", "a"], "left").withColumn("score", F.col("inside") + share * (1 - F.col("inside")))
    return scored.groupBy(F.col("b").alias("hub")).agg(F.max(F.struct("score", "a")).alias("top")).select("hub", F.col("top.a").alias("central"))


def linked_nodes(
    members: DataFrame, texts: DataFrame, shipped, size: int = SHINGLE, similar: float = SIMILAR, rounds: int = STAR_ROUNDS
) -> DataFrame:
    """Verified links ``(u, v)`` among ``members(band, node)``; ``texts`` has ``(node, text)``.

    Every member of a bucket is compared with its hub, a text that meets most others, and where some are unlike it,
    with the most central text of the hub's group, which takes the hub's place; what is open still with the
    hub of the rest, for ``rounds`` rounds. Whatever these later rounds found, a text unlike its first hub (or the central
    text in its place) is then compared with every text of that hub that it could be similar to at all: those with
    which it shares one of a few shingles outside the hub, or that the hub holds as largely as itself. Only pairs that
    links connect already are skipped. Of two texts of one bucket either both are linked to its hub or one is unlike it, so
    no link that joins two components is left out.
    """
    met_by = members.groupBy("band").agg(F.count("*").alias("n"))
    degrees = members.join(met_by, "band").groupBy("node").agg(F.sum("n").alias("degree"))
    rest = step(members.join(degrees, "node").withColumn("first", F.lit("")), "members")
    links, compared, open_pairs = None, None, None
    for k in range(rounds):
        hubs = rest.groupBy("band").agg(F.max(F.struct("degree", "node")).alias("top"), F.count("*").alias("n")).filter("n > 1")
        if k == 0:
            hubs = _common_hubs(rest, hubs)
        met = rest.join(hubs.select("band", F.col("top.node").alias("hub"), "n"), "band").filter("node <> hub")
        if k == 0:
            met = met.withColumn("first", F.col("hub"))
        pairs = met.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        judged = step(_compared(pairs, texts, shipped, size, similar), "pairs")
        own = judged.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = own if links is None else links.union(own)
        unlike = judged.filter("not linked").select(F.col("a").alias("node"), F.col("b").alias("hub"))
        if k == 0:
            central = step(_central_texts(judged), "central")
            group = judged.select(F.col("b").alias("hub"), "a").union(judged.select(F.col("b").alias("hub"), F.col("b").alias("a")))
            again = group.join(central, "hub").filter("a <> central").select("a", F.col("central").alias("b")).distinct()
            second = step(_compared(again, texts, shipped, size, similar), "pairs")
            links = links.union(second.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
            alone = judged.join(central, judged["b"] == central["hub"], "left_anti")
            compared = alone.union(second)
            # of a bucket of two all is known
            wide = met.filter("n > 2").select("node", "hub").distinct().join(central, "hub", "left")
            wide = wide.select("node", F.coalesce("central", "hub").alias("hub")).distinct()
            not_linked = compared.filter("not linked").select(F.col("a").alias("node"), F.col("b").alias("hub"))
            open_pairs = step(wide.join(not_linked.distinct(), ["node", "hub"]), "open")
        rest = met.join(unlike, ["node", "hub"]).select("band", "node", "degree", "first")
        if k == 0:
            renamed = rest.join(central, rest["first"] == central["hub"], "left")
            rest = renamed.select("band", "node", "degree", F.coalesce("central", "first").alias("first"))
            near = second.filter("linked").select(F.col("a").alias("node"), F.col("b").alias("first"))
            rest = rest.join(near, ["node", "first"], "left_anti").filter("node <> first").select("band", "node", "degree", "first")
        rest = step(rest, "rest")
    known = components(links).select(F.col("node").alias("a"), "component")
    judged = step(_compared(_third_texts(compared, open_pairs, known, similar), texts, shipped, size, similar), "open")
    return links.union(judged.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    similar: float = SIMILAR,
    common: float = COMMON,
) -> DataFrame:
    """``(doc, node, class_id)``, one row per row of ``docs``.

    ``class_id`` is the smallest id among the texts that links of similarity ``similar`` or more connect. ``node``
    stands for the text: equal texts share it. A null text is alone (no node, its own class); an empty text equals
    only other empty texts; a text of fewer than ``size`` words is one shingle. Rows without an id are classed by
    their text and never give a class its id unless none of its rows has one. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    given = rows.filter(F.col("text").isNotNull())
    shipped = spark.sparkContext.broadcast(inverse_frequencies(given, size, common))
    kind = rows.schema["doc"].dataType.simpleString()
    sketched = rows.select("doc", F.md5(F.col("text").cast("binary")).alias("node"), "text").mapInArrow(
        lambda batches: _sketch(batches, shipped, size), f"doc {kind}, node string, bands array<bigint>"
    )
    sketched = step(sketched, "sketches")
    nodes = sketched.filter("node is not null").groupBy("node").agg(F.min("doc").alias("doc"), F.min("bands").alias("bands"))
    bands = nodes.select("doc", "node", F.explode("bands").alias("band"))
    full = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    members = step(bands.join(full, "band"), "members")
    wanted = members.select(F.col("doc").alias("first_doc"), F.col("node").alias("first_node")).distinct()
    by_node = given.withColumn("node", F.md5(F.col("text").cast("binary")))
    texts = by_node.join(wanted, by_node["doc"].eqNullSafe(wanted["first_doc"]) & (by_node["node"] == wanted["first_node"]))
    texts = step(texts.select("node", "text").dropDuplicates(["node"]), "texts")
    links = linked_nodes(members.select("band", "node"), texts, shipped, size, similar)
    found = components(links)
    classes = nodes.select("node", "doc").join(found, "node").select("node", "doc", "component")
    first = classes.groupBy("component").agg(F.min("doc").alias("first"))
    linked = classes.join(first, "component").select("node", F.col("first").alias("linked"))
    alone = nodes.select("node", F.col("doc").alias("own"))
    return (
        sketched.select("doc", "node")
        .join(alone.join(linked, "node", "left"), "node", "left")
        .select("doc", "node", F.coalesce("linked", "own", "doc").alias("class_id"))
    )


def one_of_each(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each class, all columns kept; rows with null text all stay.

    Of repeated rows (same id and text) one stays.
    """
    first = classes.filter("node is not null and doc <=> class_id").select(F.col("doc").alias("_first"), F.col("node").alias("_node"))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select(
        "row", F.col("row")[id_col].alias("_doc"), F.md5(F.col("row")[text_col].cast("binary")).alias("_node")
    )
    chosen = first.distinct().withColumnRenamed("_node", "_first_node")
    kept = (
        keyed.filter("_node is not null")
        .join(chosen, keyed["_doc"].eqNullSafe(F.col("_first")) & (F.col("_node") == F.col("_first_node")), "left_semi")
        .dropDuplicates(["_doc", "_node"])
    )
    return kept.select("row.*").union(keyed.filter("_node is null").select("row.*"))
