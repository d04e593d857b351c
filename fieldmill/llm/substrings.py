"""Long spans of words that repeat across documents, found in a compacted graph of word windows.

Every window of ``window`` words is an edge of a De Bruijn graph (from its first ``window - 1`` words to its
last). The steps, all joins and aggregations over short rows:

0. *Copies.* Of equal texts only the one with the smallest id takes part; the others repeat it whole.
1. *Candidates.* Equal windows have the same smallest ``seed``-word hash inside. Only runs of windows whose
   seed occurs in two documents can repeat, so only those become edges.
2. *Edges.* Per edge: its first source coordinate (smallest id, then position) and whether its neighbours
   are the same in all its occurrences.
3. *Compaction.* Within a document, successive repeated edges with the same source and no branch between
   them are one path; paths that go on at the same source are one span: one row
   ``(document, start, length, source, source start)``.
4. *Verification.* The words at both coordinates of a span are compared by digest. Where they differ, two windows share a
   hash: all occurrences of that span's hashes are then grouped by the digest of their words, window by window.

Grouped minima combine before their shuffle. The edges that repeat are stored before all windows are joined with them, so
both sides of that join are shuffles and adaptive execution may split it: a line that a third of all documents
share is no single task's burden. Spans that more than one in ``HEAVY`` of all spans equal are judged by a broadcast of
their digests, of which there are fewer than ``HEAVY``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step
from fieldmill.llm.words import UNSPACED, Words, as_signed, find_words, mix, text_slices

WINDOW, SEED = 13, 5
HEAVY = 1000
_HALF = np.uint64(0x9E3779B97F4A7C15)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` successive values."""
    reach, least = 1, values
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _seed_runs(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, last window, seed hash) of maximal runs of windows with one smallest seed."""
    empty = np.empty(0, np.int64)
    n = len(words.hashes) - seed + 1
    at, _ = words.windows(window)
    if n <= 0 or not len(at):
        return empty, empty, empty, np.empty(0, np.uint64)
    seeds = np.full(len(words.hashes), np.iinfo(np.uint64).max, np.uint64)
    where, hashes = words.windows(seed)
    seeds[where] = hashes
    least = _sliding_min(seeds, window - seed + 1)[at]
    row = words.row_of_word()[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    base = words.first[row[first]]
    return row[first], at[first] - base, at[last] - base, least[first]


def _seeds(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, _, data, offsets in text_slices(batch.column(1)):
            row, first, last, hashes = _seed_runs(find_words(data, offsets, UNSPACED), window, seed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row + low)), as_signed(hashes), pa.array((first << 32) | last)],
                ["doc", "seed", "run"],
            )


def _first_places(edges: np.ndarray, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The position at which each edge occurs first in its row; rows and positions ascend."""
    order = np.argsort(edges, kind="stable")
    sorted_edges, sorted_row = edges[order], row[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_edges[1:] != sorted_edges[:-1]) | (sorted_row[1:] != sorted_row[:-1])
    first = np.empty(len(order), pos.dtype)
    first[order] = pos[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return first


def _edges(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each candidate window: its hash, where its text has it first, and a short hash of its neighbours."""
    for batch in batches:
        runs = batch.column(3)
        run_first, run_values = runs.offsets.to_numpy(), runs.values.to_numpy()
        for low, high, data, offsets in text_slices(batch.column(2)):
            words = find_words(data, offsets, UNSPACED)
            at, hashes = words.windows(window)
            edge = np.zeros(len(words.hashes) + 1, np.uint64)
            edge[at] = np.maximum(hashes >> np.uint64(64 - bits), 1)
            values = run_values[run_first[low] : run_first[high]]
            row = np.repeat(np.arange(words.rows), np.diff(run_first[low : high + 1]))
            first = (values >> 32) + words.first[row]
            last = np.minimum((values & 0xFFFFFFFF) + words.first[row], words.first[row + 1] - window)
            change = np.zeros(len(edge) + 1, np.int64)
            ok = last >= first
            np.add.at(change, first[ok], 1)
            np.add.at(change, last[ok] + 1, -1)
            edge[np.cumsum(change)[: len(edge)] == 0] = 0
            pick = np.flatnonzero(edge)
            before, after = np.roll(edge, 1), np.roll(edge, -1)
            row = np.searchsorted(words.first, pick, side="right") - 1
            before[words.first[:-1]] = 0
            take = pa.array(row + low)
            pos = (pick - words.first[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    as_signed(edge[pick]),
                    pa.array(pos),
                    pa.array(_first_places(edge[pick], row, pos)),
                    pa.array(mix(before[pick] ^ (after[pick] * _HALF)).astype(np.uint32).view(np.int32)),
                ],
                ["doc", "variant", "edge", "pos", "first", "around"],
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of 128 bits of the words of each asked span."""
    for batch in batches:
        row, start, n, digest = [], [], [], []
        for k, (text, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            words = (text or "").encode().split()
            for span in spans:
                row.append(k)
                start.append(span["start"])
                n.append(span["n"])
                own = b" ".join(words[span["start"] : span["start"] + span["n"]])
                digest.append(hashlib.blake2b(own, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(start, pa.int32()),
                pa.array(n, pa.int32()),
                pa.array(digest, pa.binary()),
            ],
            ["key", "start", "n", "digest"],
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, texts = [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = (text or "").encode().split()
            keep = np.ones(len(words), bool)
            for span in spans or ():
                keep[span["start"] : span["start"] + span["n"]] = False
            texts.append(b" ".join(compress(words, keep.tolist())).decode())
            removed.append((len(words), int(len(words) - keep.sum())))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for n, _ in removed], pa.int64()),
                pa.array([n for _, n in removed], pa.int64()),
                pa.array(texts, pa.string()),
            ],
            ["key", "n_words", "n_removed", "kept"],
        )


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, uid, text)``: rows with the same id and text share a ``uid``, a digest of 128 bits, and are treated alike."""
    both = F.to_json(F.struct(docs[id_col].alias("id"), F.md5(docs[text_col].cast("binary")).alias("text")))
    return docs.select(docs[id_col].alias("doc"), F.unhex(F.md5(both.cast("binary"))).alias("uid"), docs[text_col].alias("text"))


def copies(rows: DataFrame) -> DataFrame:
    """``(doc, uid)`` of the texts that equal one with a smaller id."""
    short = rows.filter(F.col("doc").isNotNull() & F.col("text").isNotNull()).select(
        "doc", "uid", F.md5(F.col("text").cast("binary")).alias("same")
    )
    first = short.groupBy("same").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first <> last")
    return short.join(first, "same").filter("doc > first").select("doc", "uid").distinct()


def candidate_texts(rows: DataFrame, copied: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``(doc, variant, uid, text, runs)``: texts with windows whose seed occurs in two documents, and where; no copies.

    Different texts of one id are told apart by ``variant``; of repeated rows one is taken.
    """
    kind = rows.schema["doc"].dataType.simpleString()
    seeds = (
        rows.filter(F.col("doc").isNotNull() & F.col("text").isNotNull())
        .select("doc", "text")
        .mapInArrow(lambda batches: _seeds(batches, window, seed), f"doc {kind}, seed long, run long")
    )
    shared = seeds.groupBy("seed").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a <> b").select("seed")
    runs = seeds.join(shared, "seed").groupBy("doc").agg(F.collect_list("run").alias("runs"))
    # the copies of an id meet its runs, not its texts, which so are shuffled by id only
    held = copied.groupBy("doc").agg(F.collect_set("uid").alias("copies"))
    texts = rows.join(runs.join(held, "doc", "left"), "doc")
    order = Window.partitionBy("doc").orderBy("uid")
    numbered = texts.withColumn("variant", F.dense_rank().over(order)).withColumn("before", F.lag("uid").over(order))
    single = numbered.filter("before is null or before <> uid")
    own = F.coalesce(F.array_contains("copies", F.col("uid")), F.lit(False))
    return single.filter(~own).select("doc", "variant", "uid", "text", "runs")


def window_edges(texts: DataFrame, window: int = WINDOW, bits: int = 64) -> DataFrame:
    """``(doc, variant, edge, pos, first, around)``: the candidate windows of ``candidate_texts``, hashed to ``bits`` bits."""
    kind = texts.schema["doc"].dataType.simpleString()
    return texts.select("doc", "variant", "text", "runs").mapInArrow(
        lambda batches: _edges(batches, window, bits), f"doc {kind}, variant int, edge long, pos int, first int, around int"
    )


def repeated_edges(edges: DataFrame) -> DataFrame:
    """``(edge, source, source_pos, branches)`` of the edges that two documents have: the smallest id and the first place
    there, and whether neighbours differ. Where texts share that id, the place is that of any of them.
    """
    known = edges.groupBy("edge").agg(
        F.min("doc").alias("source"),
        F.max("doc").alias("last"),
        F.min_by("first", "doc").alias("source_pos"),
        F.min("around").alias("least"),
        F.max("around").alias("most"),
    )
    return known.filter("source < last").select("edge", "source", "source_pos", F.expr("least <> most").alias("branches"))


def later_edges(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``(doc, variant, pos, source, source_pos, branches)`` of the windows that a smaller id has too; ``known`` is stored."""
    return (
        edges.select("doc", "variant", "edge", "pos")
        .join(known, "edge")
        .filter("source < doc")
        .select("doc", "variant", "pos", "source", "source_pos", "branches")
    )


def repeated_paths(texts: DataFrame, window: int = WINDOW, bits: int = 64) -> DataFrame:
    """Repeated spans in ``candidate_texts``, by hash: ``(doc, variant, start, n, source, source_start)``.

    ``start`` and ``n`` count words; the same ``n`` words begin at ``source_start`` of the source, which has a smaller id.
    """
    edges = window_edges(texts, window, bits)
    later = later_edges(edges, step(repeated_edges(edges), "edges"))
    order = Window.partitionBy("doc", "variant").orderBy("pos")
    previous = F.lag(F.struct("pos", "source", "source_pos", "branches")).over(order)
    goes_on = F.coalesce(
        (previous["pos"] == F.col("pos") - 1)
        & (previous["source"] == F.col("source"))
        & (previous["source_pos"] == F.col("source_pos") - 1),
        F.lit(False),
    )
    branch = previous["branches"] | F.col("branches")
    paths = (
        later.withColumn("leaves", F.when(goes_on, 0).otherwise(1))
        .withColumn("new", F.when(goes_on & ~branch, 0).otherwise(1))
        .withColumn("span", F.sum("leaves").over(order))
        .withColumn("path", F.sum("new").over(order))
        .groupBy("doc", "variant", "path")
        .agg(
            F.min("span").alias("span"),
            F.min("pos").alias("start"),
            F.count("*").alias("windows"),
            F.min("source").alias("source"),
            F.min("source_pos").alias("source_start"),
        )
    )
    return (
        paths.groupBy("doc", "variant", "span")
        .agg(
            F.min("start").alias("start"),
            (F.sum("windows") + window - 1).cast("int").alias("n"),
            F.min("source").alias("source"),
            F.min("source_start").alias("source_start"),
        )
        .drop("span")
    )


def _digested(places: DataFrame, texts: DataFrame) -> DataFrame:
    """``(doc, variant, uid, start, n, digest)``: the words of ``places(doc, span)`` in every text of that id."""
    kind = texts.schema["doc"].dataType.simpleString()
    asked = places.groupBy("doc").agg(F.collect_set("span").alias("spans"))
    digests = texts.select("doc", "variant", "uid", "text").join(asked, "doc").select(
        F.struct("doc", "variant", "uid").alias("key"), "text", "spans"
    )
    digests = digests.mapInArrow(
        _digests, f"key struct<doc:{kind},variant:int,uid:binary>, start int, n int, digest binary"
    )
    return step(digests.select("key.*", "start", "n", "digest"), "digests")


def verified(paths: DataFrame, texts: DataFrame) -> DataFrame:
    """The stored ``paths`` with ``uid``, and ``same``: whether their words equal those at their source.

    A span that a large share of all documents has is one key of the last join. Such keys, each with more than one in
    ``HEAVY`` of the rows and so fewer than ``HEAVY``, are broadcast with their answer; the others are shuffled.
    """
    places = paths.select("doc", F.struct("start", "n").alias("span")).union(
        paths.select(F.col("source").alias("doc"), F.struct(F.col("source_start").alias("start"), "n").alias("span"))
    )
    digests = _digested(places, texts)
    at = ["source", "source_start", "n", "digest"]
    true = F.lit(True).alias("same")
    source = digests.select(F.col("doc").alias("source"), F.col("start").alias("source_start"), "n", "digest").distinct()
    own = step(paths.join(digests, ["doc", "variant", "start", "n"]), "own")
    most = own.count() // HEAVY
    heavy = own.groupBy(*at).count().filter(F.col("count") > most).select(*at)
    heavy = step(heavy.join(source.select(*at, true), at, "left"), "heavy")
    few = own.join(F.broadcast(heavy), at)
    rest = own.join(F.broadcast(heavy.select(*at)), at, "left_anti").join(source.select(*at, true), at, "left")
    columns = ["doc", "variant", "uid", "start", "n", "source", "source_start", F.coalesce("same", F.lit(False)).alias("same")]
    return few.select(*columns).union(rest.select(*columns))


def _window_by_window(failed: DataFrame, texts: DataFrame, window: int, bits: int) -> DataFrame:
    """Repeats among all windows whose hash occurs in the ``failed`` paths, found by the digest of their words."""
    edges = window_edges(texts, window, bits).select("doc", "variant", "edge", "pos")
    at = failed.select("doc", "variant", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - window)).alias("pos"))
    hashes = step(edges.join(at, ["doc", "variant", "pos"]).select("edge").distinct(), "hashes")
    occurrences = step(edges.join(hashes, "edge").select("doc", "variant", F.col("pos").alias("start")), "occurrences")
    places = occurrences.select("doc", F.struct("start", F.lit(window).alias("n")).alias("span"))
    digests = _digested(places, texts).join(occurrences, ["doc", "variant", "start"])
    first = digests.groupBy("digest").agg(F.min(F.struct("doc", "start")).alias("source"))
    return (
        digests.join(first, "digest")
        .filter(F.col("source.doc") < F.col("doc"))
        .select("doc", "uid", "start", "n", F.col("source.doc").alias("source"), F.col("source.start").alias("source_start"))
    )


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    seed: int = SEED,
    bits: int = 64,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified repeated spans of ``docs``, the stored texts they lie in, and the whole copies ``(doc, uid)``.

    Words are runs of anything but ASCII white space. A span is covered by windows of ``window`` words that also start
    in a document with a smaller id (the source). Null and short texts have none; rows without an id take no
    part; rows that share an id never count as repeats of each other; a text that repeats itself isn't a
    repeat either. Other columns are ignored. Equal spans of many documents all name the smallest id. A text equal
    to one with a smaller id isn't among the spans but among the copies: all its windows repeat. Windows are hashed to
    ``bits`` bits; fewer cost time, not results.
    """
    ship(docs.sparkSession)
    rows = identified(docs, id_col, text_col)
    copied = step(copies(rows), "copies")
    texts = step(candidate_texts(rows, copied, window, seed), "texts")
    paths = step(verified(step(repeated_paths(texts, window, bits), "paths"), texts), "verified")
    spans = paths.filter("same").select("doc", "uid", "start", "n", "source", "source_start")
    failed = paths.filter("not same")
    if not failed.isEmpty():
        spans = spans.union(_window_by_window(failed, texts, window, bits))
    return spans, texts, copied


def kept_texts(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """``(uid, n_words, n_removed, kept)`` of the texts that lose words, one row per uid."""
    cut = spans.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    rows = texts.select("uid", "text").join(cut, "uid").dropDuplicates(["uid"])
    return rows.mapInArrow(_kept, "key binary, n_words long, n_removed long, kept string").withColumnRenamed("key", "uid")


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, uid, n_words, kept)`` of every row as if nothing were removed."""
    rows = identified(docs, id_col, text_col)
    kind = rows.schema["doc"].dataType.simpleString()
    whole = rows.select(F.struct("doc", "uid").alias("key"), "text", F.array().cast("array<struct<start:int,n:int>>").alias("s"))
    return whole.mapInArrow(
        _kept, f"key struct<doc:{kind},uid:binary>, n_words long, n_removed long, kept string"
    ).select("key.doc", "key.uid", "n_words", "kept")
