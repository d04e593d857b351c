"""Benchmark decontamination: windows of benchmark words are looked up in every document.

The benchmark's distinct word windows are stored, and become a hash set that every task holds. Up to ``block_windows`` of
them are one set. A larger benchmark is dealt to blocks of about that size by hash: each block comes to the driver, is
broadcast, looked up in all documents, and its broadcast destroyed when the hits are stored, before the next begins; so
one block is all that any process holds. Document windows are hashed and looked up in bulk; each hit is verified by
its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step
from fieldmill.llm.words import ALPHANUMERIC, LOWER, find_words, text_slices

WINDOW, BLOCK_WINDOWS = 13, 250_000
_FILTER_BITS = 22
_SCAN = "n_words long, hits array<struct<start:int,end:int>>, items array<string>"


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        for low, high, data, offsets in text_slices(batch.column(1)):
            words = find_words(data, offsets, ALPHANUMERIC, LOWER)
            out: list[tuple] = []
            for row in range(words.rows):
                a, b = int(words.first[row]), int(words.first[row + 1])
                if b > a:
                    size = min(window, b - a)
                    own = {words.joined(i, i + size).decode() for i in range(a, b - size + 1)}
                    out.extend((x, size, names[low + row]) for x in own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.string(), pa.int32(), pa.string()))],
                ["words", "size", "item"],
            )


def benchmark_windows(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(words, size, items)``: each distinct window of normalised words and the items that have it.

    Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased. An item with
    fewer words than ``window`` is one window. A null or wordless text has none; an item without an id
    counts for hits and is not listed.
    """
    found = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).mapInArrow(
        lambda batches: _item_windows(batches, window), "words string, size int, item string"
    )
    return found.groupBy("words", "size").agg(F.array_sort(F.collect_set("item")).alias("items"))


class WindowSet:
    """Windows of words with the items that have them; cheap to ship, finds hits in bulk."""

    def __init__(self, rows: list[tuple[str, int, list[str]]]):
        self.items = {words.encode(): tuple(items) for words, _, items in rows}
        self.sizes: dict[int, np.ndarray] = {}
        for size in sorted({size for _, size, _ in rows}):
            column = pa.array([words for words, s, _ in rows if s == size], pa.large_string())
            hashes = [
                find_words(data, offsets, ALPHANUMERIC).windows(size)[1] for _, _, data, offsets in text_slices(column)
            ]
            self.sizes[size] = np.unique(np.concatenate(hashes))

    def hits(self, words) -> list[tuple[int, int, tuple[str, ...]]]:
        """(first word, end word, items) of each verified window."""
        found = []
        for size, known in self.sizes.items():
            at, hashes = words.windows(size)
            flags = np.zeros(1 << _FILTER_BITS, bool)
            shift = np.uint64(64 - _FILTER_BITS)
            flags[known >> shift] = True
            maybe = np.flatnonzero(flags[hashes >> shift])
            place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
            for i in at[maybe[known[place] == hashes[maybe]]].tolist():
                items = self.items.get(words.joined(i, i + size))
                if items is not None:
                    found.append((i, i + size, items))
        return found


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch], shipped) -> Iterator[pa.RecordBatch]:
    """``(doc, n_words, hits, items)`` of ``(doc, text)``."""
    known: WindowSet = shipped.value
    for batch in batches:
        counts = np.zeros(batch.num_rows, np.int64)
        spans: list[list] = [[] for _ in range(batch.num_rows)]
        named: list[set] = [set() for _ in range(batch.num_rows)]
        for low, _, data, offsets in text_slices(batch.column(1)):
            words = find_words(data, offsets, ALPHANUMERIC, LOWER)
            counts[low : low + words.rows] = words.counts
            found = known.hits(words)
            rows = np.searchsorted(words.first, [h[0] for h in found], side="right") - 1
            for (a, b, names), row in zip(found, rows.tolist()):
                base = int(words.first[row])
                spans[low + row].append((a - base, b - base))
                named[low + row].update(names)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts),
                pa.array([_merged(x) for x in spans], _SPANS),
                pa.array([sorted(x) for x in named], pa.list_(pa.string())),
            ],
            ["doc", "n_words", "hits", "items"],
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits of all blocks, merged where they touch."""
    for batch in batches:
        spans = [[(h["start"], h["end"]) for hits in x or () for h in hits] for x in batch.column(2).to_pylist()]
        merged = pa.array([_merged(x) for x in spans], _SPANS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), merged, batch.column(3)], ["doc", "n_words", "hits", "items"]
        )


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def scan_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` as the struct ``doc``, and what of the benchmark each text holds.

    ``n_words``; ``hits``, the word spans (start, end exclusive) covered by occurrences of benchmark windows, merged where
    they touch; ``items``, the ids with an occurring window, sorted as strings. Null and empty texts have no words and no
    hits; repeated rows and repeated items are judged each on their own; an empty benchmark hits nothing. Columns of
    ``docs`` may have any names. With more than ``block_windows`` different windows the documents are stored once and read once
    for each block of about so many.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.struct(*[docs[c] for c in (docs.columns if keep is None else keep)]).alias("doc"), docs[text_col].alias("text")
    )
    kind = rows.schema["doc"].dataType.simpleString()
    windows = step(benchmark_windows(benchmark, item_col, item_text_col, window), "windows")
    blocks = -(-windows.count() // block_windows)

    def shipped(block: DataFrame):
        return spark.sparkContext.broadcast(WindowSet([tuple(row) for row in block.collect()]))

    if blocks <= 1:
        known = shipped(windows)
        return rows.mapInArrow(lambda batches: _scan(batches, known), f"doc {kind}, {_SCAN}")
    rows = step(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = []
    for k in range(blocks):
        known = shipped(windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k))
        scanned = rows.select("row", "text").mapInArrow(lambda batches, known=known: _scan(batches, known), f"doc long, {_SCAN}")
        found.append(step(scanned if k == 0 else scanned.filter(F.size("hits") > 0), "hits"))
        known.destroy()
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    hits = every.groupBy(F.col("doc").alias("row")).agg(
        F.max("n_words").alias("n_words"),
        F.collect_list("hits").alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return (
        rows.select("row", "doc")
        .join(hits, "row")
        .select("doc", "n_words", "hits", "items")
        .mapInArrow(_joined, f"doc {kind}, {_SCAN}")
    )


def judged(scanned: DataFrame, share: int = 20) -> DataFrame:
    """Adds ``n_hit`` (words in hits) and ``contaminated``: a hit, and one word in ``share`` or more hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + (h["end"] - h["start"]))
    return scanned.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept: list[str | None] = batch.column(1).to_pylist()
        hits = batch.column(2).to_pylist()
        for low, _, data, offsets in text_slices(batch.column(1)):
            words = find_words(data, offsets, ALPHANUMERIC, LOWER)
            for row in range(words.rows):
                if spans := hits[low + row]:
                    raw = data[offsets[row] : offsets[row + 1]].tobytes()
                    at, base, first = 0, int(offsets[row]), int(words.first[row])
                    parts = []
                    for span in spans:
                        parts.append(raw[at : int(words.starts[first + span["start"]]) - base])
                        at = int(words.ends[first + span["end"] - 1]) - base
                    kept[low + row] = b"".join([*parts, raw[at:]]).decode()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], ["doc", "text"])


def remove_spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the words of their hits cut out, all other characters kept."""
    kind = scanned.schema["doc"].dataType
    cut = scanned.select("doc", F.col("doc")[text_col].alias("text"), "hits").mapInArrow(
        _cut, f"doc {kind.simpleString()}, text string"
    )
    return cut.select(*[F.col("text" if c == text_col else f"doc.`{c}`").alias(c) for c in kind.names])


def remove_documents(scanned: DataFrame, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return judged(scanned, share).filter(~F.col("contaminated")).select("doc.*")
