"""Long byte strings that occur twice, found with a run-length index over the few passages that may repeat.

A *window* is ``window`` bytes. The steps:

0. *Copies.* Equal texts are one row with a count; a text with a copy repeats as a whole.
1. *Seeds.* Hashes of ``gram`` bytes, one in ``every`` of them; a window without one has its smallest hash as seed.
   Both depend on the window's bytes alone, so equal windows have equal seeds.
2. *Segments.* A window's key is its rarest seed (ties by hash). A key that occurs once belongs to a unique
   window; successive windows with one repeated key are a segment.
3. *Equal segments* are counted by digest; all windows of a repeated segment repeat.
4. *Index.* What is left, the different segments of one key and those that hold it twice, meets in blocks of about ``block`` bytes. Each block
   becomes a run-compressed Burrows-Wheeler transform with the text places at its run ends; lengths of common
   prefixes are compared at those places only, and streaming through the text gives every position's longest
   match elsewhere, one less than at the position before unless a run end lies there. Matches of ``window`` or more
   are marked.
5. *Heavy keys.* The segments of a key with more than a block are dealt to several blocks; the different windows of
   each then meet by 128-bit hash, in as many buckets of hashes.

Only hashes, digests and spans are grouped, with partial aggregation; texts are joined by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step
from fieldmill.llm.words import as_signed, mix

WINDOW, GRAM, EVERY, BLOCK = 400, 32, 64, 1 << 19
SLICE_BYTES = 1 << 20
#: The longest segment in windows; longer runs of windows are cut, each window stays in one piece.
LONGEST = 1 << 16
_BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8), offsets


def _slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets into them) of about ``SLICE_BYTES`` each, whole rows; null is empty."""
    data, offsets = _flat(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def window_hashes(data: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each position, whatever rows they belong to."""
    n = len(data)
    if n < width:
        return np.empty(0, np.uint64)
    if which not in _powers or len(_powers[which][0]) < n:
        tables = []
        for base in (int(_BASES[which]), pow(int(_BASES[which]), -1, 1 << 64)):
            steps = np.full(max(n, 2 * SLICE_BYTES), np.uint64(base))
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[which] = tables[0], tables[1]
    powers, inverses = _powers[which]
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=summed[1:])
    return mix((summed[width:] - summed[: n - width + 1]) * inverses[: n - width + 1])


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` successive values."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = best(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return best(out[: len(out) - rest], out[rest:]) if rest else out


class Seeds:
    """The seeds of a slice: places and hashes of the sampled grams, and the windows that have none.

    ``at`` / ``hashes``: sampled grams. ``bare`` / ``least``: first byte and smallest gram hash of each window without a
    sampled gram; ``bare_at`` / ``bare_hashes``: the grams that are such a window's smallest.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int, every: int):
        self.window, self.grams = window, window - gram + 1
        hashes = window_hashes(data, gram)
        inside = np.zeros(len(hashes) + 1, np.int64)
        long = np.flatnonzero(np.diff(offsets) >= window)
        self.first, self.end = offsets[long], offsets[long + 1] - window + 1
        self.long = long
        np.add.at(inside, self.first, 1)
        np.add.at(inside, self.end + self.grams - 1, -1)
        inside = np.cumsum(inside[:-1]) > 0
        self.at = np.flatnonzero(inside & (hashes < np.uint64((1 << 64) // every)))
        self.hashes = hashes[self.at]
        bare, least, bare_at = [], [], []
        # stretches of windows that reach no sampled gram: between one and the next, or an end of the row
        left = np.concatenate([self.first, self.at + 1])
        right = np.concatenate([self.end + self.grams - 1, self.at])
        left, right = np.sort(left), np.sort(right)
        for low, high in zip(left.tolist(), right.tolist()):
            if high - low >= self.grams:
                own = _sliding(hashes[low:high], self.grams, np.minimum)
                bare.append(np.arange(low, low + len(own)))
                least.append(own)
                padded = np.concatenate([np.zeros(self.grams - 1, np.uint64), own, np.zeros(self.grams - 1, np.uint64)])
                bare_at.append(low + np.flatnonzero(_sliding(padded, self.grams, np.maximum) == hashes[low:high]))
        self.bare = np.concatenate(bare) if bare else np.empty(0, np.int64)
        self.least = np.concatenate(least) if least else np.empty(0, np.uint64)
        self.bare_at = np.concatenate(bare_at) if bare_at else np.empty(0, np.int64)
        self.bare_hashes = hashes[self.bare_at]

    def rows_of(self, places: np.ndarray) -> np.ndarray:
        """The row of each place that lies in a long enough row."""
        return self.long[np.searchsorted(self.first, places, side="right") - 1]

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, hash, occurrences in the row) of every seed."""
        row = self.rows_of(np.concatenate([self.at, self.bare_at]))
        hashes = np.concatenate([self.hashes, self.bare_hashes])
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        where = np.flatnonzero(new)
        return row[where], hashes[where], np.diff(np.append(where, len(row)))

    def holds_twice(self, starts: np.ndarray, stops: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Whether a segment has its key at two places, without which no two of its own windows are equal."""
        places = np.concatenate([self.at, self.bare_at])
        names, named = np.unique(np.concatenate([self.hashes, self.bare_hashes]), return_inverse=True)
        wide = int(self.end[-1]) + self.grams if len(self.end) else 1
        placed = np.sort(named * wide + places)
        own = np.searchsorted(names, key) * wide
        return np.searchsorted(placed, own + stops + self.grams - 1) - np.searchsorted(placed, own + starts) > 1

    def segments(self, row: np.ndarray, seed: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, end of windows, key) of the segments, given the seeds that occur twice: their row, hash and count."""
        empty = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        if not len(seed):
            return empty
        names, named = np.unique(seed, return_inverse=True)
        pairs = row * len(names) + named
        order = np.argsort(pairs)
        pairs, counts = pairs[order], count[order]

        def known(places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
            """Where the (row, hash) stands in ``pairs``, or -1."""
            if not len(places):
                return np.empty(0, np.int64)
            name = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
            wanted = self.rows_of(places) * len(names) + name
            found = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
            return np.where((names[name] == hashes) & (pairs[found] == wanted), found, -1)

        # windows change their key only where a gram enters or leaves
        reach = self.grams - 1
        ends = np.concatenate([self.at + 1, self.at - reach, self.first])
        own = np.searchsorted(self.first, np.concatenate([self.at, self.at, self.first]), side="right") - 1
        ends = np.maximum(ends, self.first[own])
        starts = np.unique(ends[ends < self.end[own]])
        stops = np.append(starts[1:], 0)
        row_end = self.end[np.searchsorted(self.first, starts, side="right") - 1]
        stops = np.where((stops == 0) | (stops > row_end), row_end, stops)
        low, high = np.searchsorted(self.at, starts), np.searchsorted(self.at, starts + reach, side="right")
        full = low < high
        starts, stops, low, high = starts[full], stops[full], low[full], high[full]
        key = np.empty(0, np.int64)
        if len(starts):
            place = known(self.at, self.hashes)
            hashes = np.where(place < 0, np.uint64(0), self.hashes)
            times = np.where(place < 0, 0, counts[place])
            _, rank = np.unique(np.rec.fromarrays([times, hashes]), return_inverse=True)
            by_rank = np.zeros(rank.max() + 1, np.uint64)
            by_rank[rank] = hashes
            single = rank[place < 0][0] if (place < 0).any() else -1
            bounds = np.empty(2 * len(low), np.int64)
            bounds[::2], bounds[1::2] = low, high
            key = np.minimum.reduceat(np.append(rank, rank.max() + 1), bounds)[::2]
            keep = key != single
            starts, stops, key = starts[keep], stops[keep], by_rank[key[keep]]
        if len(self.bare):
            found = known(self.bare, self.least) >= 0
            starts = np.concatenate([starts, self.bare[found]])
            stops = np.concatenate([stops, self.bare[found] + 1])
            key = np.concatenate([key.astype(np.uint64), self.least[found]])
            order = np.argsort(starts)
            starts, stops, key = starts[order], stops[order], key[order]
        if not len(starts):
            return empty
        new = np.ones(len(starts), bool)
        new[1:] = (key[1:] != key[:-1]) | (starts[1:] != stops[:-1])
        new[1:] |= self.rows_of(starts[1:]) != self.rows_of(starts[:-1])
        first = np.flatnonzero(new)
        starts, stops, key = starts[first], stops[np.append(first[1:], len(stops)) - 1], key[first]
        pieces = (stops - starts + LONGEST - 1) // LONGEST
        part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, stops, key = (np.repeat(values, pieces) for values in (starts, stops, key))
        starts = starts + part * LONGEST
        return starts, np.minimum(stops, starts + LONGEST), key


def _seed_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int, every: int) -> Iterator[pa.RecordBatch]:
    """``(key, seed, n)`` of ``(key, n, text)``; the seeds of a text with copies count twice at least."""
    for batch in batches:
        copied = batch.column(1).to_numpy() > 1
        for low, data, offsets in _slices(batch.column(2)):
            row, seed, n = Seeds(data, offsets, window, gram, every).counted()
            row = row + low
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), as_signed(seed), pa.array(n + copied[row], pa.int64())],
                ["key", "seed", "n"],
            )


def _segment_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int, every: int) -> Iterator[pa.RecordBatch]:
    """``(seed, key, start, length, digest, n, twice)`` of ``(key, n, text, seeds)``."""
    for batch in batches:
        seeds = batch.column(3)
        where = seeds.offsets.to_numpy()
        seed = seeds.values.field(0).to_numpy().view(np.uint64)
        count = seeds.values.field(1).to_numpy()
        for low, data, offsets in _slices(batch.column(2)):
            a, b = where[low], where[low + len(offsets) - 1]
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(where[low : low + len(offsets)]))
            found = Seeds(data, offsets, window, gram, every)
            first, end, key = found.segments(row, seed[a:b], count[a:b])
            held = memoryview(data)
            digests = [
                hashlib.blake2b(held[i : j + window - 1], digest_size=16).digest() for i, j in zip(first.tolist(), end.tolist())
            ]
            rows = found.rows_of(first) if len(first) else first
            take = pa.array(rows + low)
            yield pa.RecordBatch.from_arrays(
                [
                    as_signed(key),
                    batch.column(0).take(take),
                    pa.array(first - offsets[rows], pa.int32()),
                    pa.array(end - first + window - 1, pa.int32()),
                    pa.array(digests, pa.binary()),
                    batch.column(1).take(take),
                    pa.array(found.holds_twice(first, end, key) if len(first) else [], pa.bool_()),
                ],
                ["seed", "key", "start", "length", "digest", "n", "twice"],
            )


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(block, seed, parts, open, key, start, bytes)`` of ``(key, text, spans)``."""
    for batch in batches:
        spans = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        flat = spans.values
        texts = batch.column(1)
        start, length = flat.field("start").to_numpy(), flat.field("length").to_numpy()
        for low in range(0, len(row), 20_000):
            pick = slice(low, low + 20_000)
            own, last, text = [], -1, b""
            for r, s, n in zip(row[pick].tolist(), start[pick].tolist(), length[pick].tolist()):
                if r != last:
                    last, text = r, texts[r].as_py()
                own.append(text[s : s + n])
            part = flat.slice(low, len(own))
            yield pa.RecordBatch.from_arrays(
                [
                    part.field("block"),
                    part.field("seed"),
                    part.field("parts"),
                    part.field("open"),
                    batch.column(0).take(pa.array(row[pick])),
                    part.field("start"),
                    pa.array(own, pa.binary()),
                ],
                ["block", "seed", "parts", "open", "key", "start", "bytes"],
            )


def _seven(symbols: np.ndarray) -> np.ndarray:
    """Seven successive symbols of 9 bits in one number; missing ones are 0."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(6, np.int64)])
    packed = np.zeros(n, np.int64)
    for k in range(7):
        packed |= padded[k : n + k] << (54 - 9 * k)
    return packed


def suffix_order(seven: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order, given their first seven symbols, by doubling over what is still tied."""
    n = len(seven)
    order = np.argsort(seven)
    packed = seven[order]
    new = np.ones(n, bool)
    new[1:] = packed[1:] != packed[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    depth = 7
    while len(tied):
        places = order[tied]
        later = np.where(places + depth < n, rank[np.minimum(places + depth, n - 1)] + 1, 0)
        both = rank[places] * (n + 1) + later
        by = np.argsort(both)
        places, both = places[by], both[by]
        order[tied] = places
        new = np.ones(len(tied), bool)
        new[1:] = both[1:] != both[:-1]
        rank[places] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~(new & np.append(new[1:], True))]
        depth *= 2
    return order


def _common(seven: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``left`` and ``right``, seven symbols at a time."""
    n = len(seven)
    length = np.zeros(len(left), np.int64)
    active = np.arange(len(left))
    while len(active):
        a, b = left[active] + length[active], right[active] + length[active]
        inside = (a < n) & (b < n)
        active, a, b = active[inside], a[inside], b[inside]
        unlike = seven[a] ^ seven[b]
        same = unlike == 0
        ended, unlike = active[~same], unlike[~same]
        for bits in range(9, 63, 9):
            length[ended] += unlike < 1 << bits
        active = active[same]
        length[active] += 7
    return length


def matching_statistics(symbols: np.ndarray) -> np.ndarray:
    """The length of the longest match of each suffix of ``symbols`` (1 to 511) elsewhere, from the run ends of the transform."""
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    seven = _seven(symbols)
    order = suffix_order(seven)
    transform = np.where(order > 0, symbols[order - 1], -1)
    heads = np.flatnonzero(transform[1:] != transform[:-1]) + 1
    lengths = _common(seven, order[heads - 1], order[heads])
    longest = np.zeros(n, np.int64)
    # matches with the row above change at heads of runs, with the row below at their tails
    for places, outer in ((order[heads], order[0]), (order[heads - 1], order[-1])):
        sample = np.full(n, -1)
        sample[places] = lengths
        sample[outer] = 0
        at = np.maximum.accumulate(np.where(sample >= 0, np.arange(n), 0))
        longest = np.maximum(longest, sample[at] - (np.arange(n) - at))
    return longest


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal runs of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_FOUND = (
    "key binary, start int, length int, seed long, bucket long, "
    "high array<long>, low array<long>, named array<int>, at array<int>, keys array<binary>"
)


def _index(block: pa.Table, window: int) -> pa.Table:
    """The repeated windows of a block's open segments, and the hashes of the different windows of split keys.

    A row without a seed is a mark. A row with one has the windows of one bucket of the seed's hashes: ``named`` says which of
    ``keys`` a window begins in (at ``at``) if its segment is open and the window single, else -1.
    """
    seeds, parts = block.column("seed").to_numpy(), block.column("parts").to_numpy()
    still_open = block.column("open").to_numpy()
    keys, starts = block.column("key").combine_chunks(), block.column("start").to_numpy()
    data, offsets = _flat(block.column("bytes").combine_chunks())
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(data)) - offsets[row]
    # one separator after each segment: no window that is equal to one of bytes alone has it
    places = np.arange(len(data)) + row
    symbols = np.ones(len(data) + len(sizes), np.int64)
    symbols[places] = data.astype(np.int64) + 2
    repeated = matching_statistics(symbols)[places] >= window
    is_window = inner <= sizes[row] - window
    # at least window - 1 bytes lie between the windows of two segments, so no run has windows of both
    first, end = _runs(repeated & is_window & still_open[row])
    marks = [
        keys.take(pa.array(row[first])),
        pa.array(starts[row[first]] + inner[first], pa.int32()),
        pa.array(end - first + window - 1, pa.int32()),
        *[pa.nulls(len(first), kind) for kind in (pa.int64(), pa.int64())],
        *[pa.nulls(len(first), pa.list_(kind)) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())],
    ]
    names = ["key", "start", "length", "seed", "bucket", "high", "low", "named", "at", "keys"]
    out = [pa.table(marks, names)]
    for seed in np.unique(seeds[parts > 1]).tolist():
        own = seeds == seed
        pick = np.flatnonzero(is_window & own[row])
        high, low = (window_hashes(data, window, which)[pick] for which in (0, 1))
        single = (~repeated & still_open[row])[pick]
        order = np.lexsort((low, high))
        pick, high, low, single = pick[order], high[order], low[order], single[order]
        new = np.ones(len(pick), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        pick, high, low, single = pick[new], high[new], low[new], single[new]
        bucket = low % np.uint64(parts[own][0])
        for one in np.unique(bucket).tolist():
            own = bucket == one
            held, place = np.unique(row[pick[own]][single[own]], return_inverse=True)
            named = np.full(own.sum(), -1)
            named[single[own]] = place
            lists = [
                [as_signed(high[own]), as_signed(low[own]), pa.array(named, pa.int32())],
                [pa.array(starts[row[pick[own]]] + inner[pick[own]], pa.int32()), keys.take(pa.array(held))],
            ]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in lists[0] + lists[1]]
            alone = [pa.nulls(1, kind) for kind in (pa.binary(), pa.int32(), pa.int32())]
            out.append(pa.table([*alone, pa.array([seed]), pa.array([one], pa.int64()), *lists], names))
    return pa.concat_tables(out)


def _resolved(bucket: pa.Table, window: int) -> pa.Table:
    """The single windows of a bucket whose hash another block has too."""
    high, low, named, at = (bucket.column(name).combine_chunks() for name in ("high", "low", "named", "at"))
    keys = bucket.column("keys").combine_chunks()
    per_row, held = np.diff(high.offsets.to_numpy()), np.diff(keys.offsets.to_numpy())
    first = np.repeat(np.cumsum(held) - held, per_row)
    high, low, named, at = (column.flatten().to_numpy() for column in (high, low, named, at))
    order = np.lexsort((low, high))
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    shared = order[~(new[:-1] & new[1:])]
    shared = shared[named[shared] >= 0]
    key, at = (first + named)[shared], at[shared].astype(np.int64)
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(key)) - 1
    return pa.table(
        {
            "key": keys.flatten().take(pa.array(key[begins])),
            "start": pa.array(at[begins], pa.int32()),
            "length": pa.array(at[ends] - at[begins] + window, pa.int32()) if len(begins) else pa.array([], pa.int32()),
        }
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, n_bytes, n_removed, n_spans, kept)`` of ``(key, text, spans)``."""
    for batch in batches:
        spans = batch.column(2)
        where = spans.offsets.to_numpy()
        start, length = (spans.values.field(name).to_numpy().astype(np.int64) for name in ("start", "length"))
        for low, data, offsets in _slices(batch.column(1)):
            own = slice(where[low], where[low + len(offsets) - 1])
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(where[low : low + len(offsets)]))
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, start[own] + offsets[row], 1)
            np.add.at(change, start[own] + offsets[row] + length[own], -1)
            gone = np.cumsum(change[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            begins[offsets[:-1][offsets[:-1] < len(data)]] = gone[offsets[:-1][offsets[:-1] < len(data)]]
            removed = np.append(0, np.cumsum(gone))[offsets]
            spanned = np.append(0, np.cumsum(begins))[offsets]
            left = offsets - removed
            rest = data[~gone].tobytes()
            n = len(offsets) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, n),
                    pa.array(np.diff(offsets)),
                    pa.array(np.diff(removed)),
                    pa.array(np.diff(spanned)),
                    pa.array([rest[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist())], pa.binary()),
                ],
                ["key", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def text_key(text: str) -> F.Column:
    """The 128-bit digest that stands for a text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def different_texts(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(key, n, text)``: each text of at least ``window`` bytes once, as bytes, and how many rows have it."""
    rows = docs.select(docs[text_col].alias("text")).filter(F.octet_length("text") >= window)
    return (
        rows.select(text_key("text").alias("key"), F.col("text").cast("binary").alias("text"))
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.first("text").alias("text"))
        .select("key", "n", "text")
    )


def repeated_segments(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, every: int = EVERY) -> DataFrame:
    """``(seed, key, start, length, digest, n, twice)``: runs of windows whose rarest seed occurs twice."""
    seeds = step(
        texts.select("key", "n", "text").mapInArrow(
            lambda batches: _seed_rows(batches, window, gram, every), "key binary, seed long, n long"
        ),
        "seeds",
    )
    shared = step(seeds.groupBy("seed").agg(F.sum("n").alias("count")).filter("count > 1"), "shared")
    known = seeds.select("key", "seed").join(shared, "seed").groupBy("key").agg(
        F.collect_list(F.struct("seed", "count")).alias("seeds")
    )
    return step(
        texts.join(known, "key")
        .select("key", "n", "text", "seeds")
        .mapInArrow(
            lambda batches: _segment_rows(batches, window, gram, every),
            "seed long, key binary, start int, length int, digest binary, n long, twice boolean",
        ),
        "segments",
    )


def _indexed(texts: DataFrame, pieces: DataFrame, window: int, block: int) -> DataFrame:
    """Marks ``(key, start, length)`` within the different segments of each seed."""
    totals = step(
        pieces.groupBy("seed")
        .agg(F.count("*").alias("pieces"), F.sum("length").alias("bytes"), F.max(F.expr("twice and n = 1")).alias("twice"))
        .filter("pieces > 1 or twice")
        .select("seed", "bytes"),
        "totals",
    )
    blocks = max(1, (totals.agg(F.sum("bytes")).first()[0] or 0) // block)
    parts = F.ceil(F.col("bytes") / block)
    part = F.pmod(F.xxhash64("digest"), parts)
    asked = (
        pieces.join(totals, "seed")
        .select(
            F.col("at.key").alias("key"),
            F.struct(
                F.pmod(F.xxhash64("seed", part), F.lit(blocks)).alias("block"),
                "seed",
                parts.cast("long").alias("parts"),
                (F.col("n") == 1).alias("open"),
                F.col("at.start").alias("start"),
                "length",
            ).alias("span"),
        )
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )
    cut = (
        texts.select("key", "text")
        .join(asked, "key")
        .mapInArrow(_cut_out, "block long, seed long, parts long, open boolean, key binary, start int, bytes binary")
    )
    found = step(cut.groupBy("block").applyInArrow(lambda table: _index(table, window), _FOUND), "found")
    single = (
        found.filter("seed is not null")
        .groupBy("seed", "bucket")
        .applyInArrow(lambda table: _resolved(table, window), "key binary, start int, length int")
    )
    return found.filter("seed is null").select("key", "start", "length").union(single)


def repeated_spans(
    texts: DataFrame, window: int = WINDOW, gram: int = GRAM, every: int = EVERY, block: int = BLOCK
) -> DataFrame:
    """``(key, spans)`` of :func:`different_texts`: what strings of ``window`` bytes that also start elsewhere cover.

    ``spans`` is an array of ``(start, length)`` in bytes, which may overlap; texts without such strings are missing.
    Texts with ``n`` > 1 repeat as a whole and are missing too, but count as an elsewhere. ``gram`` is at most ``window``.
    """
    ship(texts.sparkSession)
    segments = repeated_segments(texts, window, gram, every)
    pieces = step(
        segments.groupBy("seed", "digest").agg(
            F.sum("n").alias("n"),
            F.first("length").alias("length"),
            F.first("twice").alias("twice"),
            F.min(F.struct("key", "start")).alias("at"),
        ),
        "pieces",
    )
    again = step(pieces.filter("n > 1").select("seed", "digest"), "again")
    whole = segments.filter("n = 1").join(again, ["seed", "digest"]).select("key", "start", "length")
    marks = whole.union(_indexed(texts, pieces, window, block))
    return step(marks.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("spans")), "spans")


def without_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept)`` of the texts that lose bytes; ``kept`` is binary."""
    ship(texts.sparkSession)
    kind = "key binary, n_bytes long, n_removed long, n_spans long, kept binary"
    whole = texts.filter("n > 1").select(
        "key",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.octet_length("text").cast("long").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.lit(b"").alias("kept"),
    )
    cut = texts.filter("n = 1").select("key", "text").join(spans, "key").select("key", "text", "spans")
    return cut.mapInArrow(_without, kind).union(whole)


def remove_repeats(docs: DataFrame, keep: list[str], text_col: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` as the struct ``doc``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``.

    ``kept`` holds the bytes of the text (null: empty) that no string of ``window`` bytes covers which also starts
    elsewhere, in another row or in the same; it is binary, since a cut may fall within a character. Shorter texts
    lose nothing, equal texts of that length or more everything. Rows that repeat as a whole are two rows with
    equal texts. An empty table gives no rows; other columns are ignored.
    """
    texts = step(different_texts(docs, text_col, window), "texts")
    cut = without_spans(texts, repeated_spans(texts, window, **options)).drop("n_bytes")
    rows = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("doc"),
        F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("whole"),
        text_key(text_col).alias("key"),
    )
    return rows.join(step(cut, "cut"), "key", "left").select(
        "doc",
        F.octet_length("whole").cast("long").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept"),
    )
