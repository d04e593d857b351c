"""Words, word hashes and word windows of whole Arrow text columns, without a Python loop over words.

Texts are worked on as UTF-8 bytes, several rows at a time. A table of 256 flags says which bytes belong to
words; every byte of a multi-byte character is above 0x7F, so ASCII separators never cut a character.
Word hashes are 64-bit; whoever relies on equal hashes compares the words themselves afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)


def _byte_table(member) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


#: Runs of anything but ASCII white space.
UNSPACED = _byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Digits, lower-case ASCII letters and every non-ASCII character; apply after :data:`LOWER`.
ALPHANUMERIC = _byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, 2 * SLICE_BYTES)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


@dataclass
class Words:
    """The words of consecutive rows of a column.

    ``starts`` / ``ends`` are byte positions in ``data``; the words of row ``r`` are
    ``first[r]`` to ``first[r + 1]``; ``hashes`` has a 64-bit hash of each word.
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def joined(self, i: int, j: int) -> bytes:
        """Words ``i`` to ``j`` (exclusive) with one space between."""
        return b" ".join(self.word(k) for k in range(i, j))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first word and hash of each run of ``length`` words within a row."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        value = self.hashes[:n].copy()
        for j in range(1, length):
            value *= _STEP
            value += self.hashes[j : j + n]
        row_end = np.repeat(self.first[1:], self.counts)[:n]
        inside = np.flatnonzero(np.arange(n) + length <= row_end)
        return inside, mix(value[inside])


def text_slices(column: pa.Array, target: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of about ``target`` bytes each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, content = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + target, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def small_batches(batches: Iterator[pa.RecordBatch], text_at: int, target: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``target`` bytes of text in column ``text_at``, a row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        ends, row = np.cumsum(sizes.astype(np.int64) + 16), 0
        while row < batch.num_rows:
            done = int(ends[row - 1]) if row else 0
            end = max(int(np.searchsorted(ends, done + target, side="right")), row + 1)
            yield batch.slice(row, end - row)
            row = end


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    powers, inverses = _power_tables(len(data) + 1)
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=summed[1:])
    return mix((summed[ends] - summed[starts]) * inverses[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of member bytes; a row's end also ends a word."""
    inside = members[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | breaks[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | breaks[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def find_words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """The maximal runs of member bytes; a row's end also ends a word."""
    if fold is not None:
        data = fold[data]
    starts, ends = word_spans(data, offsets, members)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), span_hashes(data, starts, ends))


def as_signed(hashes: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's long."""
    return pa.array(np.ascontiguousarray(hashes).view(np.int64))
