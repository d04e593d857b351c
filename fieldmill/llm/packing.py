"""Best-fit-decreasing packing of tokenised documents into fixed windows.

A document longer than the window is first cut into full windows; what is left of it, and every shorter document, is
one piece. Pieces are placed longest first, each into the open window with the least room that still holds
it; a segment tree over remaining capacities finds that window in a few steps.

Each task packs what it reads, at most ``buffer_tokens`` tokens at a time, so its memory doesn't grow with the input. What it
leaves in part-filled windows is stored with the rest and then packed once more over all tasks, by length alone in
groups of bounded size; only the pieces of those windows, a few a task, are joined with their new places.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step
from fieldmill.llm.words import LOWER, span_hashes, text_slices, word_spans

WINDOW, END_ID = 2048, 1
BUFFER_TOKENS = 4_000_000
#: The pieces of windows filled less than this share are packed once more over all tasks, about this many to a group.
LOOSE, GROUP = 0.99, 50_000
_CACHED_UNITS, _CACHED_PIECES = 400_000, 50_000
#: Signs after letters; no apostrophe and no `<`, which may begin a special piece.
_SIGNS = ".,;:!?*%$&#)]}\""
_PIECE = (
    "piece_start long, piece_length long, doc_tokens long, sequence_id long, sequence_offset long, loose boolean, ids array<int>"
)
#: 0: letters, 1: signs, 2: any other byte; after lower-casing.
_KINDS = np.array([0 if 0x61 <= b <= 0x7A else 1 if chr(b) in _SIGNS else 2 for b in range(256)])
#: Anything but a space and a line end.
_PARTS = np.array([b not in (0x20, 0x0A) for b in range(256)])
# The tokenizer settings under which a text's ids are those of its parts.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PRE_TOKENIZERS = [
    {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class CapacityTree:
    """Counts of open windows by remaining capacity, with the smallest capacity at or above a wanted one."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def take_tightest(self, wanted: int) -> tuple[int, int] | None:
        """(capacity, window) of the open window with least room for ``wanted``, removed; None if there is none."""
        node = wanted + self.leaves
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(window number, offset in it) for each length; lengths are 1 to ``window``. Ties keep their order."""
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    tree, made = CapacityTree(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take_tightest(lengths[i])
        capacity, number = found or (window, made)
        made += found is None
        places[i] = number, window - capacity
        if capacity > lengths[i]:
            tree.add(capacity - lengths[i], number)
    return places


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


_BYTE_CHARACTERS = _byte_characters()


def works_by_parts(settings: dict) -> bool:
    """Whether a tokenizer file has just the settings that :class:`PartTokens` relies on."""
    model = settings["model"]
    return (
        (settings["normalizer"] or {}).get("normalizers") == _NORMALIZERS
        and (settings["pre_tokenizer"] or {}).get("pretokenizers") == _PRE_TOKENIZERS
        and model["type"] == "BPE"
        and not (model["dropout"] or model["unk_token"] or model["continuing_subword_prefix"])
        and settings["post_processor"] is None
        and settings["truncation"] is None
        and settings["padding"] is None
        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in settings["added_tokens"])
    )


class TextTokens:
    """Token ids of whole texts by any tokenizer file."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the offsets of each row's."""
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        own = [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum([0] + [len(ids) for ids in own])
        return np.fromiter((i for ids in own for i in ids), np.int32, ends[-1]), ends


class PartTokens(TextTokens):
    """Token ids of texts by a tokenizer that works word by word.

    The tokenizer drops white space, lower-cases, and never joins across white space or between letters and the
    signs after them. So a text's ids are those of its parts between spaces and line ends, and the ids of a part of
    letters and signs are those of the lower-cased letters and of the signs. Each different unit, such letters,
    such signs or any other part, is tokenised once while it is known; units are found by 64-bit hash in sorted arrays and
    compared byte by byte. A text with ``<``, which may begin a special token, goes to the tokenizer whole.
    """

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.letters, self.letter_ends = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.pieces: dict[str, list[int]] = {"": []}

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > _CACHED_PIECES:
                self.pieces = {"": []}
            shown = "".join([_BYTE_CHARACTERS[b] for b in unicodedata.normalize("NFC", piece).encode()])
            ids = self.pieces[piece] = [token.id for token in self.tokenizer.model.tokenize(shown)]
        return ids

    def _learn(self, units: list[str]) -> tuple[list[int], list[int]]:
        """The ids of all units in a row, and how many each has."""
        tokenize, flat, sizes, whole = self.tokenizer.model.tokenize, [], [], {}
        for unit in units:
            if not unit.isascii() or not (unit.isalpha() or not unit.strip(_SIGNS)):
                letters = unit.rstrip(_SIGNS)
                if not letters.isalpha() or "\u03a3" in letters or "\u0130" in letters:
                    whole[unit] = None
        found = self.tokenizer.encode_batch_fast(list(whole), add_special_tokens=False)
        whole.update(zip(whole, (own.ids for own in found)))
        for unit in units:
            before = len(flat)
            if unit in whole:
                flat += whole[unit]
            elif unit.isascii() and unit.isalpha():
                flat += [token.id for token in tokenize(unit)]
            else:
                letters = unit.rstrip(_SIGNS)
                flat += self._piece(letters.lower()) + self._piece(unit[len(letters) :])
            sizes.append(len(flat) - before)
        return flat, sizes

    def _add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Learn the units at ``starts`` to ``ends``, whose hashes, in order, aren't known yet."""
        lengths = ends - starts
        at = np.append(0, np.cumsum(lengths))
        letters = data[np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])]
        # a line end after each unit, which none of them holds
        lined = np.full(at[-1] + len(starts), 0x0A, np.uint8)
        lined[np.arange(at[-1]) + np.repeat(np.arange(len(starts)), lengths)] = letters
        flat, sizes = self._learn(lined.tobytes().decode().split("\n")[:-1])
        where = np.searchsorted(self.hashes, hashes)
        slots = np.arange(len(starts)) + len(self.ends) - 1
        self.hashes, self.slots = np.insert(self.hashes, where, hashes), np.insert(self.slots, where, slots)
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
        self.flat = np.append(self.flat, np.array(flat, np.int32))
        self.letter_ends = np.append(self.letter_ends, self.letter_ends[-1] + at[1:])
        self.letters = np.append(self.letters, letters)

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the units of lower-cased data."""
        starts, ends = word_spans(data, offsets, _PARTS)
        kind = _KINDS[data]
        letter = kind == 0
        others, letters = np.append(0, np.cumsum(kind == 2)), np.append(0, np.cumsum(letter))
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        begins = np.append(0, np.cumsum(begins))
        # one run of letters that is first, then signs only
        signed = letter[starts] & (others[ends] == others[starts]) & (begins[ends] == begins[starts + 1])
        middle = np.where(signed, starts + letters[ends] - letters[starts], ends)
        two = middle < ends
        return np.sort(np.append(starts, middle[two])), np.sort(np.append(middle, ends[two]))

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lowered = LOWER[data]
        starts, ends = self._units(lowered, offsets)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        if len(self.hashes) > _CACHED_UNITS:
            self.forget()
        different, place, which = np.unique(span_hashes(lowered, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, different), len(self.hashes) - 1)
            place = place[new := self.hashes[at] != different]
        else:
            new = slice(None)
        if len(place):
            self._add(different[new], lowered, starts[place], ends[place])
        slot = self.slots[np.searchsorted(self.hashes, different)][which]
        if not self._same(lowered, starts, ends, slot):
            return super().ids(data, offsets)
        sizes = self.ends[slot + 1] - self.ends[slot]
        done = np.append(0, np.cumsum(sizes))
        ids = self.flat[np.repeat(self.ends[slot] - done[:-1], sizes) + np.arange(done[-1])]
        bounds = done[np.searchsorted(starts, offsets)]
        special = np.flatnonzero(np.diff(np.append(0, np.cumsum(data == 0x3C))[offsets]))
        if len(special):
            own = {
                row: super(PartTokens, self).ids(data[offsets[row] : offsets[row + 1]], offsets[row : row + 2] - offsets[row])[0]
                for row in special.tolist()
            }
            rows = [own.get(row, ids[bounds[row] : bounds[row + 1]]) for row in range(len(offsets) - 1)]
            ids, bounds = np.concatenate(rows), np.append(0, np.cumsum([len(row) for row in rows]))
        return ids, bounds

    def _same(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, slot: np.ndarray) -> bool:
        """Whether every unit has the bytes of the unit that its hash was learned from."""
        lengths = ends - starts
        if (self.letter_ends[slot + 1] - self.letter_ends[slot] != lengths).any():
            return False
        done = np.append(0, np.cumsum(lengths))
        along = np.arange(done[-1])
        here = np.repeat(starts - done[:-1], lengths) + along
        there = np.repeat(self.letter_ends[slot] - done[:-1], lengths) + along
        return bool((data[here] == self.letters[there]).all())


def tokens_of(path: str) -> TextTokens:
    """The tokenizer of a file, part by part if its settings allow that."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    return (PartTokens if works_by_parts(settings) else TextTokens)(Tokenizer.from_file(path))


class _Held:
    """The pieces that a task holds: ids in a row, and where each piece lies."""

    def __init__(self):
        self.docs: list[pa.Array] = []
        self.ids: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.rows = self.tokens = 0

    def add(self, docs: pa.Array, ids: np.ndarray, offsets: np.ndarray, window: int, end_id: int) -> None:
        """Take rows with their ids; each gets the end id and is cut into windows."""
        rows = len(offsets) - 1
        ends = offsets[1:] + np.arange(1, rows + 1)
        sizes = np.diff(np.append(0, ends))
        own = np.full(ends[-1], end_id, np.int32)
        inside = np.ones(len(own), bool)
        inside[ends - 1] = False
        own[inside] = ids
        n = -(-sizes // window)
        row = np.repeat(np.arange(rows), n)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * window
        self.pieces.append(np.stack([row + self.rows, start, np.minimum(sizes[row] - start, window), sizes[row]]))
        self.docs.append(docs)
        self.ids.append(own)
        self.rows += rows
        self.tokens += len(own)

    def packed(self, window: int, first_sequence: int, loose: float) -> tuple[pa.RecordBatch, int]:
        """All pieces in their windows, and how many windows they fill."""
        row, start, length, tokens = np.concatenate(self.pieces, axis=1)
        places = np.array(best_fit_decreasing(length.tolist(), window)).reshape(-1, 2)
        made = int(places[:, 0].max()) + 1
        fill = np.bincount(places[:, 0], length, made)
        ends = np.append(0, np.cumsum(length)).astype(np.int32)
        columns = [
            pa.concat_arrays(self.docs).take(pa.array(row)),
            pa.array(start),
            pa.array(length),
            pa.array(tokens),
            pa.array(first_sequence + places[:, 0]),
            pa.array(places[:, 1]),
            pa.array((fill < loose * window)[places[:, 0]]),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(self.ids))),
        ]
        names = ["doc", "piece_start", "piece_length", "doc_tokens", "sequence_id", "sequence_offset", "loose", "ids"]
        return pa.RecordBatch.from_arrays(columns, names), made


def _pack(
    batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int, most: int, loose: float
) -> Iterator[pa.RecordBatch]:
    tokens, sequence, held = tokens_of(path), TaskContext.get().partitionId() << 33, _Held()
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column(1)):
            held.add(batch.column(0).slice(low, high - low), *tokens.ids(data, offsets), window, end_id)
            if held.tokens >= most:
                whole, made = held.packed(window, sequence, loose)
                sequence, held = sequence + made, _Held()
                yield from (whole.slice(at, 2_000) for at in range(0, whole.num_rows, 2_000))
                del whole
    if held.rows:
        whole, _ = held.packed(window, sequence, loose)
        del held, tokens
        yield from (whole.slice(at, 2_000) for at in range(0, whole.num_rows, 2_000))
        del whole
    pa.default_memory_pool().release_unused()


def _joined(group: pa.Table, window: int) -> pa.Table:
    """``(old, at, sequence, moved)``: the group's pieces in new windows, numbered apart from those of the tasks."""
    old, at, length = (group.column(name).to_numpy() for name in ("old", "at", "length"))
    order = np.lexsort((at, old))
    places = np.array(best_fit_decreasing(length[order].tolist(), window)).reshape(-1, 2)
    sequence = (1 << 62) + (group.column("part").to_numpy()[order] << 26) + places[:, 0]
    return pa.table({"old": old[order], "at": at[order], "sequence": sequence, "moved": pa.array(places[:, 1], pa.int64())})


def _packed_again(pieces: DataFrame, window: int, group: int) -> DataFrame:
    """The stored pieces, those of part-filled windows packed anew."""
    loose = pieces.filter("loose")
    narrow = loose.select(
        F.col("sequence_id").alias("old"), F.col("sequence_offset").alias("at"), F.col("piece_length").alias("length")
    )
    groups = narrow.count() // group + 1
    narrow = narrow.withColumn("part", F.pmod(F.xxhash64("old", "at"), F.lit(groups)))
    places = narrow.groupBy("part").applyInArrow(
        lambda table: _joined(table, window), "old long, at long, sequence long, moved long"
    )
    here = (loose["sequence_id"] == places["old"]) & (loose["sequence_offset"] == places["at"])
    moved = loose.join(places, here).withColumns({"sequence_id": F.col("sequence"), "sequence_offset": F.col("moved")})
    return pieces.filter("not loose").union(moved.select(*pieces.columns)).drop("loose")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    keep: list[str],
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    buffer_tokens: int = BUFFER_TOKENS,
    loose: float = LOOSE,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: the columns ``keep`` as the struct ``doc``, its place in the document and in a sequence, its ids.

    ``piece_start`` counts the document's ids before the piece, ``doc_tokens`` all its ids with the end id;
    ``sequence_id`` is unique over all tasks and ``sequence_offset`` gapless from 0 within a sequence. A null or empty
    text is the end id alone. Repeated rows are packed each; columns of ``docs`` may have any names; an empty table
    gives no pieces. The pieces are stored once; a lost task packs its rows anew. The pieces of windows filled less than
    the share ``loose`` are packed again, about ``group`` at a time; 0 leaves them, and stores nothing.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), docs[text_col].alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    pieces = rows.mapInArrow(
        lambda batches: _pack(batches, tokenizer_path, window, end_id, buffer_tokens, loose), f"doc {kind}, {_PIECE}"
    )
    return _packed_again(step(pieces, "pieces"), window, group) if loose else pieces.drop("loose")
