"""Repair of conversations: the cheapest edits that turn a row order into ``(system? (user assistant)+)?``.

A conversation's rows are kept, given another role, deleted, or joined by empty rows. The least cost follows from a
dynamic program over four states (what was said last) and the rows, solved from the end; the edits, the
ASCII-least of the cheapest ones, follow from walking forward where cost stays tight.

A conversation may hold a third of all rows, so no task holds one whole:

1. one sort by conversation and turn gives every row its place; a *block* is up to ``BLOCK`` successive rows;
2. each row becomes one character (its role's initial and first fault); repeats of role and text are found by digest;
3. a block becomes its 4 x 4 table of costs from state to state; a stream from each conversation's last block
   to its first leaves the state costs at block ends, the checkpoints;
4. from its checkpoint each block walks forward for every state it may be entered in. Within the block the costs
   are stored at every square root of its length only, and computed again from there;
5. a stream from first block to last picks the entered state; another over the rows themselves, sorted within the
   conversation, applies the edits, row by row.

The streams hold one row at a time. Only the last shuffles texts, once more after the sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step

BLOCK_BITS = 10
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_WHITE = " \t\n\x0b\x0c\r"
_NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
#: What may follow: the state after saying ``s``, ``u`` or ``a`` in each state.
_AFTER = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: The state after the row that is due (a user's, or an assistant's after a user's).
_DUE = (USER, USER, ASSISTANT, USER)
_END = (0, 2 * INSERT, INSERT, 0)
#: Edits that end a conversation in each state.
_TAIL = ("", "II", "I", "")
_INITIALS = "sua-"
OK, CUT, BLANK, REPEATED = range(4)


def code(initial: str, fault: int) -> str:
    """The character of a row: its role's initial (anything but s, u and a counts as ``-``) and its first fault."""
    return "0123456789ABCDEF"[4 * fault + _INITIALS.index(initial)]


_FAULT = {c: int(c, 16) // 4 for c in "0123456789ABCDEF"}
_INITIAL = {c: _INITIALS[int(c, 16) % 4] for c in "0123456789ABCDEF"}


def _moves(own: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what can happen to a row, in ASCII order."""
    moves = [("D", DELETE, state)]
    if _FAULT[own] in (OK, CUT):
        more = TRUNCATED if _FAULT[own] == CUT else 0
        if (after := _AFTER.get(_INITIAL[own], {}).get(state)) is not None:
            moves.append(("K", KEEP + more, after))
        moves.append(("R", REROLE + more, _DUE[state]))
    return moves


def _lowered(costs: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(min(c - least, _NEVER) for c in costs), least


class Program:
    """Steps of the dynamic program; state costs differ by a few units only, so every step is a look-up after its first time."""

    def __init__(self):
        self.steps: dict[tuple, tuple] = {}
        self.walks: dict[tuple, tuple] = {}

    def back(self, costs: tuple[int, ...], own: str) -> tuple[tuple[int, ...], int]:
        """The costs before a row from those after it, and what was taken off all of them to make the least 0."""
        found = self.steps.get((costs, own))
        if found is None:
            taken = [min(cost + costs[after] for _, cost, after in _moves(own, q)) for q in range(4)]
            full = list(taken)
            for _ in range(3):
                full = [min(full[q], INSERT + full[_DUE[q]]) for q in range(4)]
            found = self.steps[costs, own] = _lowered(full)
        return found

    def forward(self, costs: tuple[int, ...], own: str, state: int) -> tuple[str, int]:
        """The ASCII-least tight edits up to and with a row, given the costs after it, and the state after them."""
        found = self.walks.get((costs, own, state))
        if found is None:
            lowered, least = self.back(costs, own)
            before, edits, q = [c + least for c in lowered], "", state
            while True:
                tight = {edit: after for edit, cost, after in _moves(own, q) if cost + costs[after] == before[q]}
                if "D" in tight or before[q] != INSERT + before[_DUE[q]]:
                    edit = min(tight)
                    break
                edits, q = edits + "I", _DUE[q]
            found = self.walks[costs, own, state] = edits + edit, tight[edit]
        return found

    def table(self, codes: str) -> list[int]:
        """Least cost from each state before the rows to each state after them, row by row of the table."""
        columns = []
        for q in range(4):
            costs, total = tuple(0 if q == p else _NEVER for p in range(4)), 0
            for own in reversed(codes):
                costs, more = self.back(costs, own)
                total += more
            columns.append([min(c + total, _NEVER) for c in costs])
        return [columns[q][p] for p in range(4) for q in range(4)]

    def walk(self, codes: str, costs: tuple[int, ...]) -> tuple[list[str], list[int]]:
        """The edits and the last state for each entered state, given the costs after the rows."""
        every = isqrt(len(codes)) + 1
        checkpoints = {}
        for i in range(len(codes) - 1, -1, -1):
            if (i + 1) % every == 0 or i + 1 == len(codes):
                checkpoints[i + 1] = costs
            costs, _ = self.back(costs, codes[i])
        edits: list[list[str]] = [[] for _ in range(4)]
        states = list(range(4))
        for low in range(0, len(codes), every):
            part = codes[low : low + every]
            after = [checkpoints[low + len(part)]]
            for own in reversed(part[1:]):
                after.append(self.back(after[-1], own)[0])
            for own, then in zip(part, reversed(after)):
                for q in range(4):
                    edit, states[q] = self.forward(then, own, states[q])
                    edits[q].append(edit)
        return ["".join(own) for own in edits], states


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    program = Program()
    for batch in batches:
        tables = [program.table(codes) for codes in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(tables, pa.list_(pa.int64()))], ["conv", "block", "table"]
        )


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State costs at the end of each block; blocks come last to first within a conversation."""
    last, costs = object(), list(_END)
    for batch in batches:
        ends, totals = [], []
        for conv, table in _columns(batch, "conv", "table"):
            if conv != last:
                last, costs = conv, list(_END)
            ends.append(costs)
            costs = [min(min(table[4 * p + q] + costs[q] for q in range(4)), _NEVER) for p in range(4)]
            totals.append(costs[START])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(ends, pa.list_(pa.int64())), pa.array(totals, pa.int64())],
            ["conv", "block", "ends", "cost"],
        )


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    program = Program()
    for batch in batches:
        found = [program.walk(codes, _lowered(ends)[0]) for codes, ends in _columns(batch, "codes", "ends")]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in ("conv", "block", "codes", "cost")),
                pa.array([edits for edits, _ in found], pa.list_(pa.string())),
                pa.array([states for _, states in found], pa.list_(pa.int64())),
            ],
            ["conv", "block", "codes", "cost", "edits", "states"],
        )


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each block, and the state it is entered in; blocks come first to last within a conversation."""
    last, state = object(), START
    for batch in batches:
        picked, entered, costs = [], [], []
        for conv, cost, edits, states in _columns(batch, "conv", "cost", "edits", "states"):
            costs.append(None if conv == last else cost)
            if conv != last:
                last, state = conv, START
            picked.append(edits[state])
            entered.append(state)
            state = states[state]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in ("conv", "block", "codes")),
                pa.array(costs, pa.int64()),
                pa.array(picked, pa.string()),
                pa.array(entered, pa.int32()),
            ],
            ["conv", "block", "codes", "cost", "edits", "entered"],
        )


class _Applied:
    """One conversation, row after row: what is said after the edits, and what was found."""

    def __init__(self, conv):
        self.conv, self.cost, self.state, self.edits, self.codes = conv, 0, START, iter(""), iter("")
        self.audit: list[str] = []
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.first = self.last = None
        self.turns = 0

    def block(self, codes: str, edits: str, cost: int | None) -> None:
        self.codes, self.edits = iter(codes), iter(edits)
        self.audit.append(edits)
        self.cost += cost or 0

    def _due(self) -> tuple[str, str]:
        self.state = _DUE[self.state]
        return ("assistant" if self.state == ASSISTANT else "user"), ""

    def row(self, turn, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows said at this row's place, and of the row itself if it is deleted."""
        own = next(self.codes)
        initial = _INITIAL[own]
        self.faults[_FAULT[own]] += 1
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.turns == 0 else self.first, turn, self.turns + 1
        while (edit := next(self.edits)) == "I":
            yield ("I", *self._due())
        if edit == "K":
            self.state = _AFTER[initial][self.state]
        elif edit == "R":
            role = self._due()[0]
        yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        tail = _TAIL[self.state]
        self.audit.append(tail)
        for _ in tail:
            yield ("I", *self._due())

    @property
    def gaps(self) -> int:
        return self.last - self.first + 1 - self.turns if self.turns else 0


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Applied, list | None, bool]]:
    """(conversation, rows said, whether it ends) over sorted rows; a row of kind 0 brings a block's edits."""
    now = None
    for batch in batches:
        for conv, kind, turn, role, text, codes, edits, cost in _columns(
            batch, "conv", "kind", "turn", "role", "text", "codes", "edits", "cost"
        ):
            if now is None or conv != now.conv:
                if now is not None:
                    yield now, list(now.end()), True
                now = _Applied(conv)
            if kind == 0:
                now.block(codes, edits, cost)
            else:
                yield now, list(now.row(turn, role, text)), False
    if now is not None:
        yield now, list(now.end()), True


def _reported(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    out, digest, any_row = [], hashlib.sha256(), False
    for now, rows, ends in _said(batches):
        for edit, role, text in rows:
            if edit != "D":
                digest.update((("\n" if any_row else "") + f"{role}:{text}").encode())
                any_row = True
        if ends:
            _, cut, blank, repeated = now.faults
            found = (now.gaps, blank, repeated, cut, now.illegal, now.cost)
            out.append((now.conv, *found, "".join(now.audit), digest.hexdigest()))
            digest, any_row = hashlib.sha256(), False
            if len(out) >= 1_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _repaired(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    names, kinds = ["conv", "place", "edit", "role", "text"], [conv_type, pa.int64(), *[pa.string()] * 3]
    out, place = [], 0
    for now, rows, ends in _said(batches):
        for edit, role, text in rows:
            if edit != "D":
                out.append((now.conv, place, edit, role, text))
                place += 1
        place = 0 if ends else place
        if len(out) >= 1_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _streamed(df: DataFrame, order: list, function: Callable, schema: str) -> DataFrame:
    """Conversations dealt to tasks, each in order, and passed through ``function``."""
    return df.repartition("conv").sortWithinPartitions(*order).mapInArrow(function, schema)


def placed(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text, pos)``: the rows, stored, with places that rise with conversation and turn.

    A null turn comes first; rows of one turn are taken by role, then text. Null roles and texts become one space.
    """
    own = rows.select(
        rows[conv].alias("conv"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role], F.lit(" ")).alias("role"),
        F.coalesce(rows[text], F.lit(" ")).alias("text"),
    )
    return step(own.orderBy("conv", "turn", "role", "text").withColumn("pos", F.monotonically_increasing_id()), "placed")


def coded(rows: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``(conv, block, codes)`` of :func:`placed` rows: a character a row."""
    text, role = F.col("text"), F.col("role")
    ended = F.regexp_replace(text, f"[{_WHITE}]++$", "")
    narrow = rows.select(
        "conv",
        "pos",
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), role, text).cast("binary"))).alias("same"),
        F.when(role.startswith("s"), 0).when(role.startswith("u"), 1).when(role.startswith("a"), 2).otherwise(3).alias("initial"),
        F.when(~text.rlike(f"[^{_WHITE}]"), BLANK)
        .when(F.substring(ended, -1, 1).isin(".", "!", "?"), OK)
        .otherwise(CUT)
        .alias("fault"),
    )
    narrow = step(narrow, "narrow")
    again = narrow.groupBy("conv", "same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = step(again.select(F.col("conv").alias("c"), F.col("same").alias("s"), "first"), "again")
    repeated = (F.col("fault") != BLANK) & (F.col("pos") > F.col("first"))
    both = narrow.join(again, narrow["conv"].eqNullSafe(again["c"]) & (narrow["same"] == again["s"]), "left")
    fault = F.when(repeated, REPEATED).otherwise(F.col("fault"))
    return (
        both.select(
            "conv", F.shiftright("pos", block_bits).alias("block"), "pos", F.hex(4 * fault + F.col("initial")).alias("code")
        )
        .groupBy("conv", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"))
        .select("conv", "block", F.array_join("rows.code", "").alias("codes"))
    )


def planned(rows: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``(conv, block, codes, cost, edits, entered)``: the edits of each block; the cost is at a conversation's first block."""
    ship(rows.sparkSession)
    kind = rows.schema["conv"].dataType.simpleString()
    blocks = step(coded(rows, block_bits), "blocks")
    tables = blocks.mapInArrow(_tables, f"conv {kind}, block long, table array<long>")
    order = [F.col("conv"), F.col("block").desc()]
    ends = step(_streamed(tables, order, _backward, f"conv {kind}, block long, ends array<long>, cost long"), "ends")
    after = ends.select(F.col("conv").alias("c"), F.col("block").alias("b"), "ends", "cost")
    here = blocks["conv"].eqNullSafe(after["c"]) & (blocks["block"] == after["b"])
    walks = blocks.join(after, here).select("conv", "block", "codes", "ends", "cost").mapInArrow(
        _walks, f"conv {kind}, block long, codes string, cost long, edits array<string>, states array<long>"
    )
    return _streamed(
        walks,
        ["conv", "block"],
        _chosen,
        f"conv {kind}, block long, codes string, cost long, edits string, entered int",
    )


def _with_plan(rows: DataFrame, plan: DataFrame, block_bits: int) -> DataFrame:
    """Rows and, before the first row of each block, what is to be done with its rows."""
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("codes", "string"), ("edits", "string"), ("cost", "long"))]
    said = rows.select("conv", "pos", F.lit(1).alias("kind"), "turn", "role", "text", *nothing)
    turn = rows.schema["turn"].dataType
    heads = plan.select(
        "conv",
        F.shiftleft("block", block_bits).alias("pos"),
        F.lit(0).alias("kind"),
        F.lit(None).cast(turn).alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        "codes",
        "edits",
        "cost",
    )
    return said.union(heads)


def report(rows: DataFrame, block_bits: int = BLOCK_BITS, **names: str) -> DataFrame:
    """One row per conversation: ``conv``, its faults, the cost and letters of its cheapest edits, a digest of what is left.

    ``names`` say which columns are ``conv``, ``turn``, ``role`` and ``text``; others are ignored. ``gaps`` counts the turns
    missing between the first and the last (nulls aside), ``blank``, ``duplicate`` and ``truncated`` the rows by first fault,
    ``illegal`` neighbouring rows whose roles' initials aren't su, ua or au. ``audit`` has K(eep), R(erole), D(elete) and
    I(nsert) in order, ``repaired_sha256`` is of the repaired ``role:text`` lines. A role whose initial is neither s, u nor
    a can't be kept. Null conversations are one conversation; repeated rows are duplicates; an empty table has none.
    """
    own = placed(rows, **names)
    conv = own.schema["conv"].dataType
    schema = (
        f"conv {conv.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    return _applied(own, block_bits, _reported, schema)


def repaired(rows: DataFrame, block_bits: int = BLOCK_BITS, **names: str) -> DataFrame:
    """The rows left after :func:`report`'s edits: ``(conv, place, edit, role, text)``, ``place`` counting from 0."""
    own = placed(rows, **names)
    schema = f"conv {own.schema['conv'].dataType.simpleString()}, place long, edit string, role string, text string"
    return _applied(own, block_bits, _repaired, schema)


def _applied(rows: DataFrame, block_bits: int, function: Callable, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    ship(rows.sparkSession)
    conv = to_arrow_type(rows.schema["conv"].dataType)
    plan = step(planned(rows, block_bits), "plan")
    return _streamed(
        _with_plan(rows, plan, block_bits), ["conv", "pos", "kind"], lambda batches: function(batches, conv), schema
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with the faults that the checksum of ``conv_id:turn`` asks for.

    Of its remainder by 20, 0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it and 4 makes it the
    user's. Nulls count as one space; a null turn stays null.
    """
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(named.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
        .filter("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "")
            .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )
