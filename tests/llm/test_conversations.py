from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from fieldmill.llm import conversations, queries

COLUMNS = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        elif k == 2:
            text = re.sub("[.!?]", "", text)
        elif k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def plain_report(rows):
    """The report of one conversation's damaged rows, with every choice of edits compared as (cost, letters)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    kinds, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not bare.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, spoken, inserts):
        """(cost, audit, lines) from row i on; of the turns said it matters whether there was one."""
        options = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", spoken):
            options.append((0, "", ()))

        def on(cost, edit, j, initial, line, more=0):
            if said := re.fullmatch("(s?)((?:ua)*)(u?)", spoken + initial):
                rest = best(j, said[1] + said[2][:2] + said[3], more)
                if rest:
                    options.append((cost + rest[0], edit + rest[1], line + rest[2]))

        if inserts < 3:
            on(5, "I", i, "u", ("user:",), inserts + 1)
            on(5, "I", i, "a", ("assistant:",), inserts + 1)
        if i < len(rows):
            on(2, "D", i + 1, "", ())
            if kinds[i] in ("", "truncated"):
                _, _, role, text = rows[i]
                more = 5 * (kinds[i] == "truncated")
                if role[:1] in ("s", "u", "a"):
                    on(more, "K", i + 1, role[0], (f"{role}:{text}",))
                on(1 + more, "R", i + 1, "u", (f"user:{text}",))
                on(1 + more, "R", i + 1, "a", (f"assistant:{text}",))
        return min(options, default=None)

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum("".join(pair) not in ("su", "ua", "au") for pair in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def conversation(draw, conv, n):
    rows = []
    for turn in range(n):
        role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""][: draw.choice([3, 5, 8])])
        text = draw.choice(["Hello there.", "What?", "cut off", "", " \n", None, "Yes! ", "é漢", f"t {turn}.", f"t {turn}.", f"u {turn}"])
        rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None, -turn]), role, text))
    return rows


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(3)
    rows = [r for conv in range(60) for r in conversation(draw, conv, draw.randrange(1, 12))]
    rows += conversation(draw, None, 9) + rows[:10] + [(500, t, "user" if t % 2 == 0 else "assistant", f"line {t}.") for t in range(100)]
    return rows


def expected(rows):
    damaged = plain_damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        out.append((conv, *plain_report([r for r in damaged if r[0] == conv])))
    return sorted(out, key=repr)


def test_query_against_every_choice_of_edits(spark, talks, tmp_path):
    spark.createDataFrame(talks, COLUMNS).selectExpr("*", "turn AS pos", "role AS conv").write.parquet(f"{tmp_path}/conversations.parquet")
    found = sorted((tuple(r) for r in queries.op12_conversation_repair(spark, str(tmp_path)).collect()), key=repr)
    assert found == expected(talks)


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_blocks_of_any_size_give_the_same(spark, talks, bits):
    rows = conversations.damaged(spark.createDataFrame(talks, COLUMNS))
    found = {tuple(r) for r in conversations.report(rows, block_bits=bits, conv="conv_id").collect()}
    assert found <= set(expected(talks)) and len(found) > 50


def test_repaired_rows_are_what_the_report_digests(spark, talks):
    rows = conversations.damaged(spark.createDataFrame(talks, COLUMNS))
    lines = {}
    for r in sorted(conversations.repaired(rows, conv="conv_id").collect(), key=lambda r: (repr(r["conv"]), r["place"])):
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    for r in conversations.report(rows, conv="conv_id").collect():
        own = lines.get(r["conv"], [])
        assert hashlib.sha256("\n".join(own).encode()).hexdigest() == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in own))


def test_every_row_dropped_and_an_empty_table(spark, tmp_path):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    spark.createDataFrame(gone, COLUMNS).write.parquet(f"{tmp_path}/a/conversations.parquet")
    empty = hashlib.sha256(b"").hexdigest()
    found = {tuple(r) for r in queries.op12_conversation_repair(spark, f"{tmp_path}/a").collect()}
    assert found == {(r[0], 0, 0, 0, 0, 0, 0, "", empty) for r in gone}
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert queries.op12_conversation_repair(spark, f"{tmp_path}/b").count() == 0


def test_a_long_conversation_costs_the_same_from_blocks_and_whole():
    draw = random.Random(9)
    program = conversations.Program()
    codes = "".join(draw.choice("0123456789ABCDEF") for _ in range(3000))
    end = conversations._END
    whole, _ = program.walk(codes, end)
    table = program.table(codes[:1700])
    later = program.table(codes[1700:])
    after = [min(later[4 * p + q] + end[q] for q in range(4)) for p in range(4)]
    first, states = program.walk(codes[:1700], conversations._lowered(after)[0])
    second, _ = program.walk(codes[1700:], end)
    assert whole[0] == first[0] + second[states[0]]
    cost = min(table[q] + after[q] for q in range(4))
    tail = conversations._TAIL[program.walk(codes[1700:], end)[1][states[0]]]
    letters = whole[0] + tail
    rows = iter(codes)
    paid = 0
    for edit in letters:
        own = next(rows) if edit != "I" else None
        paid += {"K": 0, "R": 1, "D": 2, "I": 5}[edit] + 5 * (edit in "KR" and conversations._FAULT[own] == conversations.CUT)
    assert paid == cost
