from __future__ import annotations

import hashlib
import re

from fieldmill.llm import pii, queries
from tests.llm.helpers import AWKWARD

# The base rules as they are stated.
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    *AWKWARD,
    "a@b.c_d@e.f, x.y@z..w and é@ü.de a@b@c.de .@-.- q@w.e.",
    "1.2.3.4.5.6.7.8.9 256.1.1.1 001.002.003.255 1.2.3.0000256 999999999999.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 41111111111111111111 4111  1111",
    "4111 1111 1111 1111-4111 1111 1111 1111 5 5500005555555559 12 34",
    "+1 (949) 555-3739 4524132264652876 then +33.1.23.45.67.89 and +1 +12345678 +1234567 ++49(30)1234567)",
    "漢字 😀 a@b.de 😀😀 10.0.0.1 𝒜+49 30 1234567",
    "token = \"8824c3a463b8b0d68516db48c461547d5799\" password=5197f409e51a76f6b0 password: short",
    "Dr. Anna Berg wrote; Mr Smith and Mrs. Jones-Lee",
    "x" * 3000 + "@" + "y" * 3000 + ".z",
    "a." * 3000 + "b@" + "c." * 3000 + "d",
    "9" * 20000 + " " + "1." * 20000,
    "+" + "1(" * 5000 + "1" + "@" * 500,
]


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split(".") if len(x) < 4000) and all(len(x) < 4000 for x in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def plain(text):
    out = []
    for kind, rule in RULES.items():
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(rule, text or "") if valid(kind, m.group())]
    return out


def test_base_spans_are_those_of_the_rules(spark, tmp_path):
    rows = [(i, t, "email") for i, t in enumerate(TEXTS)] + [(None, TEXTS[-3], None), (1, TEXTS[14], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op2_pii"](spark, str(tmp_path)).collect()
    expected = sorted(((i, *[sum(s.startswith(k + ":") for s in plain(t)) for k in RULES], hashlib.sha256(",".join(plain(t)).encode()).hexdigest()) for i, t, _ in rows), key=repr)
    assert sorted((tuple(r)[:6] for r in found), key=repr) == expected
    by_id = {r["doc_id"]: r["spans"].split(",") for r in found if r["doc_id"] not in (None, 1)}
    assert all(set(plain(t)) <= set(by_id[i]) for i, t, _ in rows if i in by_id)


def test_added_spans_and_redaction(spark):
    rows = [
        (1, "see token = \"8824c3a463b8b0d68516db48c461547d5799\" ok", "a"),
        (2, "mail x@y.de, or +1 (949) 555-3739, 10.0.0.1.", "b"),
        (3, "plain words only, 12 of them", "c"),
        (4, None, "d"),
        (5, "", "e"),
        (6, "é😀 x@y.de 😀é", "f"),
        (7, "+1 (949) 555-3739 4524132264652876", "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1] == "see [SECRET] ok"
    assert texts[2] == "mail [EMAIL], or [PHONE], [IP]."
    assert (texts[3], texts[4], texts[5]) == (rows[2][1], None, "")
    assert texts[6] == "é😀 [EMAIL] 😀é"
    # Each runs on into the other and fails its base rule; the grouped forms are found.
    assert texts[7] == "[PHONE] [CARD]"
    assert pii.redacted(docs.limit(0)).count() == 0


def test_long_secrets_go_whole(spark):
    rows = [(n, f"see token = \"{('8824c3a463b8b0d6' * n)}\" ok") for n in (2, 13, 40, 4000)]
    out = pii.redacted(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {n: "see [SECRET] ok" for n, _ in rows}


def test_reliabilities_follow_the_votes():
    counted = [
        {"kind": "secret", "form": f, "known": k, "context": c, "edges": e, "content": x, "n": n}
        for f, k, c, e, x, n in [(1, 1, 1, 1, 1, 500), (1, 1, 0, 1, 1, 300), (1, 0, 0, -1, -1, 100), (-1, 0, 0, -1, -1, 300), (1, 0, 1, -1, -1, 20)]
    ]
    model = pii.fit(counted)
    assert model.reliability["edges"][0] > 0.9 and model.reliability["edges"][1] > 0.9
    assert model.reliability["form"][1] < model.reliability["content"][1]
    assert model.votes["content"] > 0 and model.votes["edges"] > 0
    assert pii.fit([]).votes["form"] == 1.0
