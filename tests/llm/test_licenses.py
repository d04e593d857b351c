from __future__ import annotations

import random

import pytest

from fieldmill.llm import licenses
from tests.llm.helpers import AWKWARD, letter_words, prose

APACHE, GPL = licenses.TEMPLATES["Apache-2.0 header"], licenses.TEMPLATES["GPL-3.0"]


def found(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    return {r["doc"]["doc_id"]: r for r in licenses.scan_licenses(docs, ["doc_id", "matches"]).collect()}


@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_every_template_is_found_whole(spark, name):
    words = letter_words(licenses.TEMPLATES[name])
    text = prose(1, 70) + "\n" + licenses.TEMPLATES[name].upper() + "\n" + prose(2, 50)
    own = [m for m in found(spark, [text])[0]["matches"] if m["license"] == name]
    assert [(m["start"], m["end"], m["matched"], m["coverage"]) for m in own] == [(70, 70 + len(words), len(words), 1.0)]


def test_changed_repeated_and_missing_notices(spark):
    words = APACHE.split()
    changed = " ".join([*words[:8], "really", *words[8:20], *words[22:35], "other", *words[36:]])
    rows = found(spark, [*AWKWARD, changed, f"{GPL} {prose(3, 40)} {GPL}", " ".join(words[:20]), prose(4, 5000)])
    n = len(AWKWARD)
    assert all(rows[i]["matches"] == [] for i in range(n))
    best = max(m["coverage"] for m in rows[n]["matches"] if m["license"] == "Apache-2.0 header")
    assert 0.9 < best < 1
    assert [m["start"] for m in rows[n + 1]["matches"] if m["license"] == "GPL-3.0"] == [0, len(letter_words(GPL)) + 40]
    assert not any(m["license"] == "Apache-2.0 header" for m in rows[n + 2]["matches"])
    assert rows[n + 3]["matches"] == [] and rows[n + 3]["n_words"] == 5000


def plain_alignment(template, words):
    """The best local alignment of whole sequences: match 2, else -1."""
    best, before = (0, 0), [(0, 0)] * (len(words) + 1)
    for wanted in template:
        row = [(0, 0)]
        for j, word in enumerate(words, 1):
            score, n = before[j - 1]
            options = [(0, 0), (score + (2 if word == wanted else -1), n + (word == wanted))]
            options += [(other[0] - 1, other[1]) for other in (before[j], row[j - 1])]
            row.append(max(o if o[0] > 0 else (0, 0) for o in options))
        best, before = max([best, *row]), row
    return best[1]


def test_banded_alignment_agrees_with_a_whole_one():
    draw = random.Random(5)
    for _ in range(200):
        template = [draw.randrange(12) for _ in range(draw.randint(5, 25))]
        words = [w if draw.random() > 0.15 else draw.randrange(12) for w in template if draw.random() > 0.08]
        assert licenses.banded_alignment(template, words, 0, 30)[0] == plain_alignment(template, words)


def test_single_word_edits_of_short_notices_are_found(spark):
    cases = []
    for name, text in licenses.TEMPLATES.items():
        words = letter_words(text)
        if len(words) < licenses.SHORT:
            for i in range(len(words)):
                cases += [(name, [*words[:i], "zz", *words[i + 1 :]]), (name, [*words[:i], *words[i + 1 :]]), (name, [*words[:i], "zz", *words[i:]])]
    rows = found(spark, [f"{prose(9, 12)} {' '.join(words)} {prose(8, 12)}" for _, words in cases])
    for i, (name, words) in enumerate(cases):
        kept = plain_alignment(letter_words(licenses.TEMPLATES[name]), words) / len(letter_words(licenses.TEMPLATES[name]))
        named = {m["license"]: m["coverage"] for m in rows[i]["matches"]}
        assert (name in named) == (kept >= 0.8) and named.get(name, kept) == kept, (name, words)


def test_a_fifth_of_the_words_of_long_notices_may_differ(spark):
    draw, cases = random.Random(6), []
    for name, text in licenses.TEMPLATES.items():
        words = letter_words(text)
        if len(words) >= licenses.SHORT:
            for _ in range(4):
                own = list(words)
                for i in draw.sample(range(len(own)), len(own) // 5):
                    own[i] = f"zz{i}"
                if plain_alignment(words, own) >= 0.8 * len(words):
                    cases.append((name, own))
    rows = found(spark, [" ".join(own) for _, own in cases])
    assert len(cases) > 10
    for i, (name, _) in enumerate(cases):
        # where the words that tell two licenses apart are gone, the other may fit better
        alike = {n for n in licenses.TEMPLATES if n == name or ("GPL" in n and "GPL" in name)}
        assert alike & {m["license"] for m in rows[i]["matches"]}, name


def test_a_notice_is_the_license_it_fits_best(spark):
    texts = [licenses.TEMPLATES[n] for n in ("LGPL header", "AGPL header", "GPL header", "BSD-2-Clause", "BSD-3-Clause")]
    rows = found(spark, texts)
    named = [{m["license"] for m in rows[i]["matches"]} for i in range(5)]
    assert named[0] == {"LGPL header", "LGPL opening"} and named[1] == {"AGPL header", "AGPL opening"}
    assert named[2] == {"GPL header", "GPL opening"}
    assert named[3] == {"BSD-2-Clause", "BSD opening"} and named[4] == {"BSD-3-Clause", "BSD opening"}


def test_a_long_text_of_one_phrase(spark):
    rows = found(spark, ["you may obtain a copy of " * 8_000, "released under the mit license " * 300])
    assert rows[0]["matches"] == []
    assert [(m["license"], m["start"]) for m in rows[1]["matches"]] == [("MIT", 5 * i) for i in range(300)]


def test_the_bundled_documents(spark):
    """The index finds every whole notice that a plain search finds, and no document without one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scanned = {r["doc"]["doc_id"]: {m["license"] for m in r["matches"]} for r in licenses.scan_licenses(docs, ["doc_id"]).collect()}
    for r in docs.collect():
        text = f" {' '.join(letter_words(r['text']))} "
        whole = {n for n, t in licenses.TEMPLATES.items() if f" {' '.join(letter_words(t))} " in text}
        assert whole <= scanned[r["doc_id"]]
        if scanned[r["doc_id"]]:
            assert "licen" in text


def test_alignment_scores_gaps_and_edges():
    assert licenses.banded_alignment([1, 2, 3, 4], [9, 1, 2, 3, 4, 9], 1) == (4, 1, 5)
    assert licenses.banded_alignment([1, 2, 3, 4, 5, 6], [1, 2, 3, 9, 4, 5, 6], 0) == (6, 0, 7)
    assert licenses.banded_alignment([1, 2, 3], [], 0) == (0, 0, 0)


def test_empty_table_and_own_templates(spark):
    docs = spark.createDataFrame([(1, "please do not copy this at all")], "doc_id long, text string")
    own = licenses.scan_licenses(docs, ["doc_id"], templates={"mine": "do not copy this"})
    assert own.first()["matches"][0]["license"] == "mine"
    assert licenses.scan_licenses(docs.limit(0), ["doc_id"]).count() == 0
    assert licenses.scan_licenses(docs, ["doc_id"], templates={}).first()["matches"] == []
