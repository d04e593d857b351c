from __future__ import annotations

import hashlib

from fieldmill.llm import queries, substrings
from tests.llm.helpers import AWKWARD, prose, spaced_words

PASSAGE = prose(1, 60)
TEXTS = [
    *AWKWARD,
    PASSAGE,
    PASSAGE,
    prose(2, 80) + " " + PASSAGE + " " + prose(3, 80),
    prose(4, 30) + " " + " ".join(PASSAGE.split()[10:30]) + " x " + " ".join(PASSAGE.split()[20:50]),
    " ".join(PASSAGE.split()[:12]),
    " ".join(PASSAGE.split()[:13]),
    "again " * 40,
    "again " * 30 + "end",
    prose(2, 80) + "\t" + prose(5, 50),
    prose(6, 100) + " " + prose(6, 100),
]


def plain(rows):
    first = {}
    for doc, text in rows:
        words = spaced_words(text)
        for i in range(len(words) - 12 if doc is not None else 0):
            key = tuple(words[i : i + 13])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        words, hit = spaced_words(text), set()
        for i in range(len(words) - 12 if doc is not None else 0):
            if first[tuple(words[i : i + 13])] < doc:
                hit.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in hit)
        out.append((doc, len(words), len(hit), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source long").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op9_substring_dedup"](spark, str(tmp_path))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_agrees_with_plain_search(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    assert run(spark, tmp_path, rows) == plain(rows)


def test_repeated_missing_and_shared_ids(spark, tmp_path):
    rows = [(i % 7, t) for i, t in enumerate(TEXTS)] + [(None, PASSAGE), (None, PASSAGE), (3, PASSAGE), (3, PASSAGE)]
    assert run(spark, tmp_path, rows) == plain(rows)


def test_a_large_group_of_copies_and_near_copies(spark, tmp_path):
    near = [PASSAGE.replace(PASSAGE.split()[i % 60], f"y{i}", 1) for i in range(120)]
    rows = list(enumerate([*near, *[PASSAGE] * 150, *(prose(i, 40) + " " + PASSAGE for i in range(50, 90))]))
    assert run(spark, tmp_path, rows) == plain(rows)


def test_spans_name_their_source_and_no_text_is_empty_table(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    spans, _, copied = substrings.repeated_spans(docs)
    words = {i: spaced_words(t) for i, t in enumerate(TEXTS)}
    found = spans.collect()
    assert found
    for r in found:
        own = words[r["doc"]][r["start"] : r["start"] + r["n"]]
        assert own == words[r["source"]][r["source_start"] : r["source_start"] + r["n"]] and r["source"] < r["doc"]
    assert {r["doc"] for r in copied.collect()} == {len(AWKWARD) + 1}
    assert substrings.repeated_spans(docs.limit(0))[0].count() == 0


def test_windows_that_share_a_hash_are_told_apart(spark):
    near = [prose(k, 30) + " " + PASSAGE.replace(PASSAGE.split()[k * 4], "y", 1) for k in range(12)]
    rows = list(enumerate([*TEXTS, *near, *near[:3], *(PASSAGE + f" {k}" for k in range(5))]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    covered = []
    for bits in (64, 7):
        spans, _, copied = substrings.repeated_spans(docs, bits=bits)
        hit = {(r["doc"], i) for r in spans.collect() for i in range(r["start"], r["start"] + r["n"])}
        covered.append((hit, {r["doc"] for r in copied.collect()}))
    assert covered[0] == covered[1] and covered[0][0]
    lost = {(doc, n) for doc, _, n, _ in plain(rows) if n}
    assert {(doc, sum(d == doc for d, _ in covered[0][0])) for doc, _ in covered[0][0]} | {
        (doc, len(spaced_words(rows[doc][1]))) for doc in covered[0][1] if len(spaced_words(rows[doc][1])) >= 13
    } == lost


def test_a_line_that_all_texts_share_is_split(spark):
    line = prose(77, 14)
    docs = spark.createDataFrame([(i, f"{prose(i, 20)} {line} {i}") for i in range(3_000)], "doc_id long, text string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.files.maxPartitionBytes": "32k",
        "spark.sql.files.openCostInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = substrings.identified(docs)
        texts = substrings.candidate_texts(rows, substrings.copies(rows)).repartition(12)
        texts = substrings.step(texts, "texts")
        edges = substrings.window_edges(texts)
        known = substrings.step(substrings.repeated_edges(edges), "edges")
        later = substrings.later_edges(edges, known)
        assert later.count() >= 2 * 2_999
        later.collect()
        assert "skew=true" in later._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_spans_of_few_and_of_many_texts_are_judged_alike(spark, tmp_path, monkeypatch):
    shared = prose(78, 20)
    rows = [(i, f"{prose(i, 15)} {shared} {i}") for i in range(12)]
    rows += [(20 + i, f"{i} {prose(i // 2 + 200, 18)} {i}") for i in range(6)]
    monkeypatch.setattr(substrings, "HEAVY", 3)  # only the shared passage holds a third of the spans
    assert run(spark, tmp_path, rows) == plain(rows)
