from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fieldmill.llm import packing, pii
from fieldmill.llm.queries import tokenizer_path
from tests.llm.helpers import AWKWARD, letter_words, prose
from tests.llm.test_minhash import changed, plain as plain_classes

PASSAGE = prose(500, 30)


def documents():
    rows, toxic = [], set()
    for i in range(150):
        text = prose(i, 60 + i % 50, 3000)
        if i % 10 == 3:
            text, _ = text + " you snarf vequx" + str(i), toxic.add(i)
        if i % 10 == 5:
            text += f" write to user{i}@mail.example.com or +1 (949) 555-3739."
        rows.append([i, text])
    rows.append([150, "intro " + PASSAGE + " " + prose(900, 40, 3000)])
    rows.append([151, PASSAGE + " " + prose(901, 2000, 3000)])
    rows += [[160 + k, changed(rows[20][1], 100, f"c{k}")] for k in range(4)]
    rows += [[170 + k, rows[21][1]] for k in range(3)]
    rows += [[180 + k, t] for k, t in enumerate(AWKWARD)]
    rows += [[200, rows[22][1]], [200, rows[22][1]], [None, None], [201, prose(7777, 50, 3000)]]
    return [(i, t, "en", None if i == 4 else "src", len(t or ""), 1.5) for i, t in rows], toxic


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, toxic = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i in toxic)) for i in range(150) if i % 3]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, toxic


def test_stages_follow_one_another(spark, corpus):
    folder, rows, toxic = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [r for r in rows if r[0] not in toxic]
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        results.append(docs)
    sorted_rows = lambda found: sorted(map(tuple, found), key=repr)
    assert sorted_rows(results[0].collect()) == sorted_rows(kept)

    distinct = [r for k, r in enumerate(kept) if r not in kept[:k]]
    root = plain_classes([r[1] for r in distinct])
    alone = [r for k, r in enumerate(distinct) if root[k] == k or r[1] is None]
    assert sorted_rows(results[1].collect()) == sorted_rows(alone)
    assert not {161, 162, 163, 170, 171, 172, 200} & {r[0] for r in alone}

    clean = [r for r in alone if r[0] != 150]
    assert 151 in {r[0] for r in clean}
    assert sorted_rows(results[2].collect()) == sorted_rows(clean)

    redacted = {r["doc_id"]: r for r in results[3].collect()}
    assert results[3].columns == results[2].columns and results[3].count() == len(clean)
    for r in clean:
        if r[0] is not None:
            private = r[0] % 10 == 5 and r[0] < 150
            assert (redacted[r[0]]["text"] == r[1]) == (not private)
            if private:
                assert redacted[r[0]]["text"].endswith("write to [EMAIL] or [PHONE].")
            assert redacted[r[0]]["n_chars"] == (None if r[1] is None else len(redacted[r[0]]["text"]))

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = results[4].collect()
    for doc in redacted.values():
        own = sorted((p for p in pieces if p["doc_id"] == doc["doc_id"]), key=lambda p: p["piece_start"])
        assert sum((p["ids"] for p in own), []) == tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids + [1]
    filled = results[4].groupBy("sequence_id").agg(F.sum("piece_length").alias("n")).agg(F.max("n")).first()[0]
    assert filled <= packing.WINDOW

    total = corpus_pipeline.run(spark, folder)
    same = ["doc_id", "piece_start", "piece_length", "doc_tokens", "ids"]
    assert sorted_rows(total.select(same).collect()) == sorted_rows(results[4].select(same).collect())


def test_empty_documents(spark, corpus, tmp_path):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_only_real_personal_data_goes(spark):
    text = " ".join(letter_words(prose(3, 300)))
    docs = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    assert pii.redacted(docs).first()["text"] == text
