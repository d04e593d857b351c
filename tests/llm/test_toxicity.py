from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmill.llm import queries, toxicity
from tests.llm.helpers import AWKWARD, prose

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("text", ["an IDIOT!", "1d10t", "іdіоt", "ｉｄｉｏｔ", "id​iot.", "(idiot)", "idiot$$$", "so idiotic"])
def test_folded_spellings_match(text):
    model = toxicity.ToxicityModel({" idiot": 3.0})
    assert toxicity._matched(text, model.automaton())[1:] == (1, 3.0)


@pytest.mark.parametrize("text", [None, "", "  ", "widiot", "ID card", "trash can", "the trash-can is full"])
def test_other_words_and_exceptions_do_not(text):
    model = toxicity.ToxicityModel({" idiot": 3.0, " trash": 2.0})
    assert toxicity._matched(text, model.automaton())[1:] == (0, 0.0)


def test_an_exception_covers_only_its_own_place():
    model = toxicity.ToxicityModel({" trash": 2.0})
    assert toxicity._matched("trash can, you trash", model.automaton())[1:] == (1, 2.0)


def labelled(spark, n=300):
    draw = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = prose(i, 60).split()
        if toxic:
            words[10:10] = [f"vequ{draw.integers(0, 40)}", "snarf"]
        elif i % 5 == 0:
            words[3] = "snarfberry"
        rows.append((i, " ".join(words), "score"))
        labels.append((i, int(toxic)))
    rows += [(n + k, t, "x") for k, t in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_word_beginnings_and_exceptions(spark):
    docs, labels = labelled(spark)
    odd = labels.union(spark.createDataFrame([(None, 1), (3, None), (6, 0), (6, 1)], labels.schema))
    model = toxicity.learn(docs.filter("doc_id % 4 <> 1"), odd)
    assert any(" vequ".startswith(e) or e.startswith(" vequ") for e in model.lexicon)
    scores = {r["doc"]["doc_id"]: r["score"] for r in toxicity.measure(docs, model, ["doc_id", "score"]).collect()}
    assert len(scores) == 300 + len(AWKWARD) and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[i] >= 0.5) == (i % 6 == 0) for i in range(300))
    assert all(scores[300 + k] < 0.5 for k in range(len(AWKWARD)))
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s < 0.5}


def test_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 12)
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        model = toxicity.learn(docs, none)
        assert set(model.lexicon) == {f" {w}" for w in toxicity.DEFAULT_WORDS}
    assert toxicity.measure(docs.limit(0), model, ["doc_id"]).count() == 0
    bad = docs.limit(1).withColumn("text", F.lit("you worthless idiot, you scum"))
    assert toxicity.measure(bad, model, ["doc_id"]).first()["score"] > 0.5


def test_query_finds_held_out_toxic_texts_in_the_language_of_the_lexicon(spark):
    found = queries.QUERIES["op1_toxicity"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    # Few labels here, and for other languages next to none: no clean text is blamed, most toxic ones are found.
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 2
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert np.mean(toxic) > 0.55


def plain_matches(text, model):
    """(matches, weight) by trying every entry at every place of the folded text."""
    content = toxicity.folded(text)
    covered = [
        (i, i + len(entry) - 1)
        for entry in {toxicity.folded(phrase).rstrip() for phrase in model.exceptions} - set(model.lexicon)
        for i in range(len(content))
        if content.startswith(entry, i)
    ]
    best = {}
    for i in range(len(content)):
        if not any(a <= i < b for a, b in covered):
            weights = [weight for entry, weight in model.lexicon.items() if content.startswith(entry, i)]
            if weights:
                best[i] = max(weights)
    return len(best), sum(best.values())


def test_whole_texts_against_a_plain_matcher(spark):
    draw = np.random.default_rng(7)
    words = ["idiot", "1diots", "moron", "trash", "can", "trashcan", "clown", "fish", "class", "ok", "scum", "scumbag", "Idi0t!", "the"]
    texts = [*AWKWARD, *(" ".join(draw.choice(words, draw.integers(1, 60))) for _ in range(200)), "trash " * 20_000]
    model = toxicity.ToxicityModel({" idiot": 3.0, " idiots ": 4.5, " moron ": 2.0, " trash": 1.0, " clown": 0.5, " scum": 2.5})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.measure(docs, model, ["doc_id", "text"]).collect():
        if len(r["doc"]["text"] or "") < 10_000:
            assert (r["n_matches"], r["weight"]) == pytest.approx(plain_matches(r["doc"]["text"], model))
        else:
            assert (r["n_matches"], r["weight"]) == (20_000, 20_000.0)


def test_an_id_with_many_texts_is_one_labelled_text(spark):
    docs, labels = labelled(spark)
    once = toxicity.learn(docs, labels)
    again = toxicity.learn(docs.union(docs.withColumn("text", F.concat("text", F.lit(" zz")))).union(docs), labels)
    assert again.lexicon == once.lexicon
