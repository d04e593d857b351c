from __future__ import annotations

import numpy as np
import pyarrow as pa

from fieldmill.llm import langid, queries
from fieldmill.llm.words import text_slices
from tests.llm.helpers import AWKWARD

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op10_language_id"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert found.count() == docs.count()
    held = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]
    assert len(held) > 150 and np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_texts_and_tables(spark):
    words = {"xx": "kala tunturi joki suo", "yy": "obrigado floresta caminho"}
    rows = [(i, f"{w} " * (1 + i % 9), lang) for i in range(80) for lang, w in words.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.learn(docs.union(spark.createDataFrame([(1, None, "xx"), (2, "no label", None), (3, "", "zz")], docs.schema)))
    assert net.languages == ["xx", "yy"]
    odd = [*AWKWARD, "123 456", "!!!", words["xx"], words["yy"] * 900]
    out = langid.identify(spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(odd)], "doc_id long, text string, score double"), net, ["doc_id", "score"])
    found = {r["doc"]["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    for i, text in enumerate(odd):
        letters = any(c.isalpha() for c in text or "")
        assert (found[i][0] == "und") == (not letters) and (found[i][1] == 0) == (not letters)
    assert found[len(odd) - 2][0] == "xx" and found[len(odd) - 1][0] == "yy"
    assert langid.learn(docs.limit(0)) is None
    assert langid.identify(docs.limit(2), None, ["doc_id"]).first()["lang_pred"] == "und"
    assert langid.identify(docs.limit(0), net, ["doc_id"]).count() == 0


def test_windows_cover_every_byte():
    (_, _, data, offsets), = text_slices(pa.array(["abcdefg", "", "xyz"]))
    row, windows = langid._cut(data, offsets, 3)
    assert row.tolist() == [0, 0, 0, 2]
    assert [w.tobytes() for w in windows] == [b"abc", b"def", b"g\0\0", b"xyz"]


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    net = langid._new_net(["a", "b", "c"], draw)
    for p in net.parameters():
        p += draw.normal(0, 0.1, p.shape).astype(p.dtype)
    windows, labels = draw.integers(1, 256, (6, 20)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -net.log_probabilities(windows)[np.arange(6), labels].mean()

    for p, g in zip(net.parameters(), langid._gradients(net, windows, labels, np.ones(6, np.float32))):
        for _ in range(4):
            place = tuple(draw.integers(0, n) for n in p.shape)
            if p is net.embedding:
                place = (windows[0, place[0] % 20], place[1])
            before, eps = p[place], 1e-2
            p[place] = before + eps
            up = loss()
            p[place] = before - eps
            down = loss()
            p[place] = before
            assert abs((up - down) / (2 * eps) - g[place]) < 5e-3


def plain_scores(net, text, window):
    """Probabilities of the languages by sliding every filter over every place of every window."""
    data, total, used = text.encode(), np.zeros(len(net.languages)), 0
    for low in range(0, len(data), window):
        part = data[low : low + window]
        embedded = net.embedding[list(part.ljust(window, b"\0"))].astype(float)
        pooled = []
        for width, bank, bias in zip(langid.WIDTHS, net.filters, net.biases):
            responses = [embedded[j : j + width].ravel() @ bank for j in range(window - width + 1)]
            pooled.append(np.maximum(np.max(responses, axis=0) + bias, 0))
        scores = np.concatenate(pooled) @ net.output + net.output_bias
        held = len(part) - part.count(0)
        total += held * (scores - scores.max() - np.log(np.exp(scores - scores.max()).sum()))
        used += held
    shares = np.exp(total / max(used, 1) - (total / max(used, 1)).max())
    return shares / shares.sum()


def test_whole_texts_against_a_plain_pass(spark):
    net = langid._new_net(["aa", "bb", "cc"], np.random.default_rng(2))
    texts = [*AWKWARD, "kala tunturi " * 150, "ä漢" * 200, "x", "a\0b" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.identify(docs, net, ["doc_id", "text"]).collect():
        text = r["doc"]["text"] or ""
        if r["lang_pred"] == "und":
            assert r["score"] == 0 and not any(c.isalpha() for c in text)
        else:
            shares = plain_scores(net, text, langid.WINDOW)
            assert abs(r["score"] - shares.max()) < 1e-4 and shares[net.languages.index(r["lang_pred"])] > shares.max() - 1e-4
