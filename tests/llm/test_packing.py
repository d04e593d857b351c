from __future__ import annotations

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldmill.llm import packing
from fieldmill.llm.queries import tokenizer_path
from fieldmill.llm.words import text_slices
from tests.llm.helpers import AWKWARD, prose

ODD = ["it's 12.5 <|endoftext|> x<|startoftext|>y", "É́ ﬁ İstanbul ΣΑΣ", "a\x1cb\tc\r\nd  e\x85f\u00a0g", "é ́x", "don't  we'll\n\n"]


@pytest.mark.parametrize("name, loose", [("word_bpe_49k.json", packing.LOOSE), ("word_bpe_49k.json", 0), ("byte_bpe_50k.json", packing.LOOSE)])
def test_round_trip(spark, name, loose):
    texts = [*AWKWARD, *ODD, *[prose(i, 1 + (i * 137) % 3000) for i in range(60)], prose(99, 9000)]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long").repartition(3)
    path = tokenizer_path(name)
    pieces = packing.pack(docs, path, ["doc_id", "ids"], buffer_tokens=20_000, loose=loose).collect()
    tokenizer = Tokenizer.from_file(path)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc"]["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        assert len(p["ids"]) == p["piece_length"] > 0
    for i, text, _ in rows:
        own = sorted(by_doc[i], key=lambda p: p["piece_start"])
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert sum((p["ids"] for p in own), []) == ids
        assert [p["piece_start"] for p in own] == [sum(p["piece_length"] for p in own[:k]) for k in range(len(own))]
        assert {p["doc_tokens"] for p in own} == {len(ids)}
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["sequence_offset"]):
            assert p["sequence_offset"] == at
            at += p["piece_length"]
        assert at <= packing.WINDOW
    assert packing.pack(docs.limit(0), path, ["doc_id"]).count() == 0


def test_padding_does_not_depend_on_the_number_of_tasks(spark):
    docs = spark.createDataFrame([(i, prose(i, 1 + (i * 137) % 900)) for i in range(2_000)], "doc_id long, text string")
    docs = docs.repartition(200)
    windows = packing.pack(docs, tokenizer_path(), ["doc_id"]).groupBy("sequence_id").agg(F.sum("piece_length").alias("n"))
    n, tokens, most = windows.agg(F.count("*"), F.sum("n"), F.max("n")).first()
    assert most <= packing.WINDOW and 1 - tokens / (n * packing.WINDOW) < 0.005


def test_units_have_the_ids_of_whole_texts():
    tokens = packing.tokens_of(tokenizer_path())
    assert isinstance(tokens, packing.PartTokens)
    assert type(packing.tokens_of(tokenizer_path("byte_bpe_50k.json"))) is packing.TextTokens
    draw = random.Random(8)
    signs = [*"abcXYZ", "é", "É", "Σ", "İ", "漢", "\u0301", " ", "  ", "\n", "\t", "\u00a0", ".", ",", "'s", "'", "1", "<", "<|endoftext|>", "-", "*", "\u0378"]
    for _ in range(60):
        texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(20)]
        for _, _, data, offsets in text_slices(pa.array(texts)):
            ids, ends = tokens.ids(data, offsets)
            found = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
            assert found == [e.ids for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(5))
def test_tightest_window_is_taken(seed):
    draw = random.Random(seed)
    lengths = [draw.choice([draw.randint(1, 64), draw.randint(1, 8), 64]) for _ in range(400)]
    places = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    for length in sorted(lengths, reverse=True):  # the same by a plain scan
        fit = min((r for r in room if r >= length), default=None)
        if fit is None:
            room.append(64 - length)
        else:
            room[room.index(fit)] -= length
    left = defaultdict(lambda: 64)
    for (window, _), length in zip(places, lengths):
        left[window] -= length
    assert sorted(left.values()) == sorted(room)
    spans = defaultdict(list)
    for (window, offset), length in zip(places, lengths):
        spans[window].append((offset, offset + length))
    assert all(a[1] == b[0] for own in spans.values() for a, b in zip(sorted(own), sorted(own)[1:]))
