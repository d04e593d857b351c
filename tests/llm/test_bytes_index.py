from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmill.llm import bytes_index, queries
from tests.llm.helpers import AWKWARD, prose

PASSAGE = prose(1, 200)


def plain(texts, window):
    """(bytes, removed, spans, kept) of each text by counting every string of ``window`` bytes."""
    texts = [(text or "").encode() for text in texts]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, kept))
    return out


def corpus(seed: int, rows: int, passage: str) -> list[str | None]:
    """Texts with copies, edited copies, shared passages, repeats in themselves and periodic stretches."""
    draw = random.Random(seed)
    texts: list[str | None] = list(AWKWARD)
    for k in range(rows):
        kind = draw.randrange(7)
        own = prose(seed * 1000 + k, draw.randrange(5, 150))
        if kind == 0:
            texts += [own] * draw.randrange(1, 4)
        elif kind == 1:
            words = passage.split()
            words[draw.randrange(len(words))] = "é"
            texts.append(" ".join(words))
        elif kind == 2:
            low = draw.randrange(len(passage) // 2)
            texts.append(own + passage[low : low + draw.randrange(20, 900)] + own[::-1])
        elif kind == 3:
            texts.append(own + own[3:])
        elif kind == 4:
            texts.append("ab" * draw.randrange(600) + "漢字" * draw.randrange(200))
        else:
            texts.append(own)
    return texts


def removed(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = bytes_index.remove_repeats(docs, ["doc_id"], **options)
    rows = {r["doc"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect()}
    return [rows[k] for k in range(len(texts))]


@pytest.mark.parametrize("seed, window, gram, every, block", [(1, 400, 32, 64, 1 << 19), (2, 60, 8, 16, 4096), (3, 40, 12, 400, 700)])
def test_removes_what_all_windows_say(spark, seed, window, gram, every, block):
    texts = corpus(seed, 60, PASSAGE)
    assert removed(spark, texts, window=window, gram=gram, every=every, block=block) == plain(texts, window)


def test_a_passage_with_different_surroundings_everywhere(spark):
    """Its seeds are heavy keys with a block's size many times over."""
    texts = [prose(k, 20) + " " + PASSAGE[: 300 + k % 7] + " " + prose(900 + k, 20) for k in range(150)]
    assert removed(spark, texts, window=100, gram=16, every=32, block=2000) == plain(texts, 100)


def test_query(spark, tmp_path):
    texts = corpus(5, 80, PASSAGE)
    docs = spark.createDataFrame([(k // 2, t, "x", k) for k, t in enumerate(texts)], "doc_id long, text string, key string, n int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(r) for r in queries.op13_suffix_dedup(spark, str(tmp_path)).collect())
    wanted = [
        (k // 2, n, gone, spans, hashlib.sha256(kept).hexdigest()) for k, (n, gone, spans, kept) in enumerate(plain(texts, 400))
    ]
    assert found == sorted(wanted)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_suffix_dedup(spark, str(tmp_path)).count() == 0


def test_a_single_long_periodic_text(spark):
    texts = ["ab" * 120_000, "b" + "ab" * 300, prose(8, 50)]
    n = removed(spark, texts)
    assert [r[1] for r in n] == [240_000, 601, 0]


def test_matching_statistics_of_all_suffixes():
    draw = random.Random(4)
    for _ in range(100):
        own = [draw.randint(1, 3) for _ in range(draw.randint(0, 50))]
        n = len(own)

        def common(i, j):
            k = 0
            while max(i, j) + k < n and own[i + k] == own[j + k]:
                k += 1
            return k

        longest = [max((common(i, j) for j in range(n) if j != i), default=0) for i in range(n)]
        assert bytes_index.matching_statistics(np.array(own, np.int64)).tolist() == longest


def test_equal_texts_are_one_row(spark):
    docs = spark.createDataFrame([("a" * 500,), ("a" * 500,), ("b" * 399,), (None,)], "text string")
    assert bytes_index.different_texts(docs).select("n", F.octet_length("text")).collect() == [(2, 500)]
