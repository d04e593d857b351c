from __future__ import annotations

from pyspark.sql import functions as F

from fieldmill.llm import decontaminate as d
from tests.llm.helpers import AWKWARD, letter_words, prose

LONG, SHORT = prose(1, 40), "Only Four words here"
ITEMS = [(1, LONG), (2, SHORT), (3, None), (4, "--"), (10, LONG), (None, prose(2, 20))]
TEXTS = [
    *AWKWARD,
    LONG,
    "before " + LONG.upper().replace(" ", ", ") + " after",
    prose(3, 500) + " " + " ".join(LONG.split()[5:18]) + " " + prose(4, 500),
    " ".join(LONG.split()[:12]),
    "and ONLY four; words... here only four words here",
    prose(2, 20),
    prose(5, 2000),
]
DOCS = [(i, t, "lang") for i, t in enumerate(TEXTS)] + [(3, LONG, "repeated id"), (None, LONG, "no id")]


def plain(text):
    words, hit, items = letter_words(text), set(), set()
    for item, content in ITEMS:
        own = letter_words(content)
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    if item is not None:
                        items.add(str(item))
    return len(words), len(hit), sorted(items), len(hit) > 0 and 20 * len(hit) >= len(words)


def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, hits string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_agrees_with_plain_search_whatever_the_block_size(spark):
    docs, benchmark = tables(spark)
    for block in (7, 1_000_000):
        found = d.judged(d.scan_benchmark(docs, benchmark, block_windows=block)).collect()
        assert len(found) == len(DOCS)
        for row in found:
            assert (row["n_words"], row["n_hit"], row["items"], row["contaminated"]) == plain(row["doc"]["text"])


def test_one_block_is_broadcast_at_a_time(spark, monkeypatch):
    docs, benchmark = tables(spark)
    windows = d.benchmark_windows(benchmark).count()
    alive, most = [], []
    broadcast = type(spark.sparkContext).broadcast

    def counted(self, value):
        shipped = broadcast(self, value)
        alive.append(len(value.items))
        most.append(sum(alive))
        destroy = shipped.destroy
        shipped.destroy = lambda: (alive.pop(), destroy())
        return shipped

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    found = d.judged(d.scan_benchmark(docs, benchmark, block_windows=-(-windows // 3))).collect()
    assert len(most) == 3 and max(most) < windows and not alive
    assert {(r["doc"]["text"], r["n_hit"], tuple(r["items"])) for r in found} == {
        (t, plain(t)[1], tuple(plain(t)[2])) for _, t, _ in DOCS
    }


def test_removing_documents_keeps_the_clean_ones_unchanged(spark):
    docs, benchmark = tables(spark)
    kept = d.remove_documents(d.scan_benchmark(docs, benchmark))
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=repr) == sorted((r for r in docs.collect() if not plain(r["text"])[3]), key=repr)


def test_removing_spans_leaves_no_hit_in_ordinary_prose(spark):
    docs, benchmark = tables(spark)
    cut = d.remove_spans(d.scan_benchmark(docs, benchmark))
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    texts = {r["doc_id"]: r["text"] for r in cut.filter("hits = 'lang'").collect()}
    assert texts[len(AWKWARD) + 1] == "before  after"
    assert texts[0] is None and texts[1] == ""
    assert plain(texts[len(AWKWARD) + 2])[1] == 0


def test_empty_tables(spark):
    docs, benchmark = tables(spark)
    assert d.scan_benchmark(docs.limit(0), benchmark).count() == 0
    unhit = d.judged(d.scan_benchmark(docs, benchmark.limit(0)))
    assert unhit.filter(F.col("n_hit") > 0).count() == 0 and unhit.count() == len(DOCS)
