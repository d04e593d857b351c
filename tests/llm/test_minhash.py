from __future__ import annotations

import collections

import numpy as np

from fieldmill.llm import minhash
from tests.llm.helpers import AWKWARD, letter_words, prose


def changed(text, every, tag):
    return " ".join(f"{tag}{i}" if i % every == 7 else w for i, w in enumerate(text.split()))


BASE, OTHER = prose(1, 300, 5000), prose(2, 250, 5000)
TEXTS = [
    *AWKWARD,
    "",
    BASE,
    BASE,
    changed(BASE, 150, "p"),
    changed(changed(BASE, 150, "p"), 140, "q"),
    changed(BASE, 20, "r"),
    OTHER,
    OTHER.upper() + "!",
    OTHER + " " + prose(3, 200, 5000),
    prose(4, 300, 5000),
    *[changed(prose(5, 400, 5000), 200, f"z{i}") for i in range(40)],
    "a",
]


def weighted(text):
    words = letter_words(text)
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or collections.Counter([tuple(words)] if words else [])


def plain(texts):
    """Smallest row number by links of weighted Jaccard similarity 0.8 or more, shingle frequencies as documented."""
    sets = [weighted(t) for t in texts]
    given = [t for t in texts if t is not None]
    seen = collections.Counter(x for t in given for x in weighted(t))
    least = max(minhash.COMMON * len(given), 1)
    weigh = lambda x: 1.0 if seen[x] <= least else 1 - 0.5 * np.log(seen[x] / least) / np.log(max(len(given) / least, 2))
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            same = texts[a] is not None and texts[a] == texts[b]
            shared = sum(min(n, sets[b][x]) * weigh(x) for x, n in sets[a].items())
            total = sum(n * weigh(x) for s in (sets[a], sets[b]) for x, n in s.items()) - shared
            if same or (shared and shared / total >= 0.8):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def test_agrees_with_all_pairs(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, node string")
    found = {r["doc"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(TEXTS))] == plain(TEXTS)
    kept = minhash.one_of_each(docs, minhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({*plain(TEXTS)})


def test_samples_agree_as_often_as_texts_are_similar():
    draw = np.random.default_rng(5)
    sampler = minhash.Sampler(hashes=2048, rows=1)
    hashes = draw.integers(0, 1 << 44, 500).astype(np.uint64)
    for spread in ([1.0], [0.5, 1.0, 3.0], [0.6, 0.9]):
        a, b = draw.choice(spread, 500), draw.choice(spread, 500)
        a[:100], b[400:] = 0, 0
        sketch = [sampler.samples(np.zeros((w > 0).sum(), np.int64), hashes[w > 0], w[w > 0], 1) for w in (a, b)]
        assert abs((sketch[0] == sketch[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_repeated_missing_ids_and_empty_tables(spark):
    rows = [(1, BASE), (1, BASE), (None, BASE), (2, BASE), (None, None), (3, None), (None, OTHER)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = minhash.near_duplicates(docs)
    assert sorted((tuple(r)[0], tuple(r)[2]) for r in classes.filter("node is not null and doc is not null").collect()) == [(1, 1), (1, 1), (2, 1)]
    kept = minhash.one_of_each(docs, classes).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(1, BASE), (None, None), (3, None), (None, OTHER)], key=repr)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_members_unlike_the_first_of_their_bucket_still_meet(spark):
    texts = [(f"{i:02d}", t) for i, t in enumerate([prose(1, 50), prose(2, 50), *[changed(prose(3, 200, 999), 150, f"k{i}") for i in range(6)]])]
    nodes = spark.createDataFrame(texts, "node string, text string")
    members = nodes.selectExpr("7L as band", "node")
    ones = spark.sparkContext.broadcast(np.ones(1 << 18, np.float32))
    for rounds in (1, 2, 5):
        links = {tuple(r) for r in minhash.linked_nodes(members, nodes, ones, rounds=rounds).collect()}
        seen = {x for link in links for x in link}
        assert seen == {n for n, _ in texts[2:]}


def revision(k, step, words=200):
    """The k-th of a chain of revisions of one text, ``step`` more of its words changed in each."""
    return " ".join(f"r{i}" if i % 5 == 2 and i // 5 < step * k else w for i, w in enumerate(prose(11, words, 99999).split()))


def grouped(pairs):
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for u, v in pairs:
        low, high = sorted((find(u), find(v)))
        root[high] = low
    return {x: find(x) for x in list(root)}


def all_pairs(members, texts):
    """Links of similarity 0.8 or more among the texts that share a band, every shingle weighing one."""
    found = []
    for band in {b for b, _ in members}:
        own = [n for b, n in members if b == band]
        for u, v in ((u, v) for u in own for v in own if u < v):
            a, b = weighted(texts[u]), weighted(texts[v])
            if 5 * sum((a & b).values()) >= 4 * sum((a | b).values()):
                found.append((u, v))
    return found


def linked(spark, members, texts, rounds=minhash.STAR_ROUNDS):
    nodes = spark.createDataFrame(sorted(texts.items()), "node string, text string")
    ones = spark.sparkContext.broadcast(np.ones(1 << 18, np.float32))
    banded = spark.createDataFrame(members, "band long, node string")
    return [tuple(r) for r in minhash.linked_nodes(banded, nodes, ones, rounds=rounds).collect()]


def test_a_text_alone_unlike_its_hub_meets_the_others(spark):
    texts = {"z": revision(0, 4), "b": revision(1, 4), "a": revision(2, 4)}  # z links b, b links a
    members = [(1, n) for n in texts]
    assert grouped(all_pairs(members, texts)) == {"a": "a", "b": "a", "z": "a"}
    assert grouped(linked(spark, members, texts)) == {"a": "a", "b": "a", "z": "a"}


def test_texts_of_two_hubs_meet(spark):
    """Chains of revisions in one bucket, and in several that overlap: no link of all pairs of a bucket is lost."""
    names = "azybcdexfgwh"  # z is the first hub, y central; later x links e and f, w links g and h, and f and g are alike
    chain = {n: revision(k, 4, 260) for k, n in enumerate(names)}
    one = [(1, n) for n in names]
    assert {*grouped(all_pairs(one, chain)).values()} == {"a"}
    assert grouped(linked(spark, one, chain)) == grouped(all_pairs(one, chain))
    draw = np.random.default_rng(3)
    texts = {f"{draw.integers(1 << 30):08x}{k}": revision(k, 2 + k % 3) for k in range(12)}
    several = [(band, n) for band in range(4) for n in texts if draw.random() < 0.6]
    found = linked(spark, several, texts)
    assert grouped(found) == grouped(found + all_pairs(several, texts))
    assert {tuple(sorted(pair)) for pair in found} <= {*all_pairs([(0, n) for n in texts], texts)}
