"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs used as letters to the letters they
stand for, and drops invisible characters. Lexicon entries are words or word beginnings with weights (log odds learned
from labelled texts); an entry inside a longer exception phrase doesn't count. The matched weight, relative to the
length of the text and in total, gives the score through a logistic function fitted on labelled texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.shipping import ship
from fieldmill.llm.words import small_batches
from fieldmill.sources.shared import stored

SAMPLE_ROWS, LEXICON_SIZE, EXCEPTION_SIZE = 20_000, 20_000, 5_000
_SHORTEST, _LONGEST = 3, 9

#: Used where no labels teach a lexicon.
DEFAULT_WORDS = "idiot moron stupid scum trash worthless disgusting pathetic loser clown".split()
#: Innocent phrases that hold an entry.
DEFAULT_EXCEPTIONS = ["trash can", "trash bag", "trash bin", "clown fish", "clownfish", "class clown"]

_HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ӏ": "l", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ʟ": "l", "ɩ": "i",
}
_AS_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
_INVISIBLE = dict.fromkeys("­​‌‍⁠﻿")


def _fold_table() -> dict:
    wide = {chr(c): unicodedata.normalize("NFKC", chr(c)).lower() for c in range(0xFF01, 0xFF5F)}
    table = {**_HOMOGLYPHS, **_AS_LETTERS, **_INVISIBLE, **wide}
    for sign, letter in list(table.items()):
        if letter in _AS_LETTERS:
            table[sign] = _AS_LETTERS[letter]
    return str.maketrans(table)


_FOLD = _fold_table()
_BETWEEN_WORDS = re.compile(r"[\W_]+")


def folded(text: str | None) -> str:
    """Folded words of a text, a space before, between and after them; null is empty."""
    return f" {_BETWEEN_WORDS.sub(' ', (text or '').lower().translate(_FOLD)).strip()} "


def _entries(word: str) -> Iterator[str]:
    """What an entry may look like: the word itself and its beginnings."""
    yield f" {word} "
    for n in range(_SHORTEST, min(len(word), _LONGEST) + 1):
        yield f" {word[:n]}"


@dataclass
class ToxicityModel:
    """Lexicon (entry -> weight; entries start with a space), exceptions and the logistic function's parameters."""

    lexicon: dict[str, float]
    exceptions: list[str] = field(default_factory=lambda: list(DEFAULT_EXCEPTIONS))
    center: tuple[float, ...] = (0.0, 0.0, 0.0)
    scale: tuple[float, ...] = (1.0, 1.0, 1.0)
    coefficients: tuple[float, ...] = (2.0, 2.0, 2.0)
    intercept: float = -3.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.lexicon.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            entry = folded(phrase).rstrip()
            found.add_word(entry, (len(entry), None))
        if len(found):
            found.make_automaton()
        return found

    def score(self, features: np.ndarray) -> np.ndarray:
        z = ((features - np.array(self.center)) / np.array(self.scale)) @ np.array(self.coefficients) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def default_model() -> ToxicityModel:
    return ToxicityModel({f" {word}": 3.0 for word in DEFAULT_WORDS})


def _matched(text: str | None, automaton: ahocorasick.Automaton) -> tuple[int, int, float]:
    """(words, counted matches, their weight)"""
    content = folded(text)
    words = content.count(" ") - 1 if content.strip() else 0
    if not words or not len(automaton):
        return words, 0, 0.0
    hits, excepted = [], []
    for end, (length, weight) in automaton.iter(content):
        (excepted if weight is None else hits).append((end - length + 1, end, weight))
    if excepted:
        hits = [h for h in hits if not any(a <= h[0] and h[0] < b for a, b, _ in excepted)]
    best: dict[int, float] = {}
    for start, _, weight in hits:
        best[start] = max(weight, best.get(start, weight))
    return words, len(best), sum(best.values())


def _features(measured: list[tuple[int, int, float]]) -> np.ndarray:
    words, hits, weight = np.array(measured, float).reshape(-1, 3).T
    return np.stack([100 * weight / (words + 10), np.log1p(weight), np.log1p(hits)], axis=1)


def _entry_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 0):
        entries, toxic = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = {e for word in set(folded(text).split()) for e in _entries(word)}
            entries.extend(own)
            toxic.extend([label] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(toxic, pa.int32())], ["entry", "toxic"])


def _chosen(rows: list, positive: int, negative: int) -> dict[str, float]:
    """The entries with most evidence that don't begin or continue one chosen before."""
    lexicon: dict[str, float] = {}
    beginnings: set[str] = set()
    for row in rows:
        entry = row["entry"]
        parts = {entry[:n] for n in range(_SHORTEST + 1, len(entry) + 1)}
        if parts & lexicon.keys() or entry in beginnings:
            continue
        lexicon[entry] = math.log((row["n1"] + 0.5) / (positive + 1)) - math.log((row["n0"] + 0.5) / (negative + 1))
        beginnings |= parts
    return lexicon


def _fitted(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> tuple:
    """Ridge logistic regression by Newton steps; both labels count alike in total at most four to one."""
    center, scale = features.mean(0), features.std(0) + 1e-9
    x = np.column_stack([(features - center) / scale, np.ones(len(features))])
    beta = np.zeros(x.shape[1])
    penalty = ridge * len(x) * np.diag([1e-1] * (x.shape[1] - 1) + [0.0]) + 1e-6 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (labels - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(center), tuple(scale), tuple(beta[:-1]), float(beta[-1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    lexicon_size: int = LEXICON_SIZE,
    exception_size: int = EXCEPTION_SIZE,
    least_texts: int = 3,
) -> ToxicityModel:
    """Learn lexicon, exceptions and calibration from labelled texts.

    At most ``sample_rows`` labels are used, those with the smallest hashes of their ids, so the sample of labels
    may be sent to every task; rows with a null id or label aren't used, a doubly labelled id counts as toxic if
    one label says so. An entry is taken if its share of toxic texts is higher than chance explains, given how
    many entries were looked at. Without both kinds of labels the default model is returned. Of several texts of one
    labelled id the first in order is used, so no more than ``sample_rows`` texts are ever stored or measured.

    The model goes to every task, so its size has a bound: the ``lexicon_size`` entries with most evidence and the
    ``exception_size`` most frequent innocent words that begin with one. Entries are words, or their beginnings of 3 to 9
    letters, of at least ``least_texts`` sampled texts.
    """
    spark = docs.sparkSession
    ship(spark)
    sample = (
        labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("toxic"))
        .dropna()
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).dropna()
    texts = texts.join(F.broadcast(sample), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    texts = stored(texts.select("text", "toxic"), "labelled")
    kinds = {row["toxic"]: row["count"] for row in texts.groupBy("toxic").count().collect()}
    positive, negative = kinds.get(1, 0), kinds.get(0, 0)
    if not positive or not negative:
        return default_model()
    counts = (
        texts.mapInArrow(_entry_rows, "entry string, toxic int")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
        .filter(F.col("n1") + F.col("n0") >= least_texts)
    )
    counts = stored(counts, "entries")
    tried = counts.count()
    n, share, base = F.col("n1") + F.col("n0"), F.col("n1") / (F.col("n1") + F.col("n0")), positive / (positive + negative)
    evidence = n * (
        F.when(share > 0, share * F.log(share / base)).otherwise(0.0)
        + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    )
    found = (
        counts.filter(share > max(0.5, 2 * base) if base < 0.4 else share > (1 + base) / 2)
        .withColumn("evidence", evidence)
        .filter(F.col("evidence") > math.log(max(tried, 2)))
        .orderBy(F.desc("evidence"), F.length("entry"), "entry")
        .limit(lexicon_size)
    )
    lexicon = _chosen(found.collect(), positive, negative) or default_model().lexicon
    chosen = spark.createDataFrame([(e,) for e in lexicon], "chosen string")
    begins = F.explode(F.transform(F.sequence(F.lit(_SHORTEST + 1), F.length("entry")), lambda k: F.substring(F.col("entry"), F.lit(1), k)))
    innocent = (
        counts.filter("n1 = 0 and length(entry) > 4")
        .select("entry", "n0", begins.alias("chosen"))
        .join(F.broadcast(chosen), "chosen")
        .orderBy(F.desc("n0"), "entry")
        .limit(exception_size)
    )
    exceptions = sorted({row["entry"].strip() for row in innocent.collect()} | set(DEFAULT_EXCEPTIONS))
    model = ToxicityModel(lexicon, exceptions)
    measured = measure(texts, model, ["toxic"]).select("doc.toxic", "n_words", "n_matches", "weight").collect()
    features = _features([(r["n_words"], r["n_matches"], r["weight"]) for r in measured])
    fit = _fitted(features, np.array([r["toxic"] for r in measured], float))
    model.center, model.scale, model.coefficients, model.intercept = fit
    return model


def _measure(batches: Iterator[pa.RecordBatch], shipped) -> Iterator[pa.RecordBatch]:
    model = shipped.value
    automaton = model.automaton()
    for batch in small_batches(batches, 1):
        measured = [_matched(text, automaton) for text in batch.column(1).to_pylist()]
        words, hits, weight = zip(*measured) if measured else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(words, pa.int64()),
                pa.array(hits, pa.int64()),
                pa.array(weight, pa.float64()),
                pa.array(model.score(_features(measured)), pa.float64()),
            ],
            ["doc", "n_words", "n_matches", "weight", "score"],
        )


def measure(docs: DataFrame, model: ToxicityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` as the struct ``doc`` with ``n_words``, ``n_matches``, ``weight`` and ``score`` of each text.

    Null and empty texts have no words and get the score of a text without matches. Repeated rows each get
    their score; columns of ``docs`` may have any names.
    """
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), docs[text_col].alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _measure(batches, shipped), f"doc {kind}, n_words long, n_matches long, weight double, score double"
    )


def _clean(batches: Iterator[pa.RecordBatch], shipped, text_at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    model = shipped.value
    automaton = model.automaton()
    for batch in small_batches(batches, text_at):
        scores = model.score(_features([_matched(text, automaton) for text in batch.column(text_at).to_pylist()]))
        yield batch.filter(pa.array(scores < threshold))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, all columns unchanged."""
    ship(docs.sparkSession)
    shipped, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)
    return docs.mapInArrow(lambda batches: _clean(batches, shipped, at, threshold), docs.schema)
