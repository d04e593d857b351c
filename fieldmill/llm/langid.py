"""Language identification by a small convolutional network over bytes, trained and applied with numpy.

Bytes are embedded, filters of several widths slide over a window, each filter keeps its largest response, and a
softmax layer turns these into probabilities. A text is cut into windows of fixed length, all of them are scored,
and the mean of their log probabilities decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.words import text_slices

SAMPLE_ROWS, WINDOW = 4_000, 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 16, 8
_BATCH, _ROUNDS, _RATE = 256, 500, 0.01
_LETTER = r"\p{L}"


@dataclass
class ByteNet:
    """Parameters of the network: byte embeddings, one filter bank a width, and the output layer."""

    languages: list[str]
    embedding: np.ndarray  # [256, EMBEDDING]; byte 0 also pads
    filters: list[np.ndarray]  # [width * EMBEDDING, FILTERS]
    biases: list[np.ndarray]
    output: np.ndarray  # [len(WIDTHS) * FILTERS, languages]
    output_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.output, self.output_bias]

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Pooled responses, and for training the unfolded inputs and the places of the largest responses.

        ``windows``: [n, length] bytes.
        """
        embedded = self.embedding[windows]
        pooled, inputs, places = [], [], []
        for width, bank, bias in zip(WIDTHS, self.filters, self.biases):
            size = windows.shape[1] - width + 1
            unfolded = np.concatenate([embedded[:, j : j + size] for j in range(width)], axis=2)
            response = unfolded.reshape(-1, unfolded.shape[2]) @ bank
            response = response.reshape(len(windows), size, -1)
            place = response.argmax(1)
            pooled.append(np.maximum(np.take_along_axis(response, place[:, None], 1)[:, 0] + bias, 0))
            inputs.append(unfolded)
            places.append(place)
        return np.concatenate(pooled, 1), inputs, places

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """[n, languages]; only the largest responses are kept, filter bank by filter bank."""
        embedded = self.embedding[windows]
        pooled = []
        for width, bank, bias in zip(WIDTHS, self.filters, self.biases):
            size = windows.shape[1] - width + 1
            parts = bank.reshape(width, EMBEDDING, -1)
            response = embedded[:, :size] @ parts[0]
            for j in range(1, width):
                response += embedded[:, j : j + size] @ parts[j]
            pooled.append(np.maximum(response.max(1) + bias, 0))
        return _log_softmax(np.concatenate(pooled, 1) @ self.output + self.output_bias)


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def _new_net(languages: list[str], draw: np.random.Generator) -> ByteNet:
    normal = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    return ByteNet(
        languages,
        draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [normal(width * EMBEDDING, FILTERS) for width in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(len(WIDTHS) * FILTERS, len(languages)),
        np.zeros(len(languages), np.float32),
    )


def _gradients(net: ByteNet, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    pooled, inputs, places = net.features(windows)
    wrong = np.exp(_log_softmax(pooled @ net.output + net.output_bias))
    wrong[np.arange(len(labels)), labels] -= 1
    wrong *= (weights / weights.sum())[:, None]
    back = (wrong @ net.output.T) * (pooled > 0)
    banks, biases, embedding = [], [], np.zeros_like(net.embedding)
    rows = np.arange(len(windows))[:, None]
    for k, (width, bank) in enumerate(zip(WIDTHS, net.filters)):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        picked = inputs[k][rows, places[k]]  # [n, FILTERS, width * EMBEDDING]
        banks.append(np.einsum("nf,nfd->df", own, picked))
        biases.append(own.sum(0))
        into = (own[:, :, None] * bank.T[None]).reshape(len(windows), FILTERS, width, EMBEDDING)
        for j in range(width):
            np.add.at(embedding, windows[rows, places[k] + j], into[:, :, j])
    return [embedding, *banks, *biases, pooled.T @ wrong, wrong.sum(0)]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], rounds: int = _ROUNDS, seed: int = 3) -> ByteNet:
    """Adam over random batches; every language has the same weight in total."""
    draw = np.random.default_rng(seed)
    net = _new_net(languages, draw)
    values = net.parameters()
    first, second = [np.zeros_like(p) for p in values], [np.zeros_like(p) for p in values]
    balance = (1 / np.maximum(np.bincount(labels, minlength=len(languages)), 1)).astype(np.float32)
    for t in range(1, rounds + 1):
        pick = draw.integers(0, len(windows), min(_BATCH, len(windows)))
        rate = _RATE * (1 - t / (rounds + 1)) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for p, g, m, v in zip(values, _gradients(net, windows[pick], labels[pick], balance[labels[pick]]), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(p.dtype)
    return net


def _cut(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, windows) covering every byte of every non-empty row; the last one of a row is padded with zeros."""
    sizes = np.diff(offsets)
    counts = -(-sizes // window)
    row = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] + number * window
    place = start[:, None] + np.arange(window)
    inside = place < offsets[row + 1][:, None]
    padded = np.append(data, np.uint8(0))
    return row, np.where(inside, padded[np.minimum(place, len(data))], 0).astype(np.uint8)


def learn(
    docs: DataFrame, text_col: str = "text", label_col: str = "lang", sample_rows: int = SAMPLE_ROWS, window: int = WINDOW
) -> ByteNet | None:
    """Train on ``sample_rows`` labelled texts at most; None if no row has both a text and a label.

    The sample takes the rows with the smallest hashes of their text, so it depends neither on the order of rows nor on copies. From
    each text three windows are taken, spread over its whole length.
    """
    given = docs.select(docs[text_col].alias("text"), docs[label_col].cast("string").alias("label")).dropna()
    given = given.filter(F.length("text") > 0)
    total = given.count()
    if not total:
        return None
    share = min(1.0, 1.2 * sample_rows / total)
    sampled = given.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    parts = [
        F.substring("text", (F.floor((F.length("text") - window) * at) + 1).cast("int"), F.lit(window))
        for at in (F.lit(0.0), F.lit(0.5), F.lit(1.0))
    ]
    long = F.length("text") > window
    windows = sampled.select(
        F.xxhash64("text").alias("order"), "label", F.when(long, F.array(*parts)).otherwise(F.array("text")).alias("windows")
    )
    rows = windows.dropDuplicates(["order", "label"]).orderBy("order", "label").limit(sample_rows).select("label", "windows").toArrow()
    languages = sorted(set(rows["label"].to_pylist()))
    taken = rows["windows"].combine_chunks()
    label = np.repeat([languages.index(x) for x in rows["label"].to_pylist()], np.diff(taken.offsets.to_numpy()))
    bytes_, labels = [], []
    for low, high, data, offsets in text_slices(taken.flatten()):
        row, cut = _cut(data, offsets, window)
        bytes_.append(cut)
        labels.append(label[low:high][row])
    return train(np.concatenate(bytes_), np.concatenate(labels), languages)


def _predict(batches: Iterator[pa.RecordBatch], shipped, window: int) -> Iterator[pa.RecordBatch]:
    net: ByteNet = shipped.value
    for batch in batches:
        text = pc.fill_null(batch.column(1), "")
        names, scores = [], []
        for low, high, data, offsets in text_slices(text, 1 << 18):
            row, windows = _cut(data, offsets, window)
            found = np.concatenate(
                [net.log_probabilities(windows[k : k + 64]) for k in range(0, len(windows), 64)]
                or [np.zeros((0, len(net.languages)), np.float32)]
            )
            used = (windows != 0).sum(1)
            summed = np.zeros((high - low, len(net.languages)))
            np.add.at(summed, row, found * used[:, None])
            total = np.bincount(row, used, high - low)
            probability = np.exp(_log_softmax(summed / np.maximum(total, 1)[:, None]))
            best = probability.argmax(1)
            names.extend(net.languages[k] for k in best)
            scores.append(probability[np.arange(len(best)), best])
        letters = pc.match_substring_regex(text, _LETTER).to_numpy(zero_copy_only=False)
        scores = np.where(letters, np.concatenate(scores) if scores else np.zeros(0), 0.0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([name if ok else "und" for name, ok in zip(names, letters)], pa.string()),
                pa.array(np.clip(scores, 0, 1), pa.float64()),
            ],
            ["doc", "lang_pred", "score"],
        )


def identify(docs: DataFrame, net: ByteNet | None, keep: list[str], text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The columns ``keep`` as the struct ``doc`` with ``lang_pred`` and ``score`` of every whole text.

    A null text, or one without a letter, is ``und`` with score 0, as is everything without a trained network. Repeated
    rows each get their prediction; columns of ``docs`` may have any names.
    """
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), docs[text_col].alias("text"))
    if net is None:
        return rows.select("doc", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shipped = docs.sparkSession.sparkContext.broadcast(net)
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _predict(b, shipped, window), f"doc {kind}, lang_pred string, score double")
