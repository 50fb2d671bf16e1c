"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of 128 words. Every passage is encoded by a small network; gated
attention, learned from the labels of whole texts, weighs the passages, and the weighted
representation is scored. Labels say nothing about passages; the weights find what matters.

The network is fitted on at most ``sample_rows`` labelled texts, the first in a hash
order of their ids; every text is then scored as a whole.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, text_slices
from .words import words_of

PASSAGE_WORDS = 128
SAMPLE_ROWS = 4000
HIDDEN, ATTENTION = 16, 8
PREDICTED_FROM = 0.3

_KINDS = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "beyond": range(0x80, 0x100),
    "stop": b".?",
    "comma": b",;:",
    "bang": b"!",
    "bar": b"|",
    "sign": b"#$%&*@^~+=<>",
    "bracket": b"()[]{}/\\\"'`_-",
    "line": b"\n",
}
_KIND = np.full(256, len(_KINDS), dtype=np.uint8)
for _i, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _i
FEATURES = len(_KINDS) + 7


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """passages x FEATURES, and where each text's passages begin (one more than texts).

    A text without words has one passage of zeros.
    """
    words = words_of(texts)
    hashes = words.hashes()
    counts = np.diff(words.first)
    bags = np.maximum(1, -(-counts // PASSAGE_WORDS))
    begins = np.concatenate([[0], np.cumsum(bags)])
    n = int(begins[-1])
    out = np.zeros((n, FEATURES), dtype=np.float32)
    if not len(words.start):
        return out, begins
    nth = np.arange(len(words.start)) - words.first[:-1][words.doc]
    passage = begins[:-1][words.doc] + nth // PASSAGE_WORDS
    size = np.bincount(passage, minlength=n).astype(np.float64)
    some = size > 0
    first = np.searchsorted(passage, np.flatnonzero(some))
    last = np.append(first[1:], len(passage)) - 1
    begin, end = words.start[first], words.end[last]
    length = np.maximum(1, end - begin)
    kinds = _KIND[words.data]
    for i in range(len(_KINDS)):
        upto = np.concatenate([[0], np.cumsum(kinds == i)])
        out[some, i] = (upto[end] - upto[begin]) / length
    c = len(_KINDS)

    def distinct(of: np.ndarray, where: np.ndarray) -> np.ndarray:
        order = np.lexsort((of, where))
        fresh = np.ones(len(of), dtype=bool)
        fresh[1:] = (of[order][1:] != of[order][:-1]) | (where[order][1:] != where[order][:-1])
        return np.bincount(where[order][fresh], minlength=n)

    out[:, c] = distinct(hashes, passage) / np.maximum(1, size)
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    inside = passage[:-1] == passage[1:]
    out[:, c + 1] = distinct(pairs[inside], passage[:-1][inside]) / np.maximum(1, size - 1)
    again = np.bincount(passage[:-1][inside], weights=(hashes[:-1] == hashes[1:])[inside], minlength=n)
    out[:, c + 2] = again / np.maximum(1, size)
    lengths = (words.end - words.start).astype(np.float64)
    mean = np.bincount(passage, weights=lengths, minlength=n) / np.maximum(1, size)
    square = np.bincount(passage, weights=lengths**2, minlength=n) / np.maximum(1, size)
    out[:, c + 3] = mean / 10
    out[:, c + 4] = np.sqrt(np.maximum(0, square - mean**2)) / 10
    out[:, c + 5] = np.log1p(size) / 5
    whole = np.concatenate([[0], np.cumsum(distinct(hashes, words.doc)[: len(counts)])]) if len(counts) else np.zeros(1)
    of_text = np.diff(whole) / np.maximum(1, counts)
    out[:, c + 6] = np.repeat(of_text, bags)
    return out, begins


class Attention:
    """Encoder, gated attention and score, with its own gradients."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        shape = {"W": (FEATURES, HIDDEN), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,)}
        self.p = {k: rng.normal(size=s) / np.sqrt(s[0]) for k, s in shape.items()}
        self.p |= {"b": np.zeros(HIDDEN), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, begins: np.ndarray):
        p = self.p
        h = np.tanh(((x - self.mean) / self.scale) @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        top = np.maximum.reduceat(a, begins[:-1])
        e = np.exp(a - top[bag])
        weight = e / np.add.reduceat(e, begins[:-1])[bag]
        z = np.add.reduceat(weight[:, None] * h, begins[:-1], axis=0)
        return h, t, g, bag, weight, z, z @ p["c"] + p["d"][0]

    def score(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        if len(begins) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self._forward(x, begins)[-1], -40, 40)))

    def fit(self, x: np.ndarray, begins: np.ndarray, labels: np.ndarray, epochs: int = 60, batch: int = 256, rate: float = 0.01) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng = np.random.default_rng(2)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                these = np.sort(order[at : at + batch])
                sizes = np.diff(begins)[these]
                rows = np.repeat(begins[:-1][these] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                g = self._gradient(x[rows], np.concatenate([[0], np.cumsum(sizes)]), labels[these])
                step += 1
                for k in self.p:
                    g[k] += 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    lr = rate * (1 - epoch / epochs)
                    self.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def _gradient(self, x, begins, labels) -> dict[str, np.ndarray]:
        p = self.p
        h, t, g, bag, weight, z, s = self._forward(x, begins)
        ds = (1 / (1 + np.exp(-s)) - labels) / len(labels)
        dz = ds[:, None] * p["c"]
        dw = (dz[bag] * h).sum(axis=1)
        da = weight * (dw - np.add.reduceat(weight * dw, begins[:-1])[bag])
        dtg = da[:, None] * p["w"]
        dt, dg = dtg * g * (1 - t**2), dtg * t * g * (1 - g)
        dh = weight[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h**2)
        unit = (x - self.mean) / self.scale
        return {
            "W": unit.T @ dpre, "b": dpre.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
            "w": (t * g).T @ da, "c": z.T @ ds, "d": np.array([ds.sum()]),
        }


def _features(batches):
    for batch in batches:
        for part in text_slices(batch, "text"):
            x, begins = passage_features(part.column("text"))
            rows = [x[a:b].astype("<f4").tobytes() for a, b in zip(begins, begins[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(rows, pa.binary())], names=["label", "passages"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Attention | None:
    """The network of up to ``sample_rows`` texts of ``docs`` with a label in ``labels`` (doc_id, label)."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("label").cast("int").alias("label"))
    known = known.where("_id is not null and label in (0, 1)").dropDuplicates(["_id"])
    known = known.orderBy(F.xxhash64("_id", F.lit(11)), "_id").limit(sample_rows)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), rows["doc_id"] == known["_id"]).select("label", "text")
    found = rows.mapInArrow(_features, "label int, passages binary").collect()  # ``sample_rows`` texts
    if not found:
        return None
    found.sort(key=lambda r: (bytes(r[1]), r[0]))  # rows come in any order
    x = [np.frombuffer(r[1], dtype="<f4").reshape(-1, FEATURES) for r in found]
    model = Attention()
    model.fit(np.concatenate(x).astype(np.float64), np.concatenate([[0], np.cumsum([len(v) for v in x])]), np.array([r[0] for r in found], dtype=float))
    return model


def _score(batches, model: Attention | None, threshold: float):
    for batch in batches:
        for part in text_slices(batch, "text"):
            x, begins = passage_features(part.column("text"))
            score = model.score(x, begins) if model else np.full(part.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )


def score_quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``.

    ``labels`` (doc_id, label 0 or 1): rows of the held-out fold, without an id or with another
    label are not learned from. Null and empty texts are bags of one empty passage and are scored.
    Without any usable label every score is 0.5. A null id is not held out.
    """
    model = fit_quality(docs, labels.where(fold("doc_id", parts) != held_out), sample_rows)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    work = partial(_score, model=model, threshold=PREDICTED_FROM)
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")
