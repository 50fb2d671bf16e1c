"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. Each model sees what the text's terms say and the
probabilities of the categories before it; for training these are out-of-fold predictions,
so that a model meets probabilities as uncertain as those of unseen texts.

Terms are words and stems, told apart by ``TERM_BITS`` bits of a hash. Spark counts over all training
texts in how many toxic and other texts each occurs; of equal texts one counts. Every term that
toxic texts hold significantly more often counts, however many there are: it falls into one
of ``GROUPS`` groups, by hash, and into a band by how much likelier it makes a toxic text. What a
model sees of a text is how much of each group and band it holds, so the models are small and
a term need not occur in the texts they were fitted on.

Where labels only say toxic or not, categories are made of the groups: a category is "toxic, and
holds a strong term of this group". The chain then ends with the label itself.

The linear models are fitted on about ``sample_rows`` distinct texts of each class at most, the first in
the order of their digests. Every text is scored as a whole.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, text_slices
from .words import Words, mix, units_of

SAMPLE_ROWS = 3000
TERM_BITS = 24
LEAST_TEXTS = 5  # a term must occur in so many texts
SIGNIFICANT = 4.5  # standard errors
BANDS = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0)  # edges, in log odds less a standard error
STRONG = 2  # bands from here on make a category
GROUPS = 3
MOST_SENT = 1_000_000  # labels of 12 bytes that go to every task; with more of them, texts are shuffled to their labels
FOLDS = 4
STEMS = (4, 5, 6)  # bytes
THRESHOLD = 0.5


def _all_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every word and every stem (a longer word's first bytes) of each text: hash and text."""
    units = units_of(texts)
    size = units.end - units.start
    hashes, docs = [units.hashes()], [units.doc]
    for stem in STEMS:
        longer = size > stem
        part = Words(units.data, units.start[longer], units.start[longer] + stem, units.doc[longer], units.first)
        hashes.append(mix(part.hashes() + np.uint64(stem)))
        docs.append(part.doc)
    return np.concatenate(hashes), np.concatenate(docs)


def _counted(h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text: hash, text, and log(1 + occurrences)."""
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(fresh)
    return h[at], d[at], np.log1p(np.diff(np.append(at, len(h))))


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """_counted terms of the texts, by the bits of their hashes that tell them apart."""
    h, d = _all_terms(texts)
    return _counted((h >> np.uint64(64 - TERM_BITS)).astype(np.int64), d)


def features(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """texts x features: log counts of the terms of each group and band, of each band, and of all.

    A band in all groups together is what a model learns even where its sample lacks a group's terms.
    """
    codes = GROUPS * (len(BANDS) + 1)
    bucket, d, value = _buckets(texts)
    code = table[bucket].astype(np.int64)
    hit = code > 0
    sums = np.bincount(d[hit] * codes + code[hit] - 1, weights=value[hit], minlength=len(texts) * codes)
    every = np.bincount(d, minlength=len(texts))
    sums = sums.reshape(len(texts), GROUPS, len(BANDS) + 1)
    return np.log1p(np.hstack([sums.reshape(len(texts), codes), sums.sum(axis=1), every[:, None]]))


class Linear:
    """Logistic regression on dense rows, by Newton steps with a ridge."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Linear:
        x = np.hstack([x, np.ones((len(x), 1))])
        w = np.zeros(x.shape[1])
        penalty = np.full(x.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + penalty * w
            hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            move = np.linalg.solve(hess, grad)
            w -= move
            if np.abs(move).max() < 1e-6:
                break
        return cls(w)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


class Chain:
    """Models in order, each fed the probabilities of those before it; ``table`` holds the code of each term."""

    def __init__(self, table: np.ndarray, models: list[Linear]):
        self.table, self.models = table, models

    def score(self, x: np.ndarray) -> np.ndarray:
        """texts x categories."""
        out = np.zeros((len(x), 0))
        for model in self.models:
            out = np.hstack([out, model.score(np.hstack([x, out]))[:, None]])
        return out

    @classmethod
    def fit(cls, table: np.ndarray, x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> Chain:
        """labels: texts x categories in 0, 1; folds: each text's fold for out-of-fold predictions."""
        models, before = [], np.zeros((len(x), 0))
        for i in range(labels.shape[1]):
            full, y = np.hstack([x, before]), labels[:, i].astype(float)
            unseen = np.zeros(len(x))
            for f in np.unique(folds):
                rest = folds != f
                unseen[~rest] = Linear.fit(full[rest], y[rest]).score(full[~rest]) if rest.any() else y.mean()
            models.append(Linear.fit(full, y))
            before = np.hstack([before, unseen[:, None]])
        return cls(table, models)


def mine_categories(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """texts x groups: toxic texts that hold a strong term of the group."""
    by_band = x[:, : GROUPS * (len(BANDS) + 1)].reshape(len(x), GROUPS, len(BANDS) + 1)
    return (by_band[:, :, STRONG:].sum(axis=2) > 0).astype(np.int64) * toxic.astype(np.int64)[:, None]


def _tally(batches):
    """bucket, n, toxic: texts that hold each term, all and toxic; bucket -1 counts the texts themselves."""

    def out(bucket, n, toxic):
        for a in range(0, len(bucket), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(v[part].astype(np.int64)) for v in (bucket, n, toxic)], names=["bucket", "n", "toxic"])

    for batch in batches:
        for part in text_slices(batch, "text", 8 << 20):
            label = part.column("label").to_numpy()
            bucket, d, _ = _buckets(part.column("text"))
            names, inverse = np.unique(bucket, return_inverse=True)
            n = np.bincount(inverse, minlength=len(names))
            toxic = np.bincount(inverse, weights=label[d], minlength=len(names))
            yield from out(np.append(names, -1), np.append(n, len(label)), np.append(toxic, label.sum()))


def term_table(counted: DataFrame, texts: int, toxic: int) -> np.ndarray:
    """The code of each term, 0 for one that says nothing: 2**TERM_BITS bytes, whatever the corpus.

    counted: bucket, n, toxic, as ``_tally`` names them, summed.
    """
    base = toxic / texts
    expected = F.col("n") * base
    odds = F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5)) - F.lit(float(np.log(toxic / (texts - toxic))))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("n") - F.col("toxic") + 0.5))
    strength = odds - error
    band = sum((strength >= edge).cast("int") for edge in BANDS)
    group = F.pmod(F.xxhash64("bucket"), F.lit(GROUPS))
    told = counted.where((F.col("bucket") >= 0) & (F.col("n") >= LEAST_TEXTS)).where(
        (F.col("toxic") - expected) / F.sqrt(expected * (1 - base)) >= SIGNIFICANT
    )
    told = told.select("bucket", (1 + group * (len(BANDS) + 1) + band).cast("int").alias("code")).toArrow()
    table = np.zeros(1 << TERM_BITS, dtype=np.uint8)
    table[told["bucket"].to_numpy()] = told["code"].to_numpy()
    return table


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Chain | None:
    """The chain of the texts of ``docs`` that ``labels`` (doc_id, label 0 or 1) covers.

    An id with both labels counts as toxic. Which way texts meet their labels goes by the number of labels,
    and changes nothing in the result.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("label").cast("int").alias("label"))
    known = known.where("_id is not null and label in (0, 1)").groupBy("_id").agg(F.max("label").alias("label"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    known = cut(known)
    few = known.count() <= MOST_SENT
    rows = rows.join(F.broadcast(known) if few else known, rows["doc_id"] == known["_id"])
    rows = rows.select("label", "text", F.md5("text").alias("digest"))
    texts = rows.groupBy("label", "digest").agg(F.first("text").alias("text"))

    counted = texts.mapInArrow(_tally, "bucket long, n long, toxic long").groupBy("bucket")
    counted = cut(counted.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")))
    totals = counted.where("bucket = -1").collect()
    if not totals or not 0 < totals[0]["toxic"] < totals[0]["n"]:
        return None
    n, toxic = totals[0]["n"], totals[0]["toxic"]
    table = term_table(counted, n, toxic)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def seen(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                x = features(part.column("text"), sent.value)
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("digest"), pa.array(list(x))], names=["label", "digest", "x"])

    # A digest below the threshold is one of about sample_rows; a tenth and 200 more make a shortfall all but impossible.
    wanted = [1.1 * sample_rows + 200] * 2
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    share = F.when(F.col("label") == 1, F.lit(wanted[1] / toxic)).otherwise(F.lit(wanted[0] / (n - toxic)))
    found = texts.where(place < share).mapInArrow(seen, "label int, digest string, x array<double>").collect()
    found = sorted((r["digest"], r["label"], r["x"]) for r in found)
    found = [r for label in (0, 1) for r in [f for f in found if f[1] == label][:sample_rows]]
    found.sort()  # a fixed order, in which folds are dealt
    x, is_toxic = np.array([r[2] for r in found]), np.array([r[1] for r in found])
    folds = np.arange(len(x)) % FOLDS
    return Chain.fit(table, x, np.hstack([mine_categories(x, is_toxic), is_toxic[:, None]]), folds)


def _score(batches, chain, kinds: int):
    for batch in batches:
        for part in text_slices(batch, "text"):
            if chain:
                p = chain.value.score(features(part.column("text"), chain.value.table))
            else:
                p = np.zeros((part.num_rows, kinds + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out")]
                + [pa.array(p[:, i]) for i in range(kinds)]
                + [pa.array(p[:, -1]), pa.array((p[:, -1] >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", *(f"kind_{i + 1}" for i in range(kinds)), "score", "predicted"],
            )


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, kind_1.., score, predicted: one row for each row of ``docs``.

    ``labels`` (doc_id, label): rows of the held-out fold, without an id or with a label other than
    0 and 1 are not learned from. Null and empty texts have no terms and are scored as such. If
    the labels lack either class, every score is 0. A null id is not held out. An empty table gives no
    rows; further columns are not read.
    """
    chain = fit_toxicity(docs, labels.where(fold("doc_id", parts) != held_out), sample_rows)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    kinds = "".join(f"kind_{i + 1} double, " for i in range(GROUPS))
    sent = chain and docs.sparkSession.sparkContext.broadcast(chain)  # 2**TERM_BITS bytes and small models
    work = partial(_score, chain=sent, kinds=GROUPS)
    return rows.mapInArrow(work, f"doc_id long, held_out boolean, {kinds}score double, predicted int")
