"""Language ID by bit-sliced Bloom filters of character n-grams.

Every slot of one filter holds a byte for each language; an n-gram sets bits of its language's
byte in a few slots, and the AND of those slots gives, in one look-up, all languages that contain
it. The first bit is membership: every n-gram that a language's training texts hold at all sets it. Each
further bit is membership in a filter of the n-grams whose share of the language's n-grams reaches a
threshold, four times that of the bit before. A text's n-grams are looked up, the bits are counted for
each language, and the counts are corrected for the false positives that the share of filled slots of
each bit implies. The largest corrected count decides: so an n-gram that all languages contain
counts for those in which it is frequent.

An n-gram is four bytes of the text, with A-Z in lower case and every other ASCII sign as a
blank, kept whole. Counts by language and n-gram come from all training documents. The filter is as
large as its n-grams need, up to ``MOST_BYTES``; beyond that its false positives grow, and are corrected for.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, text_slices
from .words import bytes_of, mix

HASHES = 3
SLOTS_A_GRAM = 8
LEAST_SLOT_BITS = 16
MOST_BYTES = 128 << 20  # of the filter, which goes to every task
LEVELS = 8  # bits for each language: membership, then shares from 4**-10 on
SHARES = tuple(4.0**-k for k in range(10, 10 - LEVELS + 1, -1))
AT_ONCE = 1 << 18  # n-grams looked up together
MERGE_AT = 1 << 22  # distinct n-grams that a task holds before it hands them over
UNKNOWN = "und"

_LETTERS = np.full(256, 0x20, dtype=np.uint32)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts one after another, as their four bytes, and each one's text."""
    data, at = bytes_of(texts)
    sizes = np.diff(at)
    # Each text between blanks, so that words at its edges look like words inside.
    padded = np.full(len(data) + 2 * len(sizes) + 2, 0x20, dtype=np.uint32)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    padded[np.arange(len(data)) + 2 * doc + 1] = _LETTERS[data]
    packed = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:] if len(padded) > 3 else padded[:0]
    owner = np.repeat(np.arange(len(sizes)), sizes + 2)[: len(packed)]
    # A window belongs to the text that its second byte is in, and holds a letter there.
    inner = (packed & 0x00FFFF00) != 0x00202000
    last = (np.cumsum(sizes + 2) - 2)[owner] if len(sizes) else owner
    inner &= np.arange(len(packed)) < last
    return packed[inner], owner[inner]


def slots(number: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slots of each n-gram, an array for each hash."""
    spread = mix(number.astype(np.uint64) + np.uint64(1))
    step = (spread >> np.uint64(32)) | np.uint64(1)
    return [((spread + np.uint64(k) * step) & np.uint64((1 << bits) - 1)).astype(np.int64) for k in range(HASHES)]


class LanguageFilter:
    """``masks``: a row for each slot, with a byte for each language."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        self.bits = len(masks).bit_length() - 1
        filled = [[float(((masks[:, i] >> k) & 1).mean()) for k in range(LEVELS)] for i in range(len(languages))]
        self.false_rate = np.array(filled) ** HASHES

    def containing(self, number: np.ndarray) -> np.ndarray:
        """n-grams x languages: the byte of each language."""
        at = slots(number, self.bits)
        found = self.masks[at[0]]
        for more in at[1:]:
            found &= self.masks[more]
        return found

    def corrected_counts(self, texts: pa.Array) -> np.ndarray:
        """texts x languages: bits found, less the false positives to expect."""
        number, owner = grams(texts)
        n = len(texts)
        total = np.bincount(owner, minlength=n)
        out = np.zeros((n, len(self.languages)))
        # A bit that every slot holds says nothing, and counts nothing.
        worth = np.where(self.false_rate < 1, 1 / np.maximum(1 - self.false_rate, 1e-9), 0.0)
        by_byte = ((np.arange(1 << LEVELS)[:, None] >> np.arange(LEVELS)) & 1) @ worth.T
        for a in range(0, len(number), AT_ONCE):
            found, own = self.containing(number[a : a + AT_ONCE]), owner[a : a + AT_ONCE]
            low, high = own[0], own[-1] + 1
            for i in range(len(self.languages)):
                out[low:high, i] += np.bincount(own - low, weights=by_byte[found[:, i], i], minlength=high - low)
        return np.maximum(0.0, out - total[:, None] * (self.false_rate * worth).sum(axis=1))


def _count(batches):
    """lang, gram, n for all training texts of a task, merged until ``MERGE_AT`` are held."""

    def merged(parts):
        number = np.concatenate([p[0] for p in parts])
        order = np.argsort(number, kind="stable")
        number, n = number[order], np.concatenate([p[1] for p in parts])[order]
        first = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(number) else order
        return number[first], np.add.reduceat(n, first) if len(first) else n

    def out(lang, number, n):
        for a in range(0, len(number), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(number[part])), pa.array(number[part].astype(np.int64)), pa.array(n[part].astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    held: dict[str, list] = {}
    waiting = 0
    for batch in batches:
        for part in text_slices(batch, "text"):
            number, owner = grams(part.column("text"))
            langs = part.column("lang").dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False)[owner]
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = np.unique(number[code == i], return_counts=True)
                held.setdefault(lang, []).append(own)
                waiting += len(own[0])
            if waiting > MERGE_AT:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                waiting = sum(len(parts[0][0]) for parts in held.values())
                if waiting > MERGE_AT // 2:
                    for lang, parts in held.items():
                        yield from out(lang, *parts[0])
                    held, waiting = {}, 0
    for lang, parts in held.items():
        yield from out(lang, *merged(parts))


def _place(batches, bits: int):
    """slot, word, mask for each gram, word, mask."""
    for batch in batches:
        at = slots(batch.column("gram").to_numpy(), bits)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(at)),
                pa.concat_arrays([batch.column("word")] * HASHES),
                pa.concat_arrays([batch.column("mask")] * HASHES),
            ],
            names=["slot", "word", "mask"],
        )


def fit(training: DataFrame) -> LanguageFilter | None:
    """The filter of all rows of ``training`` (text, lang) with both; None if there are none.

    n-grams are counted and hashed to slots in Spark. What comes to the driver is a row for each
    language and the filter, at most ``MOST_BYTES`` (or ``2**LEAST_SLOT_BITS`` slots, if languages are many).
    """
    rows = training.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text is not null and lang is not null")
    counted = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    totals = {r[0]: r[1] for r in counted.groupBy("lang").agg(F.sum("n")).collect()}
    if not totals:
        return None
    languages = sorted(totals)
    words = -(-len(languages) // 8)
    n_grams = counted.select("gram").distinct().count()
    most = (MOST_BYTES // (8 * words)).bit_length() - 1
    bits = max(LEAST_SLOT_BITS, min(most, (SLOTS_A_GRAM * n_grams - 1).bit_length()))

    known = counted.sparkSession.createDataFrame([(lang, i, totals[lang]) for i, lang in enumerate(languages)], "lang string, i int, total long")
    known = counted.join(F.broadcast(known), "lang")  # a row for each language
    reached = sum((F.col("n") >= F.col("total") * F.lit(share)).cast("int") for share in SHARES)
    byte = known.select(
        "gram",
        F.floor(F.col("i") / 8).cast("int").alias("word"),
        F.expr("(i % 8) * 8").alias("shift"),
        reached.alias("reached"),
    )
    byte = byte.withColumn("mask", F.expr("shiftleft(shiftleft(2L, reached) - 1L, shift)"))
    masks = byte.groupBy("gram", "word").agg(F.bit_or("mask").alias("mask"))
    placed = masks.mapInArrow(partial(_place, bits=bits), "slot long, word int, mask long")
    table = placed.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    filled = np.zeros((1 << bits, words), dtype="<i8")
    filled[table["slot"].to_numpy(), table["word"].to_numpy()] = table["mask"].to_numpy()
    return LanguageFilter(languages, np.ascontiguousarray(filled.view(np.uint8)[:, : len(languages)]))


def _decide(texts: pa.Array, learned: LanguageFilter) -> tuple[np.ndarray, np.ndarray]:
    """The number of the language of each text, one past the last for none, and its score."""
    found = learned.corrected_counts(texts)
    total = found.sum(axis=1)
    top = found.argmax(axis=1)
    score = np.where(total > 0, found[np.arange(len(top)), top] / np.maximum(total, 1e-9), 0.0)
    letters = pa.compute.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
    nothing = ~letters.astype(bool)
    top[nothing] = len(learned.languages)
    score[nothing] = 0.0
    return top, np.clip(score, 0, 1)


def _predict(batches, learned):
    names = np.array([*learned.value.languages, UNKNOWN], dtype=object)
    for batch in batches:
        for part in text_slices(batch, "text"):
            top, score = _decide(part.column("text"), learned.value)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names[top], pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )


def _keep(batches, learned):
    for batch in batches:
        for part in text_slices(batch, "text"):
            top, score = _decide(part.column("text"), learned.value)
            yield part.filter(pa.array((top < len(learned.value.languages)) & (score > 0)))


def predict_language(docs: DataFrame, training: DataFrame | None = None, parts: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``.

    The filter learns from ``training`` (doc_id, text, lang; ``docs`` if left out) without the rows
    of the held-out fold. ``und`` for null texts and texts without a letter, with score 0. Ties go
    to the first language by name. Without any training row every text is ``und``. A null id is
    not held out, nor learned from. An empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    source = docs if training is None else training
    learned = fit(source.where(fold("doc_id", parts) != held_out))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    if learned is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    learned = spark.sparkContext.broadcast(learned)  # bounded, see fit
    return rows.mapInArrow(partial(_predict, learned=learned), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known_language(docs: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """``docs`` without texts that no language is found for: null, no letter, or no known n-gram.

    An empty table gives no rows; further columns stay as they are.
    """
    learned = fit(docs.where(fold("doc_id", parts) != held_out))
    if learned is None:
        return docs.where("false")
    learned = docs.sparkSession.sparkContext.broadcast(learned)  # bounded, see fit
    return docs.mapInArrow(partial(_keep, learned=learned), docs.schema)
