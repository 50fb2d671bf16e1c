"""Exact duplicates by content-defined chunks and recipes.

A text (A-Z in lower case) is cut where a rolling hash of its last 32 bytes says so, so equal
passages give equal chunks wherever they stand. A chunk's identifier is a digest, verified
by comparing the bytes of all chunks that share it; should two contents share one, longer
digests and at last the bytes themselves take over. A text's recipe is the ordered list of
its identifiers. Equal recipes are equal texts, so only recipes are compared from there on:
each chunk's bytes move once at most, after copies within a task have been merged.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, carries, cut, text_slices
from .words import bytes_of, fold_case, mix

LEAST, MOST = 256, 16384
MASK = np.uint32((1 << 11) - 1)  # a boundary about every 2,048 bytes
_WINDOW_STEPS = 5  # 2**5 bytes
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def boundaries(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end, by the last 32 bytes alone."""
    sums = _GEAR[data]
    for k in range(_WINDOW_STEPS):
        step = 1 << k
        shifted = sums[:-step] << np.uint32(step)
        sums = sums.copy()
        sums[step:] += shifted
    # The top bits see all 32 bytes.
    return np.flatnonzero((sums >> np.uint32(21)) & MASK == 0) + 1


def chunk_ends(size: int, candidates: np.ndarray) -> list[int]:
    """Ends of the chunks of a text, given candidate places relative to its start."""
    ends, begin = [], 0
    for place in candidates.tolist():
        while place - begin > MOST:
            begin += MOST
            ends.append(begin)
        if place - begin >= LEAST and place < size:
            ends.append(place)
            begin = place
    while size - begin > MOST:
        begin += MOST
        ends.append(begin)
    if size:
        ends.append(size)
    return ends


def _identifier(chunk: bytes, digest_bytes: int) -> bytes:
    """digest_bytes 0: the chunk itself."""
    if not digest_bytes:
        return chunk
    return hashlib.blake2b(chunk, digest_size=digest_bytes).digest()


def _texts(part: pa.RecordBatch):
    """The folded bytes and the chunks of each text of a part."""
    data, at = bytes_of(part.column("text"))
    data = fold_case(data)
    places = boundaries(data)
    spans = np.searchsorted(places, at, side="right")
    raw = data.tobytes()
    for i in range(part.num_rows):
        own = raw[at[i] : at[i + 1]]
        ends = chunk_ends(len(own), places[spans[i] : spans[i + 1]] - at[i])
        yield own, [own[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _recipes(batches, digest_bytes: int):
    for batch in batches:
        for part in text_slices(batch, "text"):
            sha, recipe = [], []
            for own, chunks in _texts(part):
                sha.append(hashlib.sha256(own).hexdigest())
                names = [_identifier(c, digest_bytes) for c in chunks]
                recipe.append(b"".join(len(c).to_bytes(4, "big") + n for c, n in zip(chunks, names, strict=True)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sha), pa.array(recipe, pa.binary())],
                names=["doc_id", "text_sha256", "recipe"],
            )


def _chunks(batches, digest_bytes: int):
    for batch in batches:
        for part in text_slices(batch, "text"):
            found = {c: _identifier(c, digest_bytes) for _, chunks in _texts(part) for c in chunks}
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.values(), pa.binary()), pa.array(found.keys(), pa.binary())],
                names=["identifier", "chunk"],
            )


def identifiers_are_verified(texts: DataFrame, digest_bytes: int) -> bool:
    """Does every identifier stand for one content? Compares all chunks' bytes."""
    if not digest_bytes:
        return True
    chunks = texts.mapInArrow(partial(_chunks, digest_bytes=digest_bytes), "identifier binary, chunk binary")
    distinct = chunks.distinct()
    shared = distinct.groupBy("identifier").agg(F.count("*").alias("n")).where("n > 1")
    return shared.isEmpty()


def chunk_recipes(docs: DataFrame, digests: tuple[int, ...] = (16, 32, 0)) -> DataFrame:
    """doc_id, text_sha256 (of the folded text), recipe: lengths and identifiers in order."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    digest = next(d for d in digests if identifiers_are_verified(texts, d))
    return texts.mapInArrow(
        partial(_recipes, digest_bytes=digest), "doc_id long, text_sha256 string, recipe binary"
    )


def find_duplicates(docs: DataFrame, digests: tuple[int, ...] = (16, 32, 0)) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``.

    Null and empty texts are equal. Of equal texts the row with the largest doc_id stays (null
    is the smallest; of rows that repeat an id, one). An empty table gives no rows.
    """
    # The row number is stored with the recipes, so it tells apart rows that are equal in everything.
    recipes = cut(chunk_recipes(docs, digests).withColumn("_at", F.monotonically_increasing_id()))
    groups = recipes.groupBy(F.col("recipe").alias("_recipe")).agg(
        F.max(F.struct("doc_id", "_at")).alias("_stays"), F.count("*").alias("group_size")
    )
    rows = recipes.join(groups, recipes["recipe"] == groups["_recipe"])
    return rows.select(
        "doc_id",
        F.col("_stays.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("_at") == F.col("_stays._at")).alias("kept"),
        "text_sha256",
    )


@carries("doc_id", "text")
def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that do not stay, in which rows that repeat an id once stay once.

    Nulls, empty texts and an empty table are as in ``find_duplicates``; further columns stay as they are.
    Rows meet the decisions by id and digest; those that stay are moved once, after copies within a task have been merged.
    """
    columns = docs.columns
    stay = find_duplicates(docs).where("kept").select(F.col("doc_id").alias("_d"), F.col("text_sha256").alias("_sha"))
    folded = F.translate(F.coalesce(docs["text"], F.lit("")), UPPER, LOWER)
    rows = docs.withColumn("_own", F.sha2(folded.cast("binary"), 256))
    rows = rows.join(stay, rows["doc_id"].eqNullSafe(stay["_d"]) & (rows["_own"] == stay["_sha"]), "left_semi")
    # Of rows with one id and text the least by all columns stays; each task sends one of them at most.
    least = rows.groupBy("doc_id", "_own").agg(F.min(F.struct(*(F.col(c) for c in columns if c != "doc_id"))).alias("_row"))
    return least.select(*(F.col("doc_id") if c == "doc_id" else F.col("_row").getField(c).alias(c) for c in columns))
