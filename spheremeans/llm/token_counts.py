"""Token counts of whole texts; huge ones in overlapping chunks that resynchronise.

A huge text is encoded in chunks with offsets, each chunk beginning inside the one before.
Two neighbours are spliced at a boundary that both have at the same place of the text and
that is proven stable: the tokenizer's rules never join anything across it, whatever stands around.
Such are places after white space, on both sides of a digit, and where a letter meets a sign that
no contraction, special string or combining mark can begin with, either way round. Where an overlap
holds no such place it is widened; where a whole chunk holds none, the chunk is doubled,
so that a text costs a few times its length at most, however long its words are.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices
from .tokens import default_path, tokenizer, word_counter
from .words import bytes_of

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 16384
OVERLAP = 64
HUGE = 49152

# Characters that stay letters, and ones that stay signs, in every form of Unicode text,
# lower-cased or composed. Latin, Cyrillic, Arabic, Devanagari, kana, ideographs, Hangul.
_LETTERS = r"A-Za-z\u0410-\u044F\u0621-\u063A\u0905-\u0939\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"
_SIGNS = r"!\"#$%&()*+,\-./:;=?@\[\\\]\^_`{}~\u060C\u061F\u0964\u3001\u3002\u300C\u300D\uFF01\uFF08\uFF09\uFF0C\uFF1A\uFF1B\uFF1F"
_STABLE = re.compile(
    rf"(?<=[ \t\n\x0b\x0c\r])|(?<=[0-9])|(?=[0-9])|(?<=[{_LETTERS}])(?=['{_SIGNS}])|(?<=[{_SIGNS}])(?=[{_LETTERS}])"
)


def _chunk_tokens(path: str, text: str, begin: int, end: int) -> np.ndarray:
    """Where in the text each token of text[begin:end] starts, and one entry for the end."""
    found = tokenizer(path).encode(text[begin:end], add_special_tokens=False)
    return np.array([a for a, _ in found.offsets], dtype=np.int64) + begin


def stable_places(text: str, low: int, high: int) -> np.ndarray:
    """Places in [low, high), low above 0, across which nothing is ever joined."""
    found = (m.start() + low - 1 for m in _STABLE.finditer(text[low - 1 : high]))
    return np.array([p for p in found if low <= p < high], dtype=np.int64)


def count_huge(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length, holding one chunk's tokens and the next's."""
    total, counted_from, step = 0, 0, overlap
    end = min(len(text), chunk)
    tokens = _chunk_tokens(path, text, 0, end)
    while end < len(text):
        nxt = max(counted_from, end - step)
        # A chunk's own ends may cut a word, so the splice keeps inside on both sides.
        places = stable_places(text, nxt + 1, end)
        if len(places):
            nxt_end = min(len(text), nxt + max(chunk, 2 * (end - nxt)))
            after = _chunk_tokens(path, text, nxt, nxt_end)
            common = np.intersect1d(np.intersect1d(places, tokens), after)
            if len(common):
                place = int(common[0])
                total += int(((tokens >= counted_from) & (tokens < place)).sum())
                counted_from, tokens, end, step = place, after, nxt_end, overlap
                continue
        if nxt == counted_from:  # the overlap is all that is left of the chunk: double it
            end = min(len(text), counted_from + 2 * (end - counted_from))
            tokens = _chunk_tokens(path, text, counted_from, end)
        step *= 4
    return total + int((tokens >= counted_from).sum())


def _count(batches, path: str, limit: int, huge: int, chunk: int, overlap: int):
    counter = word_counter(path)
    for batch in batches:
        for part in text_slices(batch, "text", 8 << 20):
            texts = part.column("text").fill_null("")
            _, at = bytes_of(texts)
            n_bytes = np.diff(at)
            big = n_bytes > huge
            small = pa.compute.if_else(pa.array(big), pa.scalar("", texts.type), texts)
            counts = counter.count(small)
            for i in np.flatnonzero(big):
                counts[i] = count_huge(path, texts[int(i)].as_py(), chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_bytes), pa.array(counts), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    limit: int = LIMIT,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each row of ``docs`` (doc_id, text).

    Null texts count as empty: no bytes, no tokens. Null and repeated ids keep their rows;
    other columns are not read. Texts over ``huge`` bytes go by chunks of ``chunk`` characters.
    """
    work = partial(
        _count, path=tokenizer_path or default_path(TOKENIZER), limit=limit, huge=huge, chunk=chunk, overlap=overlap
    )
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
