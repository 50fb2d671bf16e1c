"""Token ids and token counts of whole texts, as a public tokenizer file gives them."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import units_of, word_strings

os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core

#: Split rule of byte-level BPE. Fixed value.
_BYTE_BPE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


LONGEST_KEPT = 64  # bytes of a unit that a memo keeps; longer ones, such as texts without spaces, seldom return


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for the 256 bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """A byte-level BPE file for ``tokenizers``, run by ``tiktoken``, which is five times faster.

    Ids are the file's and equal to the other library's: in such a file an id is also the
    rank of its merge. Special strings inside a text become their id, as is the default there.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("bytes", pat_str=_BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens=special)


class WordCounter:
    """Token counts by a tokenizer that drops white space and ignores case.

    Its split rule never joins across white space nor from a letter to an ASCII sign, so a
    text's count is the sum over such units. The library counts each unit that the memo lacks, which
    holds ``most_units`` of at most ``LONGEST_KEPT`` bytes and those of one call; texts holding ``<|``, where special tokens could start, are encoded whole.
    """

    def __init__(self, path: str, most_units: int = 500_000):
        self.path, self.most_units = path, most_units
        self.known: dict[bytes, int] = {}

    def count_whole(self, texts: list[str]) -> np.ndarray:
        found = tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(map(len, found), dtype=np.int64, count=len(texts))

    def count(self, texts: pa.Array) -> np.ndarray:
        texts = texts.fill_null("")
        whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False).astype(bool)
        plain = pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts) if whole.any() else texts
        units = units_of(plain)
        coded = word_strings(units).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > self.most_units:
            self.known = {}
        known = self.known
        sizes = np.fromiter((known.get(u, -1) for u in distinct), dtype=np.int64, count=len(distinct))
        new = np.flatnonzero(sizes < 0)
        for i in range(0, len(new), 4096):
            these = new[i : i + 4096]
            names = [distinct[j] for j in these]
            found = self.count_whole([n.decode() for n in names])
            sizes[these] = found
            known.update((n, k) for n, k in zip(names, found.tolist(), strict=True) if len(n) <= LONGEST_KEPT)
        upto = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy()])]) if len(distinct) else np.zeros(1, np.int64)
        counts = upto[units.first[1:]] - upto[units.first[:-1]]
        if whole.any():
            where = np.flatnonzero(whole)
            counts[where] = self.count_whole(texts.take(pa.array(where)).to_pylist())
        return counts


_counters: dict[str, WordCounter] = {}


def word_counter(path: str) -> WordCounter:
    """One for each Python worker, so the memo outlives a task."""
    return _counters.setdefault(path, WordCounter(path))


