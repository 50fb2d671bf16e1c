"""Best-fit packing of documents into sequences, planned on a histogram of lengths.

1. Every document becomes token ids and an end id. One longer than a sequence is cut; its
   first piece takes the remainder and the others are full.
2. Pieces are counted by length: at most ``capacity`` counts, whatever the corpus.
3. Best-fit decreasing runs on the counts. All bins with the same content are one group, so
   the plan has a row for each group and length, not for each piece.
4. The i-th piece of a length takes the i-th planned place of that length. Ranks come from
   ranges of (length, id, piece, a stored row number), numbered apart, so neither a length nor an
   id or its absence that a third of all pieces share is anybody's single task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ranked, text_slices
from .tokens import byte_bpe, default_path

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"

PLAN = "length int, first long, places long, per_bin long, bin long, offset long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids: the pieces of every document.

    Whole texts; null is the empty text, which has the end id alone. Null and repeated doc_id
    are pieces like others. No document makes more rows than its tokens need.
    """

    def cut_up(batches):
        encode = byte_bpe(tokenizer).encode_to_numpy
        for batch in batches:
            for part in text_slices(batch, "text"):
                doc_ids = part.column("doc_id")
                rows, piece, start, length, crc, flat = [], [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    own = np.append(encode(text or "", allowed_special="all"), end_id).astype("<u4")
                    at, number, step = 0, 0, len(own) % capacity or capacity
                    while at < len(own):
                        these = own[at : at + step]
                        rows.append(i)
                        piece.append(number)
                        start.append(at)
                        length.append(step)
                        crc.append(zlib.crc32(these.tobytes()))
                        flat.append(these)
                        at, number, step = at + step, number + 1, capacity
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.ListArray.from_arrays(offsets, np.concatenate(flat).astype(np.int32)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(cut_up, schema)


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for pieces: (length, first, places, per_bin, bin, offset), as in ``PLAN``.

    Pieces ``first`` to ``first + places - 1`` of a length go to bins from ``bin`` on,
    ``per_bin`` in each, the first at ``offset``. Longest pieces first, each into the fullest
    bin that has room; equal bins are handled together.
    """
    room: list[tuple[int, int, int]] = []  # sorted: room left, first bin, bins
    rows, bins = [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit {capacity}")
        left, first = counts[length], 0
        while left:
            i = bisect_left(room, (length, -1, -1))
            if i < len(room):
                free, at, many = room.pop(i)
            else:
                free, at = capacity, bins
                many = max(1, left // (capacity // length))
                bins += many
            each = min(free // length, left)
            used = min(many, left // each)
            rows.append((length, first, used * each, each, at, capacity - free))
            left -= used * each
            first += used * each
            if free > each * length:
                insort(room, (free - each * length, at, used))
            if used < many:
                insort(room, (free, at + used, many - used))
    return rows


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, cell_rows: int | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset.

    ``pieces`` is read three times and has no column whose name begins with an underscore; hand over something stored. The plan goes to the tasks
    whole: its size depends on the lengths in use, at most ``capacity``, not on the rows.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.createDataFrame(plan_best_fit(counts, capacity), PLAN)
    tied = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    placed = ranked(pieces, ["length"], tied, "_place", cell_rows)

    # Each length's places in one row, so that a piece meets one row and looks its place up.
    table = plan.groupBy(F.col("length").cast("long").alias("_l")).agg(
        F.sort_array(F.collect_list(F.struct("first", "places", "per_bin", "bin", F.col("offset").alias("at")))).alias("_places")
    )
    found = placed.join(F.broadcast(table), placed["length"] == table["_l"]).drop("_l")
    found = found.withColumn(
        "_to", F.expr("filter(_places, p -> _place >= p.first and _place < p.first + p.places)[0]")
    ).drop("_places")
    nth = F.col("_place") - F.col("_to.first")
    return found.withColumns(
        {
            "sequence_id": F.col("_to.bin") + F.floor(nth / F.col("_to.per_bin")),
            "offset": F.col("_to.at") + nth % F.col("_to.per_bin") * F.col("length"),
        }
    ).drop("_place", "_to")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Nulls, empty texts and repeated ids are as in ``token_pieces``; an empty table gives no rows, and further
    columns are not read.
    """
    pieces = token_pieces(docs, tokenizer or default_path(TOKENIZER), capacity)
    if not with_ids:
        pieces = pieces.drop("ids")
    return place_pieces(cut(pieces), capacity)
