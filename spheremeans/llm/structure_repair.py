"""Least-cost repair of conversations, audits ranked by prefix doubling.

A conversation's rows are read with edits (keep, rerole, delete, insert) so that their role
initials become ``(s?(ua)+)?``. Where one stands is (row, what came last); every edit is an
arc with a cost and a letter. Costs to the end come from a backward pass; arcs that lie on
cheapest ways are optimal. Those are ranked by the first letter of the least audit that they begin,
then by 2, 4, 8 ... letters: the rank of an arc and the rank of the arc that its pointer, doubled
each time, reaches make the next rank. The least-ranked arc of each node is taken, and the
doubled pointers give the whole way in logarithmically many steps. A node's arcs carry
different letters, so letters of a least audit fix its nodes and one pointer an arc is enough.

Conversations are cut into blocks of ``BLOCK`` rows, so a long one is not one task's work. A
block's costs from each entry to each exit form a small matrix; one pass over the matrices of
a conversation, from its end, gives what each exit costs, after which blocks are solved apart;
one pass over their exits, from the start, tells where each block is entered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .turns import digest, hash_in_order, number_rows

BLOCK = 256
CELLS = 1 << 15  # rows that are solved at once

# What the edits cost, and a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Fixed value: white space; a text of nothing else is blank.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

# Kinds of role initials; faults; letters, in the order of their characters.
OTHER, S, U, A = range(4)
NONE, DELETED, CUT_SHORT = range(3)
END, D, I, K, R = range(5)
LETTERS = np.array(["", "D", "I", "K", "R"])

# What came last: nothing, s, u or a. What an inserted or reroled row makes of it.
NEXT = np.array([2, 2, 3, 2])
KEPT = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])  # by what came last and kind
ACCEPTED = (0, 3)
LEGAL = {(S, U), (U, A), (A, U)}
FAR = 1 << 50


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32(conv_id:turn) % 20; nulls are one space."""
    c = conversations.select(
        *(conversations[n].cast("long").alias(n) for n in ("conv_id", "turn")),
        *(F.coalesce(conversations[n].cast("string"), F.lit(" ")).alias(n) for n in ("role", "text")),
    )
    name = F.concat(*(F.coalesce(x.cast("string"), F.lit(" ")) for x in (F.col("conv_id"), F.lit(":"), F.col("turn"))))
    c = c.withColumn("_kind", F.crc32(name.cast("binary")) % 20).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


# Arithmetic on blocks of equal length. codes: blocks x rows, kind + 4 * fault.


def _row_costs(codes: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Cost of what an undeleted row i adds, FAR where it must go; and its kind."""
    fault = codes[:, i] // 4
    return np.where(fault == DELETED, FAR, np.where(fault == CUT_SHORT, TRUNCATED, 0)), codes[:, i] % 4


def _inserted(base: np.ndarray) -> np.ndarray:
    """Costs after as many inserts as pay; more than three come back to where they began."""
    best = base
    for _ in range(3):
        best = np.minimum(base, INSERT + best[:, NEXT])
    return np.minimum(best, FAR)


def costs_to_go(codes: np.ndarray, last: bool, after: np.ndarray) -> np.ndarray:
    """blocks x (rows + 1) x 4: least cost from each place to the end, given that of the exits."""
    blocks, n = codes.shape
    out = np.full((blocks, n + 1, 4), FAR, dtype=np.int64)
    if last:
        out[:, n, list(ACCEPTED)] = 0
        out[:, n] = _inserted(out[:, n])
    else:
        out[:, n] = after
    for i in range(n - 1, -1, -1):
        stays, kind = _row_costs(codes, i)
        base = DELETE + out[:, i + 1]
        base = np.minimum(base, (REROLE + stays)[:, None] + out[:, i + 1][:, NEXT])
        for came in range(4):
            to = KEPT[came][kind]
            kept = np.where(to >= 0, stays + out[np.arange(blocks), i + 1, to], FAR)
            base[:, came] = np.minimum(base[:, came], kept)
        out[:, i] = _inserted(base)
    return out


def least_audits(codes: np.ndarray, last: bool, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Audits (letters, 0 after the end), exits and costs for each block and entry."""
    blocks, n = codes.shape
    cost = costs_to_go(codes, last, after)
    places = n + 1
    node = np.arange(blocks * places * 4).reshape(blocks, places, 4)
    to = np.repeat(node[..., None], 5, axis=3)  # by letter; an arc of END stays where it is
    price = np.full(to.shape, FAR, dtype=np.int64)
    to[..., I] = node[:, :, NEXT]
    price[..., I] = INSERT + cost[:, :, NEXT]
    if not last:
        price[:, n, :, I] = FAR  # these belong to the next block
    for i in range(n):
        stays, kind = _row_costs(codes, i)
        to[:, i, :, D], price[:, i, :, D] = node[:, i + 1], DELETE + cost[:, i + 1]
        to[:, i, :, R], price[:, i, :, R] = node[:, i + 1][:, NEXT], (REROLE + stays)[:, None] + cost[:, i + 1][:, NEXT]
        for came in range(4):
            at = KEPT[came][kind]
            can = at >= 0
            to[can, i, came, K] = node[can, i + 1, at[can]]
            price[can, i, came, K] = stays[can] + cost[can, i + 1, at[can]]
    optimal = (price == cost[..., None]) & (cost[..., None] < FAR)
    optimal[..., END] = ~optimal.any(axis=3)
    if last:
        accepted = np.zeros(cost.shape, dtype=bool)
        accepted[:, n, list(ACCEPTED)] = True
        optimal[accepted] = False
        optimal[..., END] |= accepted

    # Rank the optimal arcs by ever more letters.
    arcs = np.flatnonzero(optimal)
    number = np.full(optimal.size, -1)
    number[arcs] = np.arange(len(arcs))
    own, target = arcs // 5, to.ravel()[arcs]
    rank = arcs % 5
    first_of = np.searchsorted(own, np.arange(blocks * places * 4))  # arcs of a node lie together

    def least(rank: np.ndarray) -> np.ndarray:
        """The least-ranked arc of each node."""
        lowest = np.minimum.reduceat(rank, first_of)
        hit = np.flatnonzero(rank == lowest[own])
        best = np.empty(len(first_of), dtype=np.int64)
        best[own[hit][::-1]] = hit[::-1]
        return best

    letter = rank.copy()
    pointer = least(rank)[target]
    pointers, length = [], (letter > 0).astype(np.int64)
    while True:
        pointers.append(pointer)
        grown = length + length[pointer]
        if (grown == length).all():
            break
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
        length, pointer = grown, pointer[pointer]
    start = least(rank)[node[:, 0]]
    steps = int(length[start].max(initial=0))
    at = np.repeat(start[..., None], steps + 1, axis=2)
    for k, jump in enumerate(pointers):
        far = (np.arange(steps + 1) >> k) & 1 == 1
        at[..., far] = jump[at[..., far]]
    end = own[at[..., -1]]  # the arcs after the end are END arcs of the exit
    exits = end % 4
    spent = cost[:, 0] - (0 if last else np.take_along_axis(cost[:, n], exits, axis=1))
    return letter[at], exits, spent


def _by_shape(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Row numbers, codes and last, for rows of one length, some thousand codes at once."""
    lists, last = batch.column("codes"), batch.column("last").to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    values, sizes = lists.values.to_numpy(), np.diff(offsets)
    for n in np.unique(sizes):
        for is_last in (False, True):
            rows = np.flatnonzero((sizes == n) & (last == is_last))
            for some in np.array_split(rows, max(1, -(-len(rows) * int(n) // CELLS))):
                if len(some):
                    yield some, values[offsets[some][:, None] + np.arange(n)].astype(np.int64), is_last


def _list_array(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(rows.ravel(), kind))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from each entry to each exit (the end, repeated, for a last block)."""
    for batch in batches:
        spans = np.full((batch.num_rows, 16), FAR, dtype=np.int64)
        for rows, codes, last in _by_shape(batch):
            for way_out in range(4):
                after = np.full((len(rows), 4), FAR, dtype=np.int64)
                after[:, way_out] = 0
                spans[rows, way_out::4] = costs_to_go(codes, last, after)[:, 0]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), _list_array(spans, pa.int64())], names=["conv_id", "block", "spans"]
        )


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each exit costs to the end. Blocks of a conversation come from its end."""
    conv, begun, rest = None, False, None
    for batch in batches:
        out = []
        for c, spans in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not begun or c != conv:
                rest = np.zeros(4, dtype=np.int64)  # a last block has its end inside
            conv, begun = c, True
            out.append(rest)
            rest = np.minimum((np.array(spans).reshape(4, 4) + rest).min(axis=1), FAR)
        after = _list_array(np.array(out, dtype=np.int64).reshape(-1, 4), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), after], names=["conv_id", "block", "after"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits, exits and costs by entry, illegal neighbours, first and last kind of each block."""
    for batch in batches:
        m = batch.num_rows
        given = [x or [0] * 4 for x in batch.column("after").to_pylist()]
        after = np.array(given, dtype=np.int64).reshape(m, 4)
        audits, exits, costs = [None] * m, np.zeros((m, 4), np.int64), np.zeros((m, 4), np.int64)
        illegal, ends = np.zeros(m, np.int64), np.zeros((m, 2), np.int64)
        legal = np.zeros((4, 4), dtype=bool)
        for a, b in LEGAL:
            legal[a, b] = True
        for rows, codes, last in _by_shape(batch):
            letters, exits[rows], costs[rows] = least_audits(codes, last, after[rows])
            text = LETTERS[letters]
            for j, r in enumerate(rows):
                audits[r] = ["".join(x) for x in text[j]]
            kinds = codes % 4
            illegal[rows] = (~legal[kinds[:, :-1], kinds[:, 1:]]).sum(axis=1)
            ends[rows] = kinds[:, [0, -1]]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "block", "codes", "last")),
                pa.array(audits, pa.list_(pa.string())),
                _list_array(exits, pa.int64()),
                _list_array(costs, pa.int64()),
                pa.array(illegal),
                _list_array(ends, pa.int64()),
            ],
            names=["conv_id", "block", "codes", "last", "audits", "exits", "costs", "illegal", "ends"],
        )


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each block of a conversation is entered, and whether its first row follows illegally."""
    conv, begun, entry, before = None, False, 0, None
    for batch in batches:
        entries, seams = [], []
        for c, exits, ends in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
            if not begun or c != conv:
                entry, before = 0, None
            conv, begun = c, True
            entries.append(entry)
            seams.append(int(before is not None and (before, ends[0]) not in LEGAL))
            entry, before = exits[entry], ends[1]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(entries, pa.int64()), pa.array(seams, pa.int64())],
            names=["conv_id", "block", "entry", "seam"],
        )


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """nth, rank and role of what stays or is put in; no rank: put in, no role: the row's own."""
    for batch in batches:
        at, nth, rank, role = [], [], [], []
        columns = [batch.column(c).to_pylist() for c in ("block", "codes", "audit", "entry")]
        for j, (block, codes, audit, entry) in enumerate(zip(*columns, strict=True)):
            row, came = 0, entry
            for letter in audit:
                reads = letter != "I"
                row += reads
                if letter == "D":
                    continue
                came = int(KEPT[came][codes[row - 1] % 4]) if letter == "K" else int(NEXT[came])
                at.append(j)
                nth.append(len(nth))
                rank.append(block * BLOCK + row if reads else None)
                role.append(None if letter == "K" else "user" if came == U else "assistant")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id").take(pa.array(at, pa.int64())),
                batch.column("block").take(pa.array(at, pa.int64())),
                pa.array(nth, pa.int64()),
                pa.array(rank, pa.int64()),
                pa.array(role, pa.string()),
            ],
            names=["conv_id", "block", "nth", "rank", "to_role"],
        )


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Joins on columns that carry a leading underscore on the other side; null equals null."""
    condition = F.lit(True)
    for n in names:
        condition &= a[n].eqNullSafe(b[f"_{n}"])
    return condition


def _under(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"_{n}" for n in names})


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation, and the repaired rows.

    rows: conv_id, turn, role and text, roles and texts not null; further columns, whatever their
    names, take no part. Rows are taken by turn, nulls first, equal turns by role and a digest
    of the text. A null conv_id is a conversation like any other. An empty table gives none.

    The first has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; the second
    conv_id, block, nth, role, text, in that order within a conversation.
    """
    trimmed = F.rtrim("text", F.lit(SPACE))
    read = rows.select(
        "conv_id", "turn", "role", "text",
        digest(F.col("role"), F.col("text")).alias("same"),
        (F.length(trimmed) == 0).alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("short"),
    )
    numbered = number_rows(read, "conv_id", ["turn", "role", "same"])
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    narrow = numbered.select("conv_id", "turn", "rank", "same", "blank", "short", kind.alias("kind"))
    firsts = narrow.groupBy("conv_id", "same").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    firsts = _under(firsts.where("n > 1").drop("n"), "conv_id", "same")
    judged = narrow.join(firsts, _same(narrow, firsts, "conv_id", "same"), "left")
    again = F.coalesce(F.col("first") < F.col("rank"), F.lit(False))
    judged = judged.select(
        "conv_id", "turn", "rank", "kind", "blank",
        (~F.col("blank") & again).alias("duplicate"), (~F.col("blank") & ~again & F.col("short")).alias("truncated"),
    )
    judged = cut(judged)

    wide = lambda c: F.col(c).cast("decimal(38,0)")  # noqa: E731  turns may lie further apart than 64 bits
    found = judged.groupBy("conv_id").agg(
        F.max("rank").alias("n"),
        *(F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.countDistinct("turn").alias("turns"),
    )
    gaps = F.least(wide("high") - wide("low") + 1 - F.col("turns"), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    gaps = F.when(F.col("turns") > 0, gaps).otherwise(F.lit(0).cast("long"))
    found = cut(found.withColumn("gaps", gaps).drop("low", "high", "turns"))

    fault = F.when(F.col("blank") | F.col("duplicate"), DELETED).when(F.col("truncated"), CUT_SHORT).otherwise(NONE)
    coded = judged.select("conv_id", F.expr(f"(rank - 1) div {BLOCK}").alias("block"), "rank", (F.col("kind") + 4 * fault).alias("code"))
    blocks = coded.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("rank", "code"))).alias("codes"))
    lengths = _under(found.select("conv_id", "n"), "conv_id")
    blocks = blocks.join(lengths, _same(blocks, lengths, "conv_id"))
    last = F.col("block") == F.expr(f"(n - 1) div {BLOCK}")
    blocks = cut(blocks.select("conv_id", "block", F.col("codes.code").alias("codes"), last.alias("last")))

    many = "NOT (last AND block = 0)"
    spans = blocks.where(many).mapInArrow(_spans, "conv_id long, block long, spans array<long>")
    back = spans.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    after = _under(back.mapInArrow(_back, "conv_id long, block long, after array<long>"), "conv_id", "block")
    solved = blocks.join(after, _same(blocks, after, "conv_id", "block"), "left").select("conv_id", "block", "codes", "last", "after")
    solved = cut(
        solved.mapInArrow(
            _solve,
            "conv_id long, block long, codes array<int>, last boolean, audits array<string>, exits array<long>, "
            "costs array<long>, illegal long, ends array<long>",
        )
    )
    ways = solved.where(many).select("conv_id", "block", "exits", "ends").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    ways = _under(ways.mapInArrow(_forward, "conv_id long, block long, entry long, seam long"), "conv_id", "block")
    chosen = solved.join(ways, _same(solved, ways, "conv_id", "block"), "left")
    entry = F.coalesce(F.col("entry"), F.lit(0).cast("long")).cast("int")
    chosen = chosen.select(
        "conv_id", "block", "codes", entry.alias("entry"),
        F.get("audits", entry).alias("audit"), F.get("costs", entry).alias("cost"),
        (F.col("illegal") + F.coalesce("seam", F.lit(0))).alias("illegal"),
    )

    mended = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    mended = _under(mended, "conv_id")
    report = found.join(mended, _same(found, mended, "conv_id"))
    report = report.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = chosen.select("conv_id", "block", "codes", "audit", "entry").mapInArrow(
        _edits, "conv_id long, block long, nth long, rank long, to_role string"
    )
    texts = _under(numbered.select("conv_id", "rank", "role", "text"), "conv_id", "rank")
    same = edits["conv_id"].eqNullSafe(texts["_conv_id"]) & (edits["rank"] == texts["_rank"])
    repaired = edits.join(texts, same, "left").select(
        "conv_id", "block", "nth", F.coalesce("to_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return report, repaired


def repair_report(originals: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``originals``: the report on ``rows`` and repaired_sha256."""
    report, repaired = repair_conversations(rows)
    line = F.concat("role", F.lit(":"), "text")
    hashes = hash_in_order(repaired.select("conv_id", "block", "nth", line.alias("line")), "conv_id", ["block", "nth"], "line", "\n")
    ids = originals.select(originals["conv_id"].cast("long").alias("conv_id")).distinct()
    report, hashes = _under(report, "conv_id"), _under(hashes, "conv_id")
    out = ids.join(report, _same(ids, report, "conv_id"), "left").drop("_conv_id")
    out = out.join(hashes, _same(out, hashes, "conv_id"), "left")
    return out.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
