"""Near-duplicates by ProbMinHash over weighted shingles, banding and verification.

A text is its five-word shingles (ASCII white space apart, A-Z in lower case); a shorter text
with words is one shingle. A shingle that occurs n times weighs 1 + ln n, so that one
line repeated a hundred times does not make texts alike that share nothing else. Two texts
are linked when the probability Jaccard similarity of their weights is at least
``threshold``; for texts that repeat no shingle this is the Jaccard similarity. Classes are
connected by links.

Sketch: every shingle is a Poisson process whose rate is its weight. Its arrivals come from its
hash, each at a time and in one of m registers; a register keeps the shingle that arrives
first. A text is done when no further arrival can come before its last register's. Registers
agree between two texts with the probability Jaccard similarity.

Links are found without expanding groups of copies:

1. Equal word sequences are one node.
2. Nodes meet in buckets of equal bands. Every bucket has a hub, its node with most company,
   and each node is verified against the hub it shares most bands with: one pair for a node.
3. What is still apart within a bucket after joining verified links is compared register by
   register inside the task, in blocks of bounded size. The largest class of a bucket stays in its
   blocks and meets the others there, so one odd node costs one row for each block. Where an estimate comes within four
   standard errors of the threshold, the two texts meet in a task of the same block and are
   verified there. Pairs are no rows; only links come out.

Verification recomputes the shingles of both whole texts and their exact similarity.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_PATTERN, carries, cut, text_slices
from .words import mix, shingle_hashes, words_of

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 6, 30  # a pair at 0.8 shares a band with probability 0.9999
BLOCK = 2048


def weighted_shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of text and hash: hash, text, weight."""
    words = words_of(texts)
    h, d = shingle_hashes(words.hashes(), words.first, size)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(fresh)
    return h[at], d[at], 1.0 + np.log(np.diff(np.append(at, len(h))))


def sketch(n: int, h: np.ndarray, d: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
    """n x m: the shingle each register keeps; zeros for texts without shingles."""
    first = np.full(n * m, np.inf)
    kept = np.zeros(n * m, dtype=np.uint64)
    time = np.zeros(len(h))
    nth = 0
    while len(h):
        nth += 1
        draw = mix(h + np.uint64(nth * 0x9E3779B97F4A7C15 % (1 << 64)))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        time = time + gap / weight
        register = ((mix(draw) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        place = d * m + register.astype(np.int64)
        np.minimum.at(first, place, time)
        won = first[place] == time
        kept[place[won]] = h[won]
        open_docs = np.unique(d)
        last = np.full(n, -1.0)
        last[open_docs] = first.reshape(n, m)[open_docs].max(axis=1)
        alive = time < last[d]
        h, d, weight, time = h[alive], d[alive], weight[alive], time[alive]
    return kept.reshape(n, m)


def probability_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Sum over shared i of 1 / sum_j max(a_j / a_i, b_j / b_i); hashes sorted and distinct."""
    if not len(ha) or not len(hb):
        return 0.0
    shared, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    union = len(ha) + len(hb) - len(shared)
    if wa.max() == wa.min() and wb.max() == wb.min():
        return len(shared) / union
    a, b = wa[ia], wb[ib]
    ratio = a / b
    order = np.argsort(-ratio)
    a, b, ratio = a[order], b[order], ratio[order]
    only_a, only_b = wa.sum() - a.sum(), wb.sum() - b.sum()
    # max(a_j / a_i, b_j / b_i) is the first where a_j / b_j >= a_i / b_i.
    above = np.cumsum(a)[np.searchsorted(-ratio, -ratio, side="right") - 1]
    below = np.concatenate([np.cumsum(b[::-1])[::-1], [0.0]])[np.searchsorted(-ratio, -ratio, side="right")]
    return float((1.0 / ((above + only_a) / a + (below + only_b) / b)).sum())


def _node(words, hashes: np.ndarray) -> list[bytes | None]:
    """128 bits for each text's word sequence; null without words."""
    n = len(words.first) - 1
    nth = (np.arange(len(hashes)) - words.first[:-1][words.doc]).astype(np.uint64)
    out = np.zeros((n, 2), dtype=np.uint64)
    for k, seed in enumerate((0xA24BAED4963EE407, 0x9FB21C651E98DF25)):
        upto = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix(hashes ^ mix(nth + np.uint64(seed))), out=upto[1:])
        out[:, k] = upto[words.first[1:]] - upto[words.first[:-1]]
    raw = out.astype(">u8").tobytes()
    some = np.diff(words.first) > 0
    return [raw[16 * i : 16 * i + 16] if some[i] else None for i in range(n)]


def _sketches(batches, rows: int, bands: int, size: int):
    m = rows * bands
    for batch in batches:
        for part in text_slices(batch, "text"):
            texts = part.column("text")
            words = words_of(texts)
            nodes = _node(words, words.hashes())
            kept = sketch(part.num_rows, *weighted_shingles(texts, size), m)
            names = np.zeros((part.num_rows, bands), dtype=np.uint64)
            for b in range(bands):
                for r in range(rows):
                    names[:, b] = mix(names[:, b] * np.uint64(0x9E3779B97F4A7C15) + kept[:, b * rows + r] + np.uint64(b + 1))
            short = (mix(kept) >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(nodes, pa.binary()),
                    pa.array([names[i].view(np.int64) for i in range(len(nodes))], pa.list_(pa.int64())),
                    pa.array([short[i].tobytes() for i in range(len(nodes))], pa.binary()),
                ],
                names=["doc_id", "node", "bands", "registers"],
            )


def _nodes_of(batches):
    for batch in batches:
        for part in text_slices(batch, "text"):
            words = words_of(part.column("text"))
            nodes = pa.array(_node(words, words.hashes()), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), nodes, part.column("text")], names=["doc_id", "node", "text"])


def _similar(batches, threshold: float, size: int):
    for batch in batches:
        for part in text_slices(batch, "text_a", 1 << 20):
            sides = []
            for column in ("text_a", "text_b"):
                h, d, w = weighted_shingles(part.column(column), size)
                sides.append((h, w, np.searchsorted(d, np.arange(part.num_rows + 1))))
            (ha, wa, ca), (hb, wb, cb) = sides
            ok = [
                probability_jaccard(ha[ca[i] : ca[i + 1]], wa[ca[i] : ca[i + 1]], hb[cb[i] : cb[i + 1]], wb[cb[i] : cb[i + 1]]) >= threshold
                for i in range(part.num_rows)
            ]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])


def verify(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole texts (node, text) reach the threshold."""
    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.select("a", "b", "text_a", "text_b")
    return both.mapInArrow(partial(_similar, threshold=threshold, size=size), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable over edges (a, b), for every node with an edge.

    Each round hooks every node to its smallest neighbour and contracts; edges within a
    class vanish, so a round has fewer than the one before.
    """
    edges = cut(edges.where("a <> b").select("a", "b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
        low = cut(low.select("node", F.least("node", "other").alias("low")))
        if labels is None:
            labels = low.withColumnRenamed("low", "comp")
        else:
            step = low.select(F.col("node").alias("comp"), "low")
            labels = labels.join(step, "comp", "left").select("node", F.coalesce("low", "comp").alias("comp"))
        labels = cut(labels)
        to_a = low.select(F.col("node").alias("a"), F.col("low").alias("na"))
        to_b = low.select(F.col("node").alias("b"), F.col("low").alias("nb"))
        moved = edges.join(to_a, "a").join(to_b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
        edges = cut(moved.where("a <> b").distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return labels


def _with_comp(frame: DataFrame, column: str, comps: DataFrame, name: str) -> DataFrame:
    """``frame`` with the class of ``column``; a node without a link is its own."""
    known = comps.select(F.col("node").alias(column), F.col("comp").alias("_comp"))
    return frame.join(known, column, "left").withColumn(name, F.coalesce("_comp", column)).drop("_comp")


def join_classes(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after further links (a, b): classes are contracted, not built anew."""
    ends = _with_comp(_with_comp(links, "a", comps, "ca"), "b", comps, "cb")
    joined = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    step = joined.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    moved = comps.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    alone = joined.join(comps.select("node"), "node", "left_anti")
    return cut(moved.unionAll(alone))


class _Block:
    """The nodes of one bucket, or of two parts of one, and which pairs may reach the threshold."""

    def __init__(self, table: pa.Table, m: int, least: float):
        self.node = table["node"].combine_chunks()
        _, self.comp = np.unique(table["comp"].to_numpy(), return_inverse=True)
        self.block = table["block"].to_numpy()
        self.i, self.j = table["i"][0].as_py(), table["j"][0].as_py()
        earlier = table["earlier"].combine_chunks()
        self.earlier = earlier.flatten().to_numpy().reshape(len(self.node), -1) if len(earlier.flatten()) else None
        self.s = np.frombuffer(b"".join(table["registers"].to_pylist()), dtype=np.uint8).reshape(len(self.node), m)
        self.least = least * m

    def candidates(self):
        """For each x of the smaller part the others of a different class whose registers agree often enough."""
        first, second = np.flatnonzero(self.block == self.i), np.flatnonzero(self.block == self.j)
        if len(first) > len(second):
            first, second = second, first
        for x in first:
            rest = second[(self.comp[second] != self.comp[x]) & ((self.i != self.j) | (second > x))]
            if not len(rest):
                continue
            good = rest[(self.s[rest] == self.s[x]).sum(axis=1) >= self.least]
            if self.earlier is not None:
                # A pair is looked at in the first band whose whole name it shares, and in no other bucket.
                good = good[~(self.earlier[good] == self.earlier[x]).any(axis=1)]
            if len(good):
                yield int(x), good


def _with_candidates(table: pa.Table, m: int, least: float) -> pa.Table:
    """The rows of a block that have a candidate in it."""
    keep = np.zeros(table.num_rows, dtype=bool)
    for x, others in _Block(table, m, least).candidates():
        keep[x] = True
        keep[others] = True
    return table.filter(pa.array(keep))


def _links_in_block(table: pa.Table, m: int, least: float, threshold: float, size: int) -> pa.Table:
    """Verified links that join what is apart; pairs already joined in this block are skipped."""
    block = _Block(table, m, least)
    top = np.arange(int(block.comp.max(initial=-1)) + 1)
    parts = []
    for chunk in table.select(["text"]).to_batches():
        for part in text_slices(chunk, "text"):
            h, d, w = weighted_shingles(part.column("text"), size)
            cuts = np.searchsorted(d, np.arange(part.num_rows + 1))
            parts += [(h[a:b], w[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    out_a, out_b = [], []
    for x, others in block.candidates():
        for y in others.tolist():
            a, b = top[block.comp[x]], top[block.comp[y]]
            if a != b and probability_jaccard(*parts[x], *parts[y]) >= threshold:
                top[top == max(a, b)] = min(a, b)
                out_a.append(x)
                out_b.append(y)
    return pa.table({"a": block.node.take(pa.array(out_a, pa.int64())), "b": block.node.take(pa.array(out_b, pa.int64()))})


def in_blocks(hits: DataFrame, registers: DataFrame, comps: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of buckets that hold several classes, once for each pair of parts that they are compared in.

    A bucket's largest class and its other nodes are dealt to parts of about ``block`` nodes. Parts of
    the largest class meet only parts of others, and those each other. With r nodes of other classes
    among n, that is about n * (r / block + 1) + r * n / block rows.
    """
    placed = _with_comp(hits.select("bucket", "band", "node"), "node", comps, "comp")
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    placed = cut(placed.join(mixed, "bucket", "left_semi"))
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    split = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("n"))
    split = split.select(
        "bucket",
        F.col("most.comp").alias("main"),
        F.ceil(F.col("most.n") / block).cast("int").alias("mains"),
        F.ceil((F.col("n") - F.col("most.n")) / block).cast("int").alias("odds"),
    )
    rows = placed.join(split, "bucket").join(registers, "node")
    names = F.slice("bands", F.lit(1), F.col("band")) if "bands" in registers.columns else F.array().cast("array<long>")
    stays = F.col("comp") == F.col("main")
    place = F.xxhash64("node")
    rows = rows.withColumns(
        {
            "earlier": names,
            "block": F.when(stays, F.pmod(place, F.col("mains"))).otherwise(F.col("mains") + F.pmod(place, F.col("odds"))).cast("int"),
            "other": F.explode(F.sequence(F.when(stays, F.col("mains")).otherwise(0), F.col("mains") + F.col("odds") - 1)),
        }
    )
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return rows.select("bucket", "band", "i", "j", "block", "node", "comp", "registers", "earlier")


def links_still_missing(
    hits: DataFrame,
    registers: DataFrame,
    texts: DataFrame,
    comps: DataFrame,
    m: int,
    bands: int,
    threshold: float,
    size: int = SHINGLE,
    block: int = BLOCK,
) -> DataFrame:
    """a, b: links between different classes that share a bucket, enough to join them.

    hits: bucket, band, node. registers: node, registers, and bands, the names of all bands; a pair
    is then compared in the first band it shares only, without them in every one. Only buckets that hold several classes are looked at, and only
    texts with a candidate travel. Pairs never leave the task that compares them.
    """
    rows = in_blocks(hits, registers, comps, block)
    least = threshold - 4 * (threshold * (1 - threshold) / m) ** 0.5
    keys = ["bucket", "i", "j"]
    some = rows.groupBy(*keys).applyInArrow(lambda t: _with_candidates(t, m, least), rows.schema)
    some = cut(some).join(texts, "node")
    return some.groupBy(*keys).applyInArrow(
        lambda t: _links_in_block(t, m, least, threshold, size), "a binary, b binary"
    )


def _members(docs: DataFrame, threshold: float, size: int, rows: int, bands: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, node, comp of each row with words, and doc_id, node of all rows (a null node without words)."""
    m = rows * bands
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    sketched = cut(
        narrow.mapInArrow(
            partial(_sketches, rows=rows, bands=bands, size=size),
            "doc_id long, node binary, bands array<long>, registers binary",
        )
    )
    members = sketched.select("doc_id", "node")
    nodes = sketched.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("registers").alias("registers")
    )
    nodes = cut(nodes)

    in_band = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = in_band.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    hits = cut(in_band.join(shared, "bucket"))
    company = hits.groupBy("node").agg(F.sum("n").alias("company"))
    with_company = hits.join(company, "node")
    hubs = with_company.groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("hub"))
    stars = hits.join(hubs, "bucket").where("node <> hub.node").groupBy("node", "hub").agg(F.count("*").alias("bands"))
    best = stars.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("bands", "hub")).getField("hub").getField("node").alias("b"))
    best = cut(best)

    # Texts of nodes with company only, one for each node.
    wanted = company.join(nodes.select("node", "rep"), "node").select("node", "rep")
    texts = narrow.mapInArrow(_nodes_of, "doc_id long, node binary, text string")
    texts = texts.join(wanted, (texts["node"] == wanted["node"]) & texts["doc_id"].eqNullSafe(wanted["rep"]), "left_semi")
    texts = cut(texts.select("node", "text").dropDuplicates(["node"]))

    comps = components(verify(best, texts, threshold, size))
    missing = links_still_missing(hits, nodes.select("node", "registers", "bands"), texts, comps, m, bands, threshold, size)
    comps = join_classes(comps, missing)

    return _with_comp(members.where("node is not null"), "node", comps, "comp"), members


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """doc_id, class_id, class_size: one row for each row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id of the class. Texts without words (null, empty) are alike to
    nothing: each is a class of its own. A null id belongs to its text's class, and is
    itself null where the class has no other. Repeated rows count as rows.
    """
    joined, members = _members(docs, threshold, size, rows, bands)
    classes = joined.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    alone = members.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return joined.join(classes, "comp").select("doc_id", "class_id", "class_size").unionAll(alone)


def _with_node(batches):
    for batch in batches:
        for part in text_slices(batch, "text"):
            words = words_of(part.column("text"))
            nodes = pa.array(_node(words, words.hashes()), pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, nodes], names=[*part.schema.names, "_node"])


@carries("doc_id", "text")
def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id; ids may repeat or be null.

    A class without any id keeps one row too, and every row without words stays. Of rows with
    the same id and words the first in column order stays. An empty table gives no rows;
    further columns stay as they are.
    """
    columns = docs.columns
    joined, _ = _members(docs, THRESHOLD, SHINGLE, ROWS, BANDS)
    first = joined.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("_first"))
    stay = first.select(F.col("_first.doc_id").alias("_d"), F.col("_first.node").alias("_n"))
    worded = F.coalesce(docs["text"].cast("string").rlike(WORD_PATTERN), F.lit(False))
    schema = T.StructType([*docs.schema.fields, T.StructField("_node", T.BinaryType())])
    named = docs.where(worded).mapInArrow(_with_node, schema)
    same = (named["_node"] == stay["_n"]) & named["doc_id"].cast("long").eqNullSafe(stay["_d"])
    kept = named.join(stay, same, "left_semi").groupBy("doc_id", "_node").agg(F.min(F.struct(*columns)).alias("_row"))
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in columns)).unionAll(docs.where(~worded))
