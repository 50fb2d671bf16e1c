"""The tree of conversation prefixes, by ternary search trees over ranges of sorted sequences.

Turns are encoded by a dictionary of (role, text). A conversation is cut into segments of
``SEGMENT`` turns, each a short sequence of ids below the node where the segment before it
ended, so that no row or task holds a whole long conversation. Segments are sorted by
range; each run of ``RUN`` sorted segments is one shard, whose ternary search tree is filled
by inserting the median first and is walked once, children before parents, for members,
leaves and savings.

Only nodes on the way to a shard's first or last sequence can go on in another shard, and only
those above a further segment lack a part of their subtree. They are merged by key: sums of
what each shard found below them, what merged nodes add to the merged nodes above, and what
later segments add. For the last, each node or finished subtree of a later segment is
counted for one of its members, and summed along that conversation, from its end, for every segment.
All other nodes are final when they leave their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .turns import digest, hash_in_order, number_rows

MOST_HEAD = 8
FAMILY = 5

SEGMENT = 16
RUN = 20_000
IDS_PER_PIECE = 4096
SEGMENTS_PER_BLOCK = 4096

_START = b"\0" * 16
_NODES = (
    "open boolean, key binary, parent_key binary, up array<binary>, seg long, depth long, conv_id long, "
    "parent_conv_id long, size long, members long, ends long, kids long, leaves long, saved long, sha string, "
    "first long, piece string"
)


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (its length), depth (from 1), id, size: the turns of all rebuilt conversations.

    A conversation without turns has one row whose depth, id and size are null.
    """
    rows = conversations.select(
        *(conversations[c].cast(kind).alias(c) for c, kind in (("conv_id", "long"), ("turn", "long"))),
        *(F.coalesce(conversations[c].cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    ).where("conv_id IS NOT NULL")
    rows = rows.select(
        "conv_id", "turn", digest(F.col("role"), F.col("text")).alias("symbol"), F.octet_length("text").cast("long").alias("size")
    )
    numbered = number_rows(rows, "conv_id", ["turn", "symbol"])
    words = cut(numbered.select("symbol").distinct().select("symbol", F.monotonically_increasing_id().alias("id")))
    turns = cut(numbered.join(words, "symbol").select("conv_id", "rank", "id", "size"))

    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)
    first = F.when(F.col("rank") <= MOST_HEAD, F.struct("rank", "id", "size"))
    convs = turns.groupBy("conv_id").agg(F.max("rank").alias("_n"), F.sort_array(F.collect_list(first)).alias("_firsts"))
    asked = convs.select("conv_id", "_n", head.alias("_h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_base"))
    bases = convs.select(F.col("conv_id").alias("_b"), "_firsts")
    asked = asked.join(bases, F.col("_base") == F.col("_b"), "left")
    taken = F.coalesce(F.slice("_firsts", F.lit(1), F.col("_h").cast("int")), F.array().cast("array<struct<rank:long,id:long,size:long>>"))
    asked = asked.select("conv_id", "_n", "_h", taken.alias("_taken"))
    own = F.greatest(F.col("_n") - F.col("_h"), F.lit(0))
    asked = asked.select("conv_id", "_h", "_taken", F.size("_taken").alias("_k"), (F.size("_taken") + own).cast("long").alias("n"))

    heads = asked.where("_k > 0 OR n = 0").select("conv_id", "n", F.explode_outer("_taken").alias("t"))
    heads = heads.select("conv_id", "n", F.col("t.rank").alias("depth"), "t.id", "t.size")
    later = turns.where(F.col("rank") > head).join(asked.select("conv_id", "_h", "_k", "n"), "conv_id")
    later = later.select("conv_id", "n", (F.col("_k") + F.col("rank") - F.col("_h")).alias("depth"), "id", "size")
    return heads.unionByName(later)


def _blocked(df: DataFrame, columns: dict[str, Column], forward: bool) -> DataFrame:
    """Running aggregates of a conversation's segments, without the row's own, in two steps.

    Blocks of segments are aggregated first, so one task sees a row for each block of a
    conversation, or the segments of one block.
    """
    around = (Window.unboundedPreceding, -1) if forward else (1, Window.unboundedFollowing)
    block = F.floor(F.col("seg") / SEGMENTS_PER_BLOCK)
    df = df.withColumn("_block", block)
    blocks = df.groupBy(F.col("conv_id").alias("_c"), F.col("_block").alias("_b")).agg(*(a.alias(f"_{n}") for n, a in columns.items()))
    over = Window.partitionBy("_c").orderBy("_b").rowsBetween(*around)
    kind = "bit_xor" if forward else "sum"
    blocks = blocks.select("_c", "_b", *(F.expr(f"{kind}(_{n})").over(over).alias(f"_{n}") for n in columns))
    inside = Window.partitionBy("conv_id", "_block").orderBy("seg").rowsBetween(*around)
    df = df.withColumns({f"_in_{n}": a.over(inside) for n, a in columns.items()})
    df = df.join(blocks, (df["conv_id"] == blocks["_c"]) & (df["_block"] == blocks["_b"]))
    none = F.lit(0).cast("long")
    for n in columns:
        a, b = F.coalesce(f"_in_{n}", none), F.coalesce(f"_{n}", none)
        df = df.withColumn(n, a.bitwiseXOR(b) if forward else a + b)
    return df.drop("_block", "_c", "_b", *(f"_{n}" for n in columns), *(f"_in_{n}" for n in columns))


def _segments(turns: DataFrame) -> DataFrame:
    """conv_id, seg, n, start, next, ids, sizes, more.

    ``start`` names the turns before the segment, ``next`` those up to its end: 128 bits, the
    exclusive or of hashes of (segment number, ids).
    """
    whole = F.col("depth").isNotNull()
    item = F.when(whole, F.struct("depth", "id", "size"))
    seg = F.coalesce(F.floor((F.col("depth") - 1) / SEGMENT), F.lit(0)).cast("long")
    cuts = turns.groupBy("conv_id", seg.alias("seg")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))
    cuts = cuts.select("conv_id", "seg", "n", F.col("items.id").alias("ids"), F.col("items.size").alias("sizes"))
    cuts = cut(cuts.withColumns({f"own{k}": F.xxhash64(F.lit(k), "seg", "ids") for k in (1, 2)}))
    short = cuts.where(F.col("n") <= SEGMENT).withColumns({f"at{k}": F.lit(0).cast("long") for k in (1, 2)})
    long = _blocked(cuts.where(F.col("n") > SEGMENT), {f"at{k}": F.bit_xor(f"own{k}") for k in (1, 2)}, forward=True)
    found = short.unionByName(long)
    name = lambda *lanes: F.unhex(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in lanes)))
    return found.select(
        "conv_id", "seg", "n",
        name(F.col("at1"), F.col("at2")).alias("start"),
        name(*(F.col(f"at{k}").bitwiseXOR(F.col(f"own{k}")) for k in (1, 2))).alias("next"),
        "ids", "sizes",
        (F.col("n") > (F.col("seg") + 1) * SEGMENT).alias("more"),
    )


def _keys(start: bytes, after: bytes, ids: list[int]) -> list[bytes]:
    """Names of the nodes on a segment's way, its top first."""
    keys, running = [start], hashlib.blake2b(start, digest_size=16)
    for level, i in enumerate(ids, 1):
        running.update(i.to_bytes(8, "little", signed=True))
        keys.append(after if level == SEGMENT else running.copy().digest())
    return keys


class TernaryTree:
    """A ternary search tree; node 0 stands above all, links to absent nodes are 0.

    Children are always made after their parents, so walking nodes backwards meets children first.
    """

    def __init__(self) -> None:
        self.symbol, self.low, self.high, self.equal, self.parent = [0], [0], [0], [0], [0]

    def insert(self, symbols: list[int]) -> list[int]:
        """The nodes on the way of ``symbols``."""
        at, way = 0, []
        for s in symbols:
            links, holder, node = self.equal, at, self.equal[at]
            while node and self.symbol[node] != s:
                links = self.low if s < self.symbol[node] else self.high
                holder, node = node, links[node]
            if not node:
                node = len(self.symbol)
                for column, value in ((self.symbol, s), (self.low, 0), (self.high, 0), (self.equal, 0), (self.parent, at)):
                    column.append(value)
                links[holder] = node
            way.append(node)
            at = node
        return way

    def below(self, own, add, none) -> list:
        """For each node what ``add`` makes of its children's totals, a total being own plus below."""
        n = len(self.symbol)
        beside, under = [none] * n, [none] * n  # beside: a node's total with those at its low and high side
        for t in range(n - 1, -1, -1):
            if self.equal[t]:
                under[t] = beside[self.equal[t]]
            total = add(own(t), under[t])
            for side in (self.low[t], self.high[t]):
                if side:
                    total = add(total, beside[side])
            beside[t] = total
        return under


def median_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            todo += [(middle + 1, b), (a, middle)]


def _shard(rows: list[tuple]) -> Iterator[tuple]:
    """Rows of ``_NODES`` for sorted segments (seg, start, next, ids, sizes, conv_id, more)."""
    tops: list[tuple[int, bytes]] = []
    runs: list[list[int]] = []  # first and last row of equal segments
    for at, (seg, start, _, ids, *_) in enumerate(rows):
        if not tops or tops[-1] != (seg, start):
            tops.append((seg, start))
        elif rows[runs[-1][0]][3] == ids:
            runs[-1][1] = at + 1
            continue
        runs.append([at, at + 1, len(tops) - 1])

    tree, ways = TernaryTree(), [[]] * len(runs)
    for r in median_first(len(runs)):
        ways[r] = tree.insert([runs[r][2], *rows[runs[r][0]][3]])
    n = len(tree.symbol)
    stop, go_on, least, example = [0] * n, [0] * n, [None] * n, [0] * n
    for way, (a, b, _) in zip(ways, runs, strict=True):
        for node in way:
            example[node] = a  # any segment that passes
        going = sum(r[6] for r in rows[a:b])
        stop[way[-1]], go_on[way[-1]], least[way[-1]] = b - a - going, going, rows[a][5]

    def smaller(x, y):
        return y if x is None else x if y is None else min(x, y)

    under = tree.below(
        lambda t: (stop[t] + go_on[t], go_on[t], least[t]),
        lambda x, y: (x[0] + y[0], x[1] + y[1], smaller(x[2], y[2])),
        (0, 0, None),
    )
    members = [stop[t] + go_on[t] + under[t][0] for t in range(n)]
    smallest = [smaller(least[t], under[t][2]) for t in range(n)]
    is_open = [go_on[t] + under[t][1] > 0 for t in range(n)]
    level, top = [-1] * n, [0] * n
    for t in range(1, n):  # parents come first
        level[t] = level[tree.parent[t]] + 1
        top[t] = top[tree.parent[t]] if level[t] else tree.symbol[t]
        is_open[t] |= level[t] == 0
    for way in (ways[0], ways[-1]):
        for node in way:
            is_open[node] = True

    def size_of(t):
        return rows[example[t]][4][level[t] - 1] if level[t] > 0 else 0

    def own(t):
        """Leaves and savings of a final node; those of open ones are known after the merge."""
        if is_open[t] or t == 0:
            return (0, 0)
        return (int(members[t] == stop[t]), (members[t] - 1) * size_of(t))

    sums = tree.below(own, lambda x, y: (x[0] + y[0], x[1] + y[1]), (0, 0))
    kids = [0] * n
    for t in range(1, n):
        kids[tree.parent[t]] += not is_open[t]

    stops = {way[-1]: (a, b) for way, (a, b, _) in zip(ways, runs, strict=True)}
    names: dict[int, bytes] = {}

    def name(t):
        if t not in names:
            row = rows[example[t]]
            names[t] = _keys(row[1], row[2], row[3][: level[t]])[-1]
        return names[t]

    for t in range(1, n):
        seg, parent = tops[top[t]][0], tree.parent[t]
        depth = seg * SEGMENT + level[t]
        if level[t] == 0 and seg > 0:  # the node itself is in the segment before
            yield (True, name(t), None, None, seg, depth, None, None, None, 0, 0, kids[t], 0, 0, None, None, None)
            continue
        a, b = stops.get(t, (0, 0))
        ids = [r[5] for r in rows[a:b] if not r[6]]
        if not is_open[t]:
            above = name(parent) if is_open[parent] else None
            (leaves, saved), (leaf, worth) = sums[t], own(t)
            yield (
                False, None, above, None, seg, depth, smallest[t], None if above else smallest[parent], None, members[t],
                stop[t], kids[t], leaves + leaf, saved + worth, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), None, None,
            )
            continue
        up, node = [], parent
        while node and level[node] >= (1 if seg else 0):
            up.append(name(node))
            node = tree.parent[node]
        yield (
            True, name(t), name(parent) if level[t] else None, up, seg, depth, smallest[t], None, size_of(t), members[t],
            stop[t], kids[t], *sums[t], None, None, None,
        )
        for k in range(0, len(ids), IDS_PER_PIECE):
            some = ids[k : k + IDS_PER_PIECE]
            yield (True, name(t), *[None] * 13, some[0], ",".join(map(str, some)))


def _schema() -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _NODES.split(", ")])


def _tries(run: int):
    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held = _schema(), []

        def flush(rows):
            out = list(_shard(rows))
            for k in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out[k : k + 10_000]], schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("seg", "start", "next", "ids", "sizes", "conv_id", "more")]
            held += zip(*columns, strict=True)
            while len(held) >= run:
                yield from flush(held[:run])
                held = held[run:]
        if held:
            yield from flush(held)

    return tries


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, leaves, saved for every node on the way of a segment with something after it."""
    for batch in batches:
        keys, leaves, saved = [], [], []
        for seg, start, after, ids, more_leaves, more_saved in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = _keys(start, after, ids)[1 if seg else 0 :]
            keys += own
            leaves += [more_leaves] * len(own)
            saved += [more_saved] * len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=["key", "leaves", "saved"]
        )


def prefix_trie(conversations: DataFrame, run: int = RUN) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    conversations: conv_id, turn, role and text; further columns, whatever their names, take no part.
    Turns of one number are ordered by a digest of role and text, so repeated rows are turns of
    their own. Rows without a conv_id belong to no conversation. A null role or text is empty.
    An empty table gives no rows, a conversation whose turns were all cut away is a member
    of the root only.
    """
    records = cut(_segments(rebuilt_turns(conversations)))
    sort = ["seg", "start", "ids", "conv_id"]
    nodes = cut(records.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(_tries(run), _NODES))
    final = nodes.where("NOT open")
    pieces = nodes.where("piece IS NOT NULL").select("key", "first", "piece")
    parts = nodes.where("open AND piece IS NULL")
    totals = [F.sum(c).alias(c) for c in ("members", "ends", "kids", "leaves", "saved")]
    merged = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("up").alias("up"), F.min("seg").alias("seg"), F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), *totals,
    )
    leaf, worth = (F.col("members") == F.col("ends")).cast("long"), (F.col("members") - 1) * F.col("size")
    merged = cut(merged.withColumns({"leaf": leaf, "worth": worth}))

    # What later segments add: to one conversation for each subtree, then along it from its end.
    for_one = merged.where("seg > 0").select("conv_id", "seg", F.col("leaf").alias("leaves"), F.col("worth").alias("saved"))
    whole = final.where("seg > 0 AND parent_key IS NOT NULL").select("conv_id", "seg", "leaves", "saved")
    for_one = for_one.unionByName(whole).groupBy("conv_id", "seg").agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
    long = records.where(F.col("n") > SEGMENT).join(for_one, ["conv_id", "seg"], "left").fillna(0, ["_l", "_s"])
    long = _blocked(long, {"leaves": F.sum("_l"), "saved": F.sum("_s")}, forward=False)
    later = long.where("more").select("seg", "start", "next", "ids", "leaves", "saved")
    later = later.mapInArrow(_ways, "key binary, leaves long, saved long")

    none = F.lit(0).cast("long")
    added = merged.select(F.explode(F.concat(F.array("key"), "up")).alias("key"), "leaf", "worth", none.alias("kids"))
    added = added.unionByName(later.select("key", F.col("leaves").alias("leaf"), F.col("saved").alias("worth"), none.alias("kids")))
    child = merged.where("parent_key IS NOT NULL").select(
        F.col("parent_key").alias("key"), none.alias("leaf"), none.alias("worth"), F.lit(1).cast("long").alias("kids")
    )
    added = added.unionByName(child).groupBy("key").agg(*(F.sum(c).alias(f"_{c}") for c in ("leaf", "worth", "kids")))

    owners = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    ends = hash_in_order(pieces, "key", ["first"], "piece", ",")
    split = merged.join(added, "key").join(ends, "key", "left").join(owners, "parent_key", "left")
    split = split.select(
        "conv_id", "depth", F.col("_parent").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        (F.col("kids") + F.col("_kids")).alias("n_children"), (F.col("leaves") + F.col("_leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("_worth")).alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    done = final.join(owners, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"),
    )
    return done.unionByName(split)
