"""Small and odd tables through every operator, and the parts that have a brute-force twin."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spheremeans.llm import common
from spheremeans.llm import exact_dedup as ed
from spheremeans.llm import language_id as li
from spheremeans.llm import language_model as lm
from spheremeans.llm import near_dedup as nd
from spheremeans.llm import token_counts, topk
from spheremeans.llm import toxicity as tx
from spheremeans.llm.common import cut, fold
from spheremeans.llm.language_id import predict_language
from spheremeans.llm.mixing import mix_documents, sample_copies, source_targets
from spheremeans.llm.packing import pack_documents, place_pieces, plan_best_fit
from spheremeans.llm.quality import score_quality
from spheremeans.llm.token_counts import count_huge, count_tokens
from spheremeans.llm.tokens import WordCounter, byte_bpe, default_path, tokenizer
from spheremeans.llm.toxicity import score_toxicity
from spheremeans.llm.words import shingle_hashes, units_of, words_of

WORD_BPE, BYTE_BPE = default_path("word_bpe_49k.json"), default_path("byte_bpe_50k.json")


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(" \n\tab.'sé́ Σ中<|1DMlLİ　 ") for _ in range(rng.randrange(60))) for _ in range(n)]


# words


def test_words_are_split_like_bytes_split():
    texts = ["", None, " a  B\tc\n", "é x y", *odd_texts(300)]
    words = words_of(pa.array(texts))
    for i, t in enumerate(texts):
        own = range(words.first[i], words.first[i + 1])
        got = [words.data[words.start[k] : words.end[k]].tobytes() for k in own]
        assert got == (t or "").encode().split()


def test_word_hashes_ignore_ascii_case_only():
    h = words_of(pa.array(["Abc abc ABC abd ÄB äb", "abc"])).hashes()
    assert len(set(h[[0, 1, 2, 6]].tolist())) == 1 and len(set(h.tolist())) == 4


def test_shingles_of_short_texts():
    words = words_of(pa.array(["", "a b", "a b c d e", "a b c d e f", "a b"]))
    h, d = shingle_hashes(words.hashes(), words.first, 5)
    assert d.tolist() == [1, 2, 3, 3, 4] and h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 3


# tokenizers


def test_byte_bpe_gives_the_ids_of_the_tokenizers_library():
    for t in [*odd_texts(500), "<|endoftext|> a", "x" * 5000, "a" + " " * 300 + "b"]:
        assert byte_bpe(BYTE_BPE).encode(t, allowed_special="all") == tokenizer(BYTE_BPE).encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("most_units", [10, 500_000])
def test_counts_by_units_are_whole_counts(most_units):
    texts = ["don't 'SO a1b2", "", *odd_texts(500)]
    counter = WordCounter(WORD_BPE, most_units)
    for _ in range(2):
        assert counter.count(pa.array(texts)).tolist() == counter.count_whole(texts).tolist()
    assert units_of(pa.array(["the, THE"])).first.tolist() == [0, 3]


@pytest.mark.parametrize("chunk, overlap", [(5, 1), (7, 2), (40, 8), (300, 7), (10**6, 64)])
def test_chunks_resynchronise(chunk, overlap):
    for t in [*odd_texts(80), "nospace" * 60, " ".join(odd_texts(40)), "a " * 400]:
        whole = len(tokenizer(WORD_BPE).encode(t, add_special_tokens=False).ids)
        assert count_huge(WORD_BPE, t, chunk, overlap) == whole


LONG_KINDS = {
    "letters": lambda rng, n: "".join(rng.choice("abcde") for _ in range(n)),
    "letters and digits": lambda rng, n: "".join(rng.choice("ab12") for _ in range(n)),
    "ideographs": lambda rng, n: "".join(rng.choice("中文字词語") for _ in range(n)),
    "ideographs and signs": lambda rng, n: "".join(rng.choice("中文字词語、中文字词語。") for _ in range(n)),
    "signs": lambda rng, n: "".join(rng.choice("!?'.-|<>") for _ in range(n)),
    "contractions": lambda rng, n: "".join(rng.choice(["'s", "x", "'", "'ll", "e\u0301", "İ", ".", "<|endoftext|>", "=\u0338"]) for _ in range(n)),
}


@pytest.mark.parametrize("kind", LONG_KINDS)
def test_chunks_without_white_space(kind):
    rng = random.Random(7)
    for n, chunk, overlap in [(300, 7, 2), (300, 40, 8), (2000, 64, 8), (60_000, 16384, 64)]:
        t = LONG_KINDS[kind](rng, n)
        assert count_huge(WORD_BPE, t, chunk, overlap) == len(tokenizer(WORD_BPE).encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("kind", ["letters", "letters and digits", "ideographs", "ideographs and signs"])
def test_long_texts_without_white_space_are_encoded_a_few_times_only(kind, monkeypatch):
    encoded = []
    real = token_counts._chunk_tokens
    monkeypatch.setattr(token_counts, "_chunk_tokens", lambda p, t, a, b: encoded.append(b - a) or real(p, t, a, b))
    t = LONG_KINDS[kind](random.Random(8), 1_000_000)
    assert count_huge(WORD_BPE, t) == len(tokenizer(WORD_BPE).encode(t, add_special_tokens=False).ids)
    assert sum(encoded) <= 3 * len(t)


def test_token_counts_of_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    got = count_tokens(docs, huge=1000).toPandas()
    assert len(got) == len(odd_rows)
    want = sorted((len((r[1] or "").encode()), len(tokenizer(WORD_BPE).encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows)
    assert sorted(zip(got.n_bytes, got.n_tokens, strict=True)) == want
    assert count_tokens(docs.limit(0)).count() == 0


# packing


def test_plan_places_every_piece_once():
    rng = random.Random(4)
    for kind in range(6):
        capacity = [1, 7, 64, 1024, 1024, 100][kind]
        counts = {rng.randint(1, capacity): rng.randint(1, 5000) for _ in range([1, 5, 40, 300, 1024, 3][kind])}
        taken = {}
        for length in counts:
            places = sorted((r[1], r[2]) for r in plan_best_fit(counts, capacity) if r[0] == length)
            assert places[0][0] == 0 and sum(n for _, n in places) == counts[length]
            assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
        for length, _, places, each, at, offset in plan_best_fit(counts, capacity):
            for q in range(places):
                taken.setdefault(at + q // each, []).append((offset + q % each * length, length))
        for bin_ in taken.values():
            end = 0
            for start, length in sorted(bin_):
                assert start == end
                end += length
            assert end <= capacity
        assert sorted(taken) == list(range(len(taken)))


def test_plan_is_close_to_the_least():
    rng = random.Random(5)
    counts = {n: rng.randint(1, 200) for n in range(1, 1025)}
    bins = max(r[4] + -(-r[2] // r[3]) for r in plan_best_fit(counts))
    assert bins <= sum(n * c for n, c in counts.items()) / 1024 * 1.01 + 1


def test_packing_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    got = pack_documents(docs, with_ids=True).toPandas()
    want = sorted(
        len(ids) for r in odd_rows for ids in [[*tokenizer(BYTE_BPE).encode(r[1] or "", add_special_tokens=False).ids, 2]]
    )
    assert got.length.sum() == sum(want)
    assert (got.ids.map(len) == got.length).all()
    assert all(zlib.crc32(np.array(i, "<u4").tobytes()) == c for i, c in zip(got.ids, got.ids_crc32, strict=True))
    places = got.groupby("sequence_id").apply(lambda g: sorted(zip(g.offset, g.length, strict=True)))
    for seq in places:
        assert seq[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(seq, seq[1:], strict=False))
    assert pack_documents(docs.limit(0)).count() == 0


def test_packing_ranks_do_not_depend_on_cells(spark):
    pieces = spark.range(3000).selectExpr("id % 40 AS doc_id", "int(id / 40) AS piece", "0L AS start", "1 + id % 7 AS length")
    got = place_pieces(pieces, capacity=16, cell_rows=50).toPandas()
    spots = set()
    for r in got.itertuples():
        cells = {(r.sequence_id, r.offset + k) for k in range(r.length)}
        assert not cells & spots
        spots |= cells
    assert len(got) == 3000 and got.sequence_id.nunique() == math.ceil(got.length.sum() / 16)


def test_ranks_split_a_group_of_equal_rows(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(common, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    rows = spark.range(60_000).selectExpr("if(id % 3 = 0, 'rare', null) AS source", "if(id % 3 = 0, id, null) AS doc_id")
    got = common.ranked(cut(rows), ["source"], ["doc_id"], "place", 2000).toPandas()
    for hot, n in (("rare", 20_000), (None, 40_000)):
        own = got[got.source.isna() if hot is None else got.source == hot]
        assert sorted(own.place) == list(range(n))
    rare = got[got.source == "rare"].sort_values("doc_id")
    assert rare.place.is_monotonic_increasing
    assert stored[0].groupBy("source", "_range").count().toPandas()["count"].max() <= 8000


def test_hot_rows_without_an_id(documents, spark):
    rows = [(None, "same text", "en", "s")] * 3000 + [(i, f"text {i % 50}", "en", "s") for i in range(300)]
    docs = documents(rows)
    packed = pack_documents(docs).toPandas()
    assert len(packed) == 3300 and not packed.duplicated(["sequence_id", "offset"]).any()
    found = ed.find_duplicates(docs).toPandas()
    assert found.kept.sum() == 51 and found.group_size.max() == 3000
    kept = ed.drop_duplicates(docs).toPandas()
    assert sorted(kept.text) == sorted({r[1] for r in rows}) and set(kept._own) == {"_own"} and set(kept._nth) == {"_nth"}
    drawn = sample_copies(docs, ["doc_id"]).toPandas()
    assert len(drawn) == 3300 and (drawn.copies * drawn["size"]).sum() == pytest.approx(1.5 * 6600, abs=4)
    assert mix_documents(docs).count() == drawn.copies.sum()


def test_mixing_tells_apart_rows_whose_nulls_stand_elsewhere(spark):
    kinds = "doc_id long, text string, source string, a string, b string"
    rows = [(None, "w", "s", "x", None), (None, "w", "s", None, "x"), (None, "w", None, "s", "x"), (None, None, "w", "s", "x")]
    mixed = mix_documents(spark.createDataFrame(rows * 4, kinds)).toPandas()
    assert {tuple(None if v != v else v for v in r) for r in mixed.itertuples(index=False)} >= {r for r in rows[:3]}


# exact duplicates


@pytest.mark.parametrize("digests", [(16, 32, 0), (1, 0), (1, 16), (0,)])
def test_exact_duplicates_of_odd_rows(documents, odd_rows, digests):
    extra = [(100 + i, f"Text {i % 7} " * 300, "en", "s") for i in range(60)] + [(200, "TEXT 1 " * 300, "en", "s")]
    got = ed.find_duplicates(documents(odd_rows + extra), digests).toPandas()
    assert len(got) == len(odd_rows + extra)
    fold_text = lambda t: (t or "").encode().lower()
    groups = {}
    for r in odd_rows + extra:
        groups.setdefault(fold_text(r[1]), []).append(r[0])
    assert got.kept.sum() == len(groups)
    best = {i: max((j for j in g if j is not None), default=None) for g in groups.values() for i in g if i is not None}
    for r in got.dropna(subset=["doc_id"]).itertuples():
        assert r.keep_id == best[r.doc_id]
    assert got[got.doc_id == 2].group_size.tolist() == [3]  # both empties, and the null row


def test_a_chunk_boundary_depends_on_what_is_near():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 122, 60_000).astype(np.uint8)
    ends = [ed.chunk_ends(len(x), ed.boundaries(x)) for x in (body, np.concatenate([body[:777], body]))]
    near_end = [{len(x) - e for e in es} for x, es in zip((body, np.concatenate([body[:777], body])), ends, strict=True)]
    assert len(near_end[0] & near_end[1]) > 0.8 * len(near_end[0])
    assert all(b - a <= ed.MOST for es in ends for a, b in zip([0, *es], es, strict=False))


def test_dropping_duplicates_keeps_columns(documents, odd_rows):
    docs = documents(odd_rows)
    got = ed.drop_duplicates(docs)
    assert got.columns == docs.columns
    assert got.count() == len({(r[1] or "").encode().lower() for r in odd_rows})
    assert ed.drop_duplicates(docs.limit(0)).count() == 0


# near-duplicates


def brute_jaccard(x, y):
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x.keys() & y.keys())


def test_probability_jaccard_and_its_sketch():
    rng = np.random.default_rng(0)
    for _ in range(20):
        pool = np.unique(rng.integers(1, 1 << 60, 60).astype(np.uint64))
        a, b = (np.sort(rng.choice(pool, n, replace=False)) for n in (40, 45))
        wa, wb = (rng.integers(1, 5, len(x)).astype(float) for x in (a, b))
        exact = brute_jaccard(dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True)))
        assert nd.probability_jaccard(a, wa, b, wb) == pytest.approx(exact)
    kept = nd.sketch(2, np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), np.concatenate([wa, wb]), 20_000)
    assert (kept[0] == kept[1]).mean() == pytest.approx(exact, abs=0.02)


def test_near_duplicates_of_chains_stars_and_odd_rows(documents, odd_rows):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    rows, chain = [], list(base)
    for i in range(60):  # each like the one before, the ends unlike each other
        rows.append((1000 + i, " ".join(chain), "en", "s"))
        chain[2 * i % 120] = word()
    for i in range(80):  # copies around the threshold
        own = list(base)
        for k in rng.sample(range(120), rng.randint(0, 12)):
            own[k] = word()
        rows.append((2000 + i, " ".join(own).upper() if i % 2 else " ".join(own), "en", "s"))
    rows += odd_rows
    got = nd.near_duplicates(documents(rows)).toPandas()
    assert len(got) == len(rows)
    texts = [r[1] for r in rows]
    h, d, w = nd.weighted_shingles(pa.array(texts))
    cuts = np.searchsorted(d, np.arange(len(texts) + 1))
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = slice(cuts[i], cuts[i + 1]), slice(cuts[j], cuts[j + 1])
            if nd.probability_jaccard(h[a], w[a], h[b], w[b]) >= 0.8:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    members = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            members.setdefault(top(i), set()).add(r[0])
    want = {frozenset(v) for v in members.values()}
    known = got.dropna(subset=["doc_id"])
    assert {frozenset(g) for g in known.groupby("class_id").doc_id.apply(set)} == want


@pytest.mark.parametrize("block", [4, 2048])
def test_blocks_of_a_large_bucket_meet(spark, block):
    """Alike texts spread over all blocks of a bucket end in one class, others do not."""
    rng = random.Random(2)
    base = [f"w{rng.random()}" for _ in range(100)]
    texts = []
    for i in range(30):
        own = list(base) if i < 25 else [f"v{rng.random()}" for _ in range(100)]
        own[i] = f"x{i}"  # 0.9 alike
        texts.append(" ".join(own))
    h, d, w = nd.weighted_shingles(pa.array(texts))
    kept = nd.sketch(30, h, d, w, 180)
    kept[:, :6] = kept[0, :6]  # all in one bucket, of the first band
    short = (nd.mix(kept) >> np.uint64(56)).astype(np.uint8)
    rows = [(bytes([i]), short[i].tobytes(), texts[i]) for i in range(30)]
    table = spark.createDataFrame(rows, "node binary, registers binary, text string")
    hits = table.select(F.lit(1).cast("long").alias("bucket"), F.lit(0).alias("band"), "node")
    comps = spark.createDataFrame([(bytes([i]), bytes([0])) for i in range(10)], "node binary, comp binary")
    found = nd.links_still_missing(hits, table.select("node", "registers"), table.select("node", "text"), comps, 180, 30, 0.8, block=block)
    got = {r[0][0]: r[1][0] for r in nd.join_classes(comps, found).collect()}
    assert got == {i: 0 for i in range(25)}


@pytest.mark.parametrize("odd", [1, 7])
def test_a_mixed_bucket_costs_rows_in_proportion(spark, odd):
    n, block = 600, 20
    node = lambda i: i.to_bytes(2, "big")
    table = spark.createDataFrame([(node(i), b"\0" * 180) for i in range(n)], "node binary, registers binary")
    hits = table.select(F.lit(1).cast("long").alias("bucket"), F.lit(0).alias("band"), "node")
    comps = spark.createDataFrame([(node(i), node(0)) for i in range(n - odd)], "node binary, comp binary")
    rows = [(r.i, r.j, r.block, r.node) for r in nd.in_blocks(hits, table, comps, block).collect()]
    mains = -(-(n - odd) // block)
    assert len(rows) == (n - odd) + odd * (mains + 1)  # the largest class travels once
    members: dict = {}
    for i, j, own, name in rows:
        members.setdefault((i, j), []).append((own, int.from_bytes(name, "big")))
    met = set()
    for (i, j), own in members.items():
        met |= {frozenset((x, y)) for p, x in own for q, y in own if (p, q) == (i, j) and x != y}
    want = {frozenset((x, y)) for x in range(n - odd, n) for y in range(n) if x != y}
    assert want <= met


def test_the_memo_of_token_counts_is_bounded_in_bytes():
    from spheremeans.llm.tokens import LONGEST_KEPT, WordCounter, default_path

    rng = random.Random(4)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000)) for _ in range(20)] + ["some short words", "x" * 65]
    counter = WordCounter(default_path("word_bpe_49k.json"), most_units=100)
    for _ in range(2):  # the same whether or not the memo knows a unit
        assert counter.count(pa.array(texts)).tolist() == counter.count_whole(texts).tolist()
    assert {b"some", b"short", b"words"} == set(counter.known) and LONGEST_KEPT == 64


def test_equal_digests_of_an_earlier_band_hide_no_pair(spark):
    texts = [" ".join(["a"] * 3 + [f"w{k}" for k in range(100)] + [last]) for last in "xy"]
    kept = nd.sketch(2, *nd.weighted_shingles(pa.array(texts)), 180)
    short = (nd.mix(kept) >> np.uint64(56)).astype(np.uint8)
    short[:, :12] = 1  # alike in the digests of the first band, whose names differ
    rows = [(bytes([i]), short[i].tobytes(), [i, 9] + [100 + i] * 28, texts[i]) for i in range(2)]
    table = spark.createDataFrame(rows, "node binary, registers binary, bands array<long>, text string")
    registers = table.select("node", "registers", "bands")
    none = spark.createDataFrame([], "node binary, comp binary")
    for band, links in ((1, 1), (2, 0)):  # the pair shares band 1, so it is not looked at in band 2
        hits = table.select(F.lit(9).cast("long").alias("bucket"), F.lit(band).alias("band"), "node")
        found = nd.links_still_missing(hits, registers, table.select("node", "text"), none, 180, 30, 0.8)
        assert found.count() == links


def test_one_row_of_each_near_class_stays(documents, odd_rows):
    def text(seed, n=40):
        rng = random.Random(seed)
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(100)) for _ in range(n))

    rows = [
        *((None, text(i)) for i in range(5)),  # no ids, all different
        (None, text(0).upper()),
        (2, text(10)),
        (5, text(10) + " more"),  # a near copy of 2, under an id that stands for another class
        (5, text(11)),
        (6, text(11)),
    ]
    got = nd.drop_near_duplicates(documents(rows)).collect()
    kept = sorted((-1 if r.doc_id is None else r.doc_id, r.text.lower()) for r in got)
    assert kept == sorted([*((-1, text(i)) for i in range(5)), (2, text(10)), (5, text(11))])
    got = nd.drop_near_duplicates(documents(odd_rows)).select("doc_id", "text").collect()
    want = [r[:2] for r in odd_rows if r[0] != 5]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_components(spark):
    rng = random.Random(7)
    name = [rng.randbytes(8) for _ in range(500)]  # nodes are hashes, so chains shrink fast
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)]
    edges = [(name[a], name[b]) for a, b in edges]
    got = {bytes(r[0]): bytes(r[1]) for r in nd.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    parent = {x: x for e in edges for x in e}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert got == {i: top(i) for e in edges if e[0] != e[1] for i in e}


def test_classes_grow_by_further_links(spark):
    node = lambda i: bytes([i])
    comps = nd.components(spark.createDataFrame([(node(1), node(2)), (node(5), node(6))], "a binary, b binary"))
    more = spark.createDataFrame([(node(2), node(6)), (node(8), node(9))], "a binary, b binary")
    got = {r[0][0]: r[1][0] for r in nd.join_classes(comps, more).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 8: 8, 9: 8}


# mixing


def test_targets_stop_at_their_ceiling(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1000), ("d", 0), (None, 500)]
    got = {r[0]: (r[1], r[2]) for r in source_targets(spark.createDataFrame(rows, "_source string, _size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1], strict=True))
    left, wanted, want = dict(rows), 1.5 * 2510, {}
    while left:  # share, stop the full ones, share the rest
        level = wanted / sum(weights[s] for s in left)
        full = [s for s in left if 2 * left[s] <= level * weights[s]]
        if not full:
            want |= {s: level * weights[s] for s in left}
            break
        for s in full:
            want[s] = 2 * left.pop(s)
            wanted -= want[s]
    assert {s: t for s, (_, t) in got.items()} == pytest.approx(want)


@pytest.mark.parametrize("cell_rows", [1, 7, 10_000])
def test_mix_does_not_depend_on_cells(spark, cell_rows):
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('w ', int(id % 23)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 5)) as source")
    one = sorted(map(tuple, sample_copies(docs, ["doc_id"], cell_rows).collect()))
    assert one == sorted(map(tuple, sample_copies(docs.repartition(5), ["doc_id"]).collect()))
    assert {r[4] for r in one} <= {0, 1, 2}


def test_mixing_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    narrow = sample_copies(docs, ["doc_id"]).toPandas()
    assert len(narrow) == len(odd_rows)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == narrow.copies.sum()
    assert mix_documents(docs.limit(0)).count() == 0


# search


@pytest.mark.parametrize("kind", range(6))
def test_search_equals_all_products(kind):
    rng = np.random.default_rng(kind)
    n, k, d = 1500, 20, [1, 8, 64, 8, 16, 8][kind]
    scale = rng.pareto(1.2, size=(n, 1)) + 0.05 if kind in (1, 3, 4) else 1
    v = np.floor(rng.normal(size=(n, d)) * [1, 40, 8, 3, 10, 1e8][kind] * scale).astype(np.int64)
    if kind == 4:
        v[:700], v[900:910] = v[7], 0
    ids = rng.permutation(n).astype(np.int64)
    asked = np.arange(0, n, 25)
    unknown = np.full(len(asked), np.iinfo(np.int64).min)
    got = topk.search(ids[asked], v[asked], unknown, ids, v, k, bucket_rows=128)
    for a, i in enumerate(asked):
        scores = v @ v[i]
        others = ids != ids[i]
        best = np.lexsort((ids[others], -scores[others]))[:k]
        assert got[a][0].tolist() == ids[others][best].tolist()
        assert got[a][1].tolist() == scores[others][best].tolist()


def test_search_leaves_out_every_row_of_the_query():
    rng = np.random.default_rng(8)
    v = rng.integers(-3000, 3000, (200, 6))
    ids = np.arange(200)
    ids[:3], v[:3] = 7, 5000  # the query's id three times, above all others
    ids[7] = 300
    got_ids, scores = topk.search(ids[:1], v[:1], np.full(1, np.iinfo(np.int64).min), ids, v, 20)[0]
    products = v @ v[0]
    order = [i for i in np.lexsort((ids, -products)) if ids[i] != 7][:20]
    assert got_ids.tolist() == ids[order].tolist() and scores.tolist() == products[order].tolist()


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(100)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [math.nan, 0.0, 0.0, 0.0]), (103, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (104, []), (105, [1.0, 2.0]), (106, [2.0, 1.0]), (20, rows[20][1]), (107, [0.0] * 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("_dim", F.lit("x"))
    vectors = table.select("*", topk.quantised("embedding").alias("vector"))
    got = topk.top_k(vectors, vectors.where("vec_id % 5 = 0"), k=7, shard_rows=16, query_rows=6).toPandas()
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in dict(usable).items():
        if q % 5:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v))[:7]
        mine = got[got.query_id == q].sort_values("rank")
        assert [(-s, i) for s, i in zip(mine.score, mine.vec_id, strict=True)] == scored
        assert mine["rank"].tolist() == list(range(1, len(scored) + 1))
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    assert topk.top_k(vectors, vectors.limit(0)).count() == 0


# models


def test_scores_of_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None), (4, 7)], "doc_id long, label int")
    for score in (score_quality, score_toxicity):
        for some in (labels, labels.limit(0)):
            got = score(docs, some).toPandas()
            assert len(got) == len(odd_rows) and got.score.between(0, 1).all()
            assert set(got.predicted) <= {0, 1}
        assert score(docs.limit(0), labels).count() == 0


def test_labels_of_the_held_out_fold_are_not_used(spark, documents):
    rows = [(i, ("good fine words here " if i % 2 else "BAD!! BAD!! BAD!! ") * (3 + i % 5), "en", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, label int")
    flipped = labels.withColumn("label", F.when(fold("doc_id", 5) == 0, 1 - F.col("label")).otherwise(F.col("label")))
    docs = documents(rows)
    for score in (score_quality, score_toxicity):
        one, two = (score(docs, x).orderBy("doc_id").toPandas() for x in (labels, flipped))
        assert np.allclose(one.score, two.score)


def test_toxicity_against_plain_counts(spark, documents):
    rng = random.Random(11)
    common_words = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]
    bad = [f"nasty{c}" for c in "abcdefghijklmnop"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = rng.choices(common_words, k=rng.randrange(0, 40)) + (rng.choices(bad, k=2) if toxic else [])
        rows.append((i, " ".join(words) or None, "en", "s"))
        labels.append((i, int(toxic)))
    rows += [(1000 + i, *rows[3][1:]) for i in range(50)]  # equal texts, one of which counts
    labels += [(1000 + i, 0) for i in range(50)]
    docs, known = documents(rows), spark.createDataFrame(labels, "doc_id long, label int")
    chain = tx.fit_toxicity(docs, known)

    def plain_terms(text):
        cut_words = (text or "").encode().split()  # only letters and digits here
        stems = [(w, k) for w in cut_words for k in (0, *tx.STEMS) if k == 0 or len(w) > k]
        out = Counter()
        for w, k in stems:
            h = words_of(pa.array([w[: k or None].decode()])).hashes()[0]
            out[int((tx.mix(np.array([h + np.uint64(k)]))[0] if k else h) >> np.uint64(64 - tx.TERM_BITS))] += 1
        return out

    of_text = {t: plain_terms(t) for t in {r[1] or "" for r in rows}}
    label_of = {(r[1] or "", dict(labels)[r[0]]) for r in rows}
    n, toxic = Counter(), Counter()
    for t, y in label_of:
        n.update(of_text[t].keys())
        toxic.update(k for k in of_text[t] if y)
    total, bad_texts = len(label_of), sum(y for _, y in label_of)
    base, bands = bad_texts / total, len(tx.BANDS) + 1
    significant = {}
    for b in n:
        if n[b] >= tx.LEAST_TEXTS and (toxic[b] - n[b] * base) / math.sqrt(n[b] * base * (1 - base)) >= tx.SIGNIFICANT:
            rest = n[b] - toxic[b] + 0.5
            odds = math.log((toxic[b] + 0.5) / rest) - math.log(bad_texts / (total - bad_texts))
            significant[b] = sum(odds - math.sqrt(1 / (toxic[b] + 0.5) + 1 / rest) >= e for e in tx.BANDS)
    assert len(significant) >= 16 and set(np.flatnonzero(chain.table)) == set(significant)
    assert all((chain.table[b] - 1) % bands == k for b, k in significant.items())

    got = score_toxicity(docs, known, parts=1, held_out=1).toPandas().set_index("doc_id")
    for i, t, *_ in rows[:60]:
        x = [0.0] * (tx.GROUPS * bands)
        for b, k in of_text[t or ""].items():
            if chain.table[b]:
                x[chain.table[b] - 1] += math.log1p(k)
        x += [sum(x[g * bands + k] for g in range(tx.GROUPS)) for k in range(bands)]
        x = [math.log1p(v) for v in (*x, len(of_text[t or ""]))]
        for model in chain.models:
            x.append(1 / (1 + math.exp(-(sum(a * w for a, w in zip(x, model.weights, strict=False)) + model.weights[-1]))))
        assert got.score[i] == pytest.approx(x[-1], abs=1e-6)
    assert got.predicted[:600].tolist() == [int(i % 5 == 0) for i in range(600)]


def test_a_rare_language_has_its_terms_too(spark, documents):
    """Terms of 20 toxic texts among 4,000 count, though the models are fitted on 100 of each class."""
    rng = random.Random(12)
    plain = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]
    rare = [f"x{a}" for a in "aeiou"]
    texts = [(rng.choices(plain, k=20) + ["nasty"] * (i % 10 == 0), int(i % 10 == 0)) for i in range(3600)]
    texts += [(rng.choices(rare, k=15) + ["garstig"] * (i % 20 == 0), int(i % 20 == 0)) for i in range(400)]
    docs = documents([(i, " ".join(w) + f" {i}", "en", "s") for i, (w, _) in enumerate(texts)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, label int")
    got = score_toxicity(docs, labels, sample_rows=100).toPandas().set_index("doc_id").predicted
    assert [got[i] for i in range(3600, 4000)] == [y for _, y in texts[3600:]]


def test_language_of_odd_rows(documents, odd_rows):
    more = [(100 + i, f"der die das und ist nicht {i} ein satz", "de") for i in range(40)]
    more += [(200 + i, f"the and is not a sentence {i} with words", "en") for i in range(40)]
    got = predict_language(documents(odd_rows + more)).toPandas()
    assert len(got) == len(odd_rows) + 80 and got.score.between(0, 1).all()
    by_id = got.dropna(subset=["doc_id"]).set_index("doc_id").lang_pred
    assert set(by_id[[1, 2, 3, 10]]) == {"und"}
    assert set(by_id[by_id.index.isin(range(100, 140))]) == {"de"} and set(by_id[by_id.index.isin(range(200, 240))]) == {"en"}
    nothing = predict_language(documents([(1, "abc", None)])).toPandas()
    assert nothing.lang_pred.tolist() == ["und"] and predict_language(documents([])).count() == 0


def plain_grams(text):
    """Windows of four bytes with a letter among the inner two, as a dictionary of counts."""
    body = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in text.encode())
    body = b" " + body + b"  "
    windows = (body[i : i + 4] for i in range(len(text.encode())))
    return Counter(int.from_bytes(w.ljust(4), "big") for w in windows if w[1:3] != b"  ")


def test_language_filter_against_plain_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = li.fit(docs)
    rows = [r for r in docs.select("text", "lang").collect() if r.text is not None]
    counts = {lang: sum((plain_grams(r.text) for r in rows if r.lang == lang), Counter()) for lang in learned.languages}
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    every = np.array(sorted(set().union(*counts.values())), dtype=np.uint32)
    found = learned.containing(every)
    level = lambda lang, g: sum(counts[lang][g] >= totals[lang] * share for share in li.SHARES) + 1 if g in counts[lang] else 0
    wrong = 0
    for i, lang in enumerate(learned.languages):
        exact = np.array([(1 << level(lang, g)) - 1 for g in every.tolist()])
        assert (found[:, i] & exact == exact).all()  # no language that contains an n-gram is missing
        wrong += (found[:, i] != exact).mean()
    assert wrong / len(learned.languages) < 0.02 and learned.false_rate.max() < 0.02
    texts = [r.text for r in rows][:50]
    got = learned.corrected_counts(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        plain = [sum(n * level(lang, g) for g, n in plain_grams(text).items()) for lang in learned.languages]
        assert row == pytest.approx(plain, rel=0.03, abs=10 + 0.02 * max(plain))  # what is found wrongly goes by the text's length
        assert not text.strip() or row.argmax() == np.argmax(plain) or sorted(plain)[-1] - sorted(plain)[-2] < 0.03 * max(plain)


def test_language_of_texts_that_differ_in_frequency_only(documents):
    """Both languages contain every n-gram; how often is what tells them apart."""
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdgk" for b in "aeou" for c in "lmnr"]
    more = {"x": [1 + 15 * (i % 2) for i in range(64)], "y": [16 - 15 * (i % 2) for i in range(64)]}
    rows = [(i, " ".join([*words, *rng.choices(words, more["xy"[i % 2]], k=200)]), "xy"[i % 2]) for i in range(400)]
    got = predict_language(documents(rows)).toPandas().set_index("doc_id")
    assert np.mean([got.lang_pred[r[0]] == r[2] for r in rows]) > 0.97


def test_language_counts_are_merged_in_tasks(monkeypatch):
    texts = [f"word {chr(97 + i % 26)}{chr(97 + i % 25)}{chr(97 + i % 7)} and more" for i in range(300)]
    batches = lambda: [pa.record_batch({"text": texts[i : i + 50], "lang": ["a", "b"] * 25}) for i in range(0, 300, 50)]
    count = lambda: sum((Counter({(r["lang"], r["gram"]): r["n"]}) for b in li._count(batches()) for r in b.to_pylist()), Counter())
    whole = count()
    monkeypatch.setattr(li, "MERGE_AT", 100)
    assert count() == whole
    want = Counter()
    for i, t in enumerate(texts):
        want.update({("ab"[i % 2], g): n for g, n in plain_grams(t).items()})
    assert whole == want


def test_language_masks_hold_more_than_64_languages(documents):
    rows = [(1000 * k + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}q" for c in "abcde") + f" {i}", f"l{k:02}") for k in range(70) for i in range(3)]
    got = predict_language(documents(rows)).toPandas().set_index("doc_id")
    want = {r[0]: r[2] for r in rows}
    trained = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    own = [(i, w) for i, w in want.items() if w in trained]
    assert np.mean([got.lang_pred[i] == w for i, w in own]) == 1.0


def test_gradients_of_the_language_model():
    rng = np.random.default_rng(0)
    model = lm.GatedModel.start(rng.normal(size=lm.HEAD_CLASSES + 1), rng.normal(size=lm.HEAD + lm.SHAPES))
    for k, v in model.p.items():
        model.p[k] = v.astype(np.float64) + rng.normal(size=v.shape) * 0.1
    x, y = (rng.integers(0, lm.HEAD + lm.SHAPES, (5, 3)) for _ in range(2))
    y[4, 1] = -1
    start = np.zeros((3, lm.HIDDEN))

    def loss():
        table, h, states = model.table(), start, []
        for t in range(5):
            h, _ = model.step(table[x[t]], h)
            states.append(h)
        return -model.log_probabilities(np.stack(states)[y >= 0], y[y >= 0])[0].sum()

    g, _, n = model.window_gradients(x, y, start)
    assert n == 14
    for k, v in model.p.items():
        for i in np.abs(g[k]).ravel().argsort()[-3:]:
            flat, old = v.ravel(), v.ravel()[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert (up - down) / 2e-5 == pytest.approx(g[k].ravel()[i], rel=0.02, abs=1e-3)


def test_probabilities_of_the_language_model_sum_to_one():
    rng = np.random.default_rng(1)
    model = lm.GatedModel.start(rng.normal(size=lm.HEAD_CLASSES + 1), rng.normal(size=lm.HEAD + lm.SHAPES))
    every = np.arange(lm.HEAD + lm.SHAPES)
    logs, _ = model.log_probabilities(np.repeat(rng.normal(size=(1, lm.HIDDEN)), len(every), axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_lanes_score_like_one_text_at_a_time():
    rng = np.random.default_rng(2)
    model = lm.GatedModel.start(rng.normal(size=lm.HEAD_CLASSES + 1), rng.normal(size=lm.HEAD + lm.SHAPES))
    model.p["cw"] = rng.normal(size=model.p["cw"].shape).astype(np.float32)
    sizes = np.append(rng.integers(1, 200, 300), 1000)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    tokens = rng.integers(0, lm.HEAD + lm.SHAPES, begins[-1])
    got = model.score(tokens, begins, 7)
    for i in [*range(0, 300, 50), 300]:
        own = tokens[begins[i] : begins[i + 1]]
        assert model.score(own, np.array([0, len(own)]), 7)[0] == pytest.approx(got[i], abs=0.02)


def test_frequent_words(spark):
    counts = spark.range(1, 2000).selectExpr("id as word", "0 as shape", "1 + (id * id) % 997 as n")
    rows = sorted((tuple(r) for r in counts.collect()), key=lambda r: (-r[2], r[0]))
    assert lm.frequent_words(counts, 5000) == rows
    some = lm.frequent_words(counts, 300)
    assert 200 < len(some) <= 300 and some == rows[: len(some)]
    assert lm.frequent_words(counts.where("n = 1"), 0) == [] and lm.frequent_words(counts.limit(0), 5) == []


class Sent:
    def __init__(self, value):
        self.value = value


def test_training_stretches_hold_every_token():
    texts = pa.array(["a " * 200, None, "b a " * 32, "b " * 63])
    hashes = [int(h) for h in words_of(pa.array(["a b"])).hashes()] + [int(lm.END)]
    head, token = (Sent(np.array(x)) for x in zip(*sorted(zip(np.array(hashes, np.uint64), (1, 2, 0), strict=True)), strict=True))
    out = lm._stretches([pa.RecordBatch.from_arrays([pa.array([1, 2, None, 3]), texts], names=["doc_id", "text"])], head, token)
    rows = np.stack([np.frombuffer(r, "<i2") for b in out for r in b.column("tokens").to_pylist()])
    assert rows.shape == (4 + 1 + 2 + 1, lm.WINDOW * lm.STRETCH + 1)
    assert [int(t) for r in rows for t in r[1:] if t >= 0] == [1] * 200 + [0] + [0] + [2, 1] * 32 + [0] + [2] * 63 + [0]
    assert rows[:, 0].tolist() == [0, 1, 1, 1, 0, 0, 1, 0]


def test_training_grows_with_the_stretches():
    before = 0
    for rows in (0, 1, 5000, 100_000, 2_000_000, 10**12):
        rounds, shares, trainers = lm.training_plan(rows)
        assert rounds >= max(before, shares)
        assert rows < lm.TRAINER_ROWS or 0.6 < rows / shares / trainers / lm.TRAINER_ROWS < 1.5
        before = rounds
    assert before > 20


def test_training_does_not_depend_on_files(documents, monkeypatch):
    rng = random.Random(4)
    docs = documents([(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(300)))) for i in range(150)])
    monkeypatch.setattr(lm, "TRAINER_ROWS", 100)
    few, many = (lm.score_texts(docs.repartition(n)).toPandas().sort_values("doc_id") for n in (1, 9))
    np.testing.assert_allclose(few.score, many.score, rtol=1e-5)


def test_a_task_sends_one_model_for_the_copies_it_trains():
    rng = np.random.default_rng(6)
    stretches = rng.integers(0, lm.HEAD + lm.SHAPES, (300, lm.WINDOW * lm.STRETCH + 1)).astype("<i2")
    stretches[::3, 20:] = -1
    model = lm.GatedModel.start(rng.normal(size=lm.HEAD_CLASSES + 1), rng.normal(size=lm.HEAD + lm.SHAPES))
    rows = lambda which: pa.table({"task": pa.array([0] * len(which), pa.int32()), "trainer": pa.array([int(i) % 3 for i in which], pa.int32()), "tokens": pa.array([stretches[i].tobytes() for i in which], pa.binary())})
    whole = lm._train(rows(rng.permutation(300)), Sent(model))
    alone = [lm._train(rows(np.arange(k, 300, 3)), Sent(model)) for k in range(3)]
    assert whole["weight"].to_pylist() == [300.0] and len(whole) == 1
    got = np.frombuffer(whole["arrays"][0].as_py(), "<f4")
    want = np.mean([np.frombuffer(a["arrays"][0].as_py(), "<f4") for a in alone], axis=0)
    np.testing.assert_allclose(got, want, atol=1e-6)
    for trainers in (1, 32, 43, 1580, 10**6):
        tasks = -(-trainers // lm.together(trainers))
        assert tasks <= max(lm.AVERAGED, trainers / 8 + 1) and tasks >= min(trainers, lm.AVERAGED // 2)


@pytest.mark.parametrize("by", [1, 300])
def test_choices_with_logits_of_any_size(by):
    rng = np.random.default_rng(7)
    states = np.column_stack([rng.normal(size=(50, 4)), np.ones(50)]).astype(np.float32)
    weights = (rng.normal(size=(9, 5)) * by).astype(np.float32)
    chosen = rng.integers(0, 9, 50)
    logits = states.astype(float) @ weights.T.astype(float)
    want = (logits - np.logaddexp.reduce(logits, axis=1)[:, None])[np.arange(50), chosen]
    got, (_, d_weights) = lm._choose(states, weights, chosen, True)
    np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-3)
    assert np.isfinite(d_weights).all()


def test_training_keeps_its_memory():
    resource = pytest.importorskip("resource")
    rng = np.random.default_rng(8)
    model = lm.GatedModel.start(rng.normal(size=lm.HEAD_CLASSES + 1), rng.normal(size=lm.HEAD + lm.SHAPES))
    stretches = rng.integers(0, lm.HEAD + lm.SHAPES, (4 * lm.BATCH, lm.WINDOW * lm.STRETCH + 1))
    lm.hold_memory()
    model.train(stretches)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    model.train(stretches)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 4000  # some 2,000 a window, of 8, before


def test_language_model_of_odd_rows(documents, odd_rows):
    got = lm.score_texts(documents(odd_rows)).toPandas()
    assert len(got) == len(odd_rows) and np.isfinite(got.score).all() and np.isfinite(got.base_score).all()
    assert sorted(got.n_tokens) == sorted(len((r[1] or "").encode().split()) + 1 for r in odd_rows)
    assert lm.score_texts(documents([])).count() == 0
    alone = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    none = lm.score_texts(documents([(alone, "held out only")])).toPandas()
    assert none.train_tokens.tolist() == [0] and none.n_known.tolist() == [0] and np.isfinite(none.score).all()


# pipeline


@pytest.mark.parametrize("stage", [ed.drop_duplicates, nd.drop_near_duplicates, mix_documents])
def test_stages_keep_the_values_of_further_columns(spark, documents, stage):
    names = documents([]).columns[4:]
    rows = [(i, f"a text of its own, number {i} {i * 7} {i * 13} and {i * 17}", "en", "s") for i in range(12)]
    docs = documents(rows).withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id")) for n in names})
    got = stage(docs).distinct().collect()
    assert got and {tuple(r) for r in got} <= {tuple(r) for r in docs.collect()}
    assert len(got) == 12 or stage is mix_documents
    with pytest.raises(ValueError, match="maps"):
        stage(docs.withColumn("m", F.create_map(F.lit("a"), F.lit(1))))


def test_stages_take_odd_rows(spark, documents, odd_rows):
    for rows in (odd_rows, []):
        docs = documents(rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            if name != "packing":
                assert out.columns == docs.columns
                came = {tuple(r) for r in docs.collect()}
                assert {tuple(r) for r in out.collect()} <= came  # values, not only names
            docs = spark.createDataFrame([tuple(r) for r in out.collect()], out.schema)
