"""Registered queries against SQL where there is some, else against brute force."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest

import corpus_pipeline
from spheremeans.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("select doc_id, coalesce(text, '') from documents").fetchall())


def run(spark, name):
    return QUERIES[name](spark, SF_DIR).toPandas()


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    got, want = run(spark, name), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    order = sorted(got.columns)
    got, want = (x[order].sort_values(order).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


def brute_classes(texts, similarity, threshold=0.8):
    """Classes of ids by comparing all pairs that share anything."""
    shingles = {}
    for i, t in texts.items():
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(t)]
        runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else [])
        shingles[i] = {s: 1 + math.log(n) for s, n in Counter(runs).items()}
    where = defaultdict(list)
    for i, s in shingles.items():
        for x in s:
            where[x].append(i)
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        if similarity(shingles[a], shingles[b]) >= threshold:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    groups = defaultdict(set)
    for i in texts:
        groups[top(i)].add(i)
    return {frozenset(g) for g in groups.values()}


def probability_jaccard(x, y):
    if len(x.keys() & y.keys()) < 0.5 * max(len(x), len(y)):
        return 0.0  # too few in common for 0.8
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x.keys() & y.keys())


def test_op2(spark, texts):
    got = run(spark, "op2_probminhash_dedup")
    assert sorted(got.doc_id) == sorted(texts)
    classes = {frozenset(g) for g in got.groupby("class_id").doc_id.apply(list)}
    assert classes == brute_classes(texts, probability_jaccard)
    assert (got.groupby("class_id").doc_id.transform("min") == got.class_id).all()
    assert (got.groupby("class_id").doc_id.transform("size") == got.class_size).all()


def check_packing(packed, sequences):
    """sequences: (doc_id, token ids and the end) for each document, repeated ones too."""
    from collections import Counter

    assert packed.length.between(1, 1024).all()
    for _, seq in packed.sort_values("offset").groupby("sequence_id"):
        assert (seq.offset.to_numpy() == np.concatenate([[0], np.cumsum(seq.length)[:-1]])).all()
        assert seq.length.sum() <= 1024
    want = Counter()
    for i, ids in sequences:
        at, number, step = 0, 0, len(ids) % 1024 or 1024
        while at < len(ids):
            want[i, number, at, step, zlib.crc32(np.array(ids[at : at + step], "<u4").tobytes())] += 1
            at, number, step = at + step, number + 1, 1024
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, packed[columns].to_numpy().tolist())) == want
    least = math.ceil(packed.length.sum() / 1024)
    assert packed.sequence_id.nunique() <= max(least + 1, math.ceil(1.02 * least))


def test_op3(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(
        run(spark, "op3_best_fit_packing"),
        [(i, [*t.encode(x, add_special_tokens=False).ids, 2]) for i, x in texts.items()],
    )


@pytest.mark.parametrize("name, label", [("op4_attention_quality", "quality"), ("op9_chain_toxicity", "toxic")])
def test_held_out_accuracy(spark, duck, name, label):
    directory = "/root/testdata/sf0.1"  # smaller tables hold a few toxic texts of each language only
    got = QUERIES[name](spark, directory).toPandas()
    assert (got.held_out == (got.doc_id.map(crc) % 5 == 0)).all()
    assert got.score.between(0, 1).all()
    labels = duck.sql(f"select doc_id, {label} as y from '{directory}/labels.parquet'").df()
    m = got[got.held_out].merge(labels, on="doc_id")
    assert (m.predicted == m.y).mean() >= 0.9
    one, zero = m[m.y == 1].score.to_numpy(), m[m.y == 0].score.to_numpy()
    assert (one[:, None] > zero[None]).mean() >= 0.9


def test_op6_takes_what_it_aims_at(spark):
    got = run(spark, "op6_systematic_mixing")
    for _, s in got.groupby(["source_size", "target"]):
        assert abs(s.taken.sum() - s.target.iloc[0]) <= 2 * s["size"].max()
    assert (got.taken <= 2 * got["size"]).all()
    assert got.drop_duplicates(["source_size", "target"]).target.sum() == pytest.approx(1.5 * got["size"].sum())


def test_op7(spark, texts):
    got = run(spark, "op7_recurrent_lm").set_index("doc_id")
    tokens = {i: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [b"\0"] for i, t in texts.items()}
    counts = Counter(w for i, t in tokens.items() if crc(i) % 5 != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    assert set(got.train_tokens) == {n}
    for i, t in tokens.items():
        row = got.loc[i]
        assert (row.n_tokens, row.n_known) == (len(t), sum(w in counts for w in t))
        assert row.held_out == (crc(i) % 5 == 1)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert row.base_score == pytest.approx(base, rel=1e-9)
    unseen = got[got.held_out]
    assert unseen.score.sum() > unseen.base_score.sum()


def test_op8(spark, duck, texts):
    got = run(spark, "op8_bitmask_language")
    assert (got.held_out == (got.doc_id.map(crc) % 4 == 2)).all()
    m = got.merge(duck.sql("select doc_id, lang from documents").df(), on="doc_id")
    assert (m[m.held_out].lang_pred == m[m.held_out].lang).mean() >= 0.95
    assert m.score.between(0, 1).all() and len(m) == len(texts)


def test_op10(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = run(spark, "op10_token_counts").set_index("doc_id")
    assert sorted(got.index) == sorted(texts)
    for i, x in texts.items():
        n = len(t.encode(x, add_special_tokens=False).ids)
        assert tuple(got.loc[i]) == (len(x.encode()), n, n > 2048)


def test_pipeline(spark, duck, texts):
    """Every stage against brute force over what the stage before kept."""
    from tokenizers import Tokenizer

    docs, outs = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        outs.append(docs.toPandas())
        docs = spark.createDataFrame(outs[-1], schema=docs.schema)
    language, exact, near, mixed, packed = outs
    assert list(language.columns) == list(exact.columns) == list(near.columns) == list(mixed.columns)
    assert set(language.doc_id) == set(texts)  # the table has no text without a language

    keep = {}
    for i, t in zip(language.doc_id, language.text, strict=True):
        k = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        keep[k] = max(i, keep.get(k, -1))
    assert sorted(exact.doc_id) == sorted(keep.values())

    classes = brute_classes(dict(zip(exact.doc_id, exact.text, strict=True)), probability_jaccard)
    assert sorted(near.doc_id) == sorted(map(min, classes))

    size = near.text.map(lambda t: len(WORD.findall(t)))
    assert set(mixed.doc_id) <= set(near.doc_id)
    times = near.doc_id.map(mixed.doc_id.value_counts()).fillna(0)
    assert (times <= 2).all()
    assert (times * size).sum() == pytest.approx(1.5 * size.sum(), rel=0.1)
    texts_kept = dict(zip(near.doc_id, near.text, strict=True))
    assert all(texts_kept[i] == t for i, t in zip(mixed.doc_id, mixed.text, strict=True))

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(packed, [(i, [*t.encode(x, add_special_tokens=False).ids, 2]) for i, x in zip(mixed.doc_id, mixed.text, strict=True)])


def test_pipeline_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert "sequence_id" in got.columns and got.count() > 0
