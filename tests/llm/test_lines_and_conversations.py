"""Line dedup, the prefix tree and structure repair against brute force on small and odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from spheremeans.llm import structure_repair as sr
from spheremeans.llm.line_dedup import drop_repeated_lines
from spheremeans.llm.prefix_trie import SEGMENT, TernaryTree, median_first, prefix_trie
from spheremeans.llm.turns import hash_in_order, number_rows

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ["_row", "_key", "_hash", "rank", "id", "size", "symbol", "_part", "_tie", "kind", "same", "block", "n", "_kind"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# lines


def brute_lines(rows, least_chars=10, least_docs=2):
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        first = {k: min((x for x in ids if x is not None), default=None) for k, ids in holders.items()}
        kept = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs or first[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("least", [(10, 2), (1, 3)])
def test_repeated_lines_go(documents, odd_rows, least):
    rng = random.Random(3)
    lines = ["", " ", "short", "A Line of words", "a line of WORDS \r", "\x0b a line of words", "É line of words", "é line of words"]
    lines += ["only here " * 9, "ten chars!", "nine char", "x y nine chars", "1234567890"]
    made = [(100 + k, "\n".join(rng.choices(lines, k=rng.randrange(9)))) for k in range(40)]
    long_text = "\n".join(f"line number {k}" if k % 3 else "a line of words" for k in range(30_000))
    rows = [*odd_rows, *made, made[0], made[0], (50, long_text), (None, "a line of words\nx"), (None, "a line of words"), (-5, "ten chars!\n")]
    got = drop_repeated_lines(documents(rows), *least)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(brute_lines([r[:2] for r in rows], *least), key=order)


def test_no_documents_have_no_lines(documents):
    assert drop_repeated_lines(documents([])).collect() == []


# what conversations share


@pytest.fixture(scope="module")
def conversations(spark):
    def make(rows, parts=7):
        kinds = [("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType())]
        schema = T.StructType([T.StructField(n, k) for n, k in kinds] + [T.StructField(c, T.StringType()) for c in CLASHING])
        return spark.createDataFrame([(*r, *CLASHING) for r in rows], schema).repartition(parts)

    return make


def test_numbers_and_hashes_of_a_hot_key(spark):
    rows = [(1, k % 900, f"t{k % 7}") for k in range(3000)] + [(None, 4, "x"), (None, None, "y"), (2, 1, "z")]
    made = spark.createDataFrame(rows, "key long, at long, text string").repartition(11)
    got = number_rows(made, "key", ["at", "text"])
    ranks = sorted(got.where("key = 1").select("rank", "at", "text").collect())
    assert [r[0] for r in ranks] == list(range(1, 3001))
    assert [tuple(r[1:]) for r in ranks] == sorted((at, t) for k, at, t in rows if k == 1)
    assert sorted(got.where("key IS NULL").select("rank", "text").collect()) == [(1, "y"), (2, "x")]
    hashes = dict(hash_in_order(got, "key", ["rank"], "text", "|").collect())
    assert hashes == {1: sha("|".join(r[2] for r in ranks)), None: sha("y|x"), 2: sha("z")}


# prefix tree


def in_order(rows):
    def symbol(role, text):
        return hashlib.md5(f"{len(role)}:{role}{len(text)}:{text}".encode()).digest()

    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), symbol(role or "", text or ""), role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def brute_trie(rows):
    whole = in_order(rows)
    built = {}
    for c, turns in whole.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = (*whole.get(base, [])[:h], *turns[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, ms in members.items():
        leaf = all(len(built[c]) == len(path) for c in ms)
        worth = (len(ms) - 1) * len(path[-1][1].encode()) if path else 0
        if path:
            children[path[:-1]] += 1
        for d in range(len(path) + 1):
            leaves[path[:d]] += leaf
            saved[path[:d]] += worth
    return sorted(
        (
            ms[0], len(p), members[p[:-1]][0] if p else None, len(ms), children[p], leaves[p], saved[p],
            sha(",".join(str(c) for c in ms if len(built[c]) == len(p))),
        )
        for p, ms in members.items()
    )


def made_conversations():
    rng = random.Random(5)
    rows = []
    for c in range(60):  # many share first turns
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"é{rng.randrange(2)}"))
    long = [("user" if t % 2 == 0 else "assistant", f"word {t % 3}") for t in range(5 * SEGMENT + 3)]
    for c, n in ((205, 83), (206, 83), (210, 5 * SEGMENT), (212, 4 * SEGMENT), (215, 4 * SEGMENT + 1), (220, SEGMENT), (221, 70), (-7, 40), (-10, 90)):
        rows += [(c, t, *long[t % len(long)]) for t in range(n)]
    rows += [(221, t, "user", "goes another way") for t in range(70, 90)]
    rows += [(301, t, "user", "same") for t in range(3)] + [(302, 5, None, None), (302, None, "user", ""), (302, 5, "", "")]
    rows += [(303, 1, "user", "x")] * 3 + [(None, 1, "user", "x"), (None, None, None, None)]
    rows += [(2**62 + k, 0, "user", "far") for k in range(3)]
    return rows


@pytest.mark.parametrize("run", [3, 20_000])
def test_prefix_tree(conversations, run):
    rows = made_conversations()
    got = prefix_trie(conversations(rows), run)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == sorted(brute_trie(rows), key=lambda r: (r[0], r[1]))


def test_no_conversations_no_tree(conversations):
    assert prefix_trie(conversations([])).collect() == []
    assert prefix_trie(conversations([(None, 1, "user", "x")])).collect() == []


def test_ternary_tree_is_balanced_and_adds_up():
    words = sorted({tuple(random.Random(k).choices(range(40), k=3)) for k in range(2000)})
    assert sorted(median_first(len(words))) == list(range(len(words)))
    tree, ends = TernaryTree(), {}
    for k in median_first(len(words)):
        ends[tree.insert(list(words[k]))[-1]] = words[k]

    def deep(t):
        return 0 if not t else 1 + max(deep(tree.low[t]), deep(tree.high[t]))

    assert max(deep(t) for t in tree.equal) <= 10  # at most 40 symbols beside each other
    under = tree.below(lambda t: int(t in ends), lambda x, y: x + y, 0)
    assert under[0] == len(words)
    for t, path in ends.items():
        assert under[tree.parent[t]] == sum(w[:2] == path[:2] for w in words)


# structure repair


def brute_repair(rows):
    """By dynamic programming over (cost, audit) from the end."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        convs[c]
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        same = hashlib.md5(f"{len(role)}:{role}{len(text)}:{text}".encode()).digest()
        convs[c] += [((turn is not None, turn or 0), role, same, text)] * (2 if kind == 3 else 1)
    out = []
    for c, found in convs.items():
        found.sort()
        turns = {t[1] for t, *_ in found if t[0]}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), []
        for _, role, _, text in found:
            tail = text.rstrip(SPACE)
            fault = "blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        letters = [r[1][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        after = {"": "u", "s": "u", "u": "a", "a": "u"}
        full = {"u": "user", "a": "assistant"}

        def closed(best):
            for _ in range(3):
                for s in after:
                    k, a, done = best[after[s]]
                    best[s] = min(best[s], (k + 3, "I" + a, [full[after[s]] + ":", *done]))
            return best

        far = (10**9, "", [])
        best = closed({"": (0, "", []), "s": far, "u": far, "a": (0, "", [])})
        for (_, role, _, text), fault in zip(reversed(found), reversed(faults), strict=True):
            new = {}
            for s in after:
                ways = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    k, a, done = best[after[s]]
                    ways.append((k + 3 + extra, "R" + a, [f"{full[after[s]]}:{text}", *done]))
                    if role[:1] in ({"s", "u"} if s == "" else {after[s]}):
                        k, a, done = best[role[:1]]
                        ways.append((k + extra, "K" + a, [f"{role}:{text}", *done]))
                new[s] = min(ways)
            best = closed(new)
        cost, audit, done = best[""]
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *counts, illegal, cost, audit, sha("\n".join(done))))
    return out


def odd_conversations():
    rng = random.Random(8)
    roles = ["system", "user", "assistant", "User", "tool", "", None, "s", "u"]
    texts = ["Yes.", "no", "What? ", "", " \n", None, "end.\n\t", "a" * 3000 + "!", "é…", "..", "x" * 50_000]
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 9)):
            turn = rng.choice([t, t, t, t + 3, None, 0])
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[t % 2]
            rows.append((c, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}."))
    for c, n in ((500, 3 * sr.BLOCK + 7), (501, sr.BLOCK), (502, sr.BLOCK + 1), (503, 2 * sr.BLOCK)):
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant", "system"]), f"Text {rng.randrange(400)}" + rng.choice([".", ""])))
    rows += [(600, 1, "user", "copy.")] * 700 + [(None, 3, "assistant", "alone."), (None, None, None, None)]
    rows += [(601, -(2**63), "user", "a."), (601, 2**63 - 1, "assistant", "b.")]
    return rows


def test_repair(conversations, spark):
    rows = odd_conversations()
    made = conversations(rows)
    got = [tuple(r) for r in sr.repair_report(made, sr.damaged(made)).collect()]
    want = [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in brute_repair(rows)]
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_nothing_to_repair(conversations):
    made = conversations([])
    assert sr.repair_report(made, sr.damaged(made)).collect() == []


def test_cut_in_blocks_a_way_stays_the_same():
    rng = np.random.default_rng(2)
    for _ in range(60):
        codes = rng.integers(0, 12, (3, 12))
        whole, _, cost = sr.least_audits(codes, True, np.zeros((3, 4), np.int64))
        far_end = sr.costs_to_go(codes[:, 5:], True, np.zeros((3, 4), np.int64))[:, 0]
        a, exits, ca = sr.least_audits(codes[:, :5], False, far_end)
        b, _, cb = sr.least_audits(codes[:, 5:], True, np.zeros((3, 4), np.int64))
        for j in range(3):
            for s in range(4):
                text = lambda x: "".join(sr.LETTERS[x])
                assert text(whole[j, s]) == text(a[j, s]) + text(b[j, exits[j, s]])
                assert cost[j, s] == ca[j, s] + cb[j, exits[j, s]]
