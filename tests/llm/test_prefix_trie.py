import random
from hashlib import sha256
import re

import pytest
from pyspark.sql import functions as F

from checks.compare import difference, duck
from swayline.llm import prefix_trie
from swayline.llm.queries import ORACLE, QUERIES

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs: dict[int, list[tuple[str, str]]]):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, mine in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(mine) if len(convs[c]) == len(prefix))
        out.append((min(mine), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(mine), len(children), leaves, saved,
                    sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def rows_of(convs, shift=0):
    rows = [(c, n + shift, r, t) for c, turns in convs.items() for n, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", b"x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, turns binary, place int")


def a_corpus(seed, count, longest, words):
    rng = random.Random(seed)
    pick = lambda: (rng.choice(["user", "assistant"]), " ".join(rng.choices(words, k=rng.randint(0, 3))))
    starts = [[pick() for _ in range(rng.randint(1, longest))] for _ in range(6)]
    out = {}
    for c in rng.sample(range(-50, 3 * count), count):
        start = rng.choice(starts)
        out[c] = start[:rng.randint(1, len(start))] + [pick() for _ in range(rng.randint(0, 2))]
    return out


@pytest.mark.parametrize("ranges,cells,chunk", [(1, 1 << 18, 1 << 20), (1, 8, 1 << 20), (5, 1 << 18, 1 << 20), (7, 16, 6), (40, 3, 1)])
def test_against_brute_force(spark, ranges, cells, chunk):
    convs = a_corpus(ranges, 150, 5, ["a", "b b", "ü"])
    convs.update({1000 + i: [("user", "same"), ("assistant", "answer")] for i in range(80)})  # a run over several ranges
    convs[5000] = [("user", "long")] * 40
    convs[5001] = [("user", "long")] * 45
    df = prefix_trie.nodes(prefix_trie.sequences(table(spark, rows_of(convs))), ranges, cells, chunk)
    assert got(df) == brute(convs)


def test_turns_in_order_and_awkward_rows(spark):
    rows = [(1, None, "u", "first"), (1, 0, None, None), (1, 3, "u", "last \x0b word"), (2, 0, "u", "first"), (2, 1, "", ""), (None, 0, "u", "lost"),
            (3, 5, "u", ""), (4, 5, "u", None), (5, 0, "u", "x " * 20_000)]
    convs = {1: [("u", "first"), ("", ""), ("u", "last \x0b word")], 2: [("u", "first"), ("", "")], 3: [("u", "")], 4: [("u", "")], 5: [("u", "x " * 20_000)]}
    seq = prefix_trie.sequences(table(spark, rows))
    assert got(prefix_trie.nodes(seq, 3, 4, 4)) == brute(convs)
    tied = [(1, 0, "u", "a"), (1, 0, "u", "b"), (1, 0, "u", "b"), (2, 0, "u", "b"), (2, 0, "u", "a"), (2, 0, "u", "b")]
    assert {r["n_convs"] for r in prefix_trie.nodes(prefix_trie.sequences(table(spark, tied))).collect()} == {2}  # a tie has one order
    assert prefix_trie.nodes(prefix_trie.sequences(table(spark, []))).count() == 0


def test_shared_start(spark):
    convs = {0: [("u", "a"), ("v", "b")], 3: [("u", "c"), ("v", "d"), ("u", "e")], 7: [("u", "f")], 25: [("u", "g"), ("v", "h")], 27: [("u", "i")]}
    own = prefix_trie.sequences(table(spark, rows_of(convs)))
    for shared in range(4):
        built = {c: convs.get(c - c % 20, [])[:shared] + turns[shared:] for c, turns in convs.items()}
        rebuilt = prefix_trie.with_shared_start(own, F.col("conv_id") - F.col("conv_id") % 20, F.lit(shared), 3)
        assert got(prefix_trie.nodes(rebuilt, 3, 6, 3)) == brute(built)


def test_only_turnless_conversations(spark):
    convs = {i: [] for i in range(30)}
    none = prefix_trie.sequences(table(spark, [(i, 0, "u", "a") for i in convs])).select("conv_id", F.slice("turns", 1, 0).alias("turns"))
    for ranges in (1, 4):
        assert got(prefix_trie.nodes(none, ranges, 4, 4)) == brute(convs)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_against_sql(spark, folder):
    assert difference(QUERIES["op13_prefix_trie"](spark, folder), duck(folder), ORACLE["op13_prefix_trie"]) is None
