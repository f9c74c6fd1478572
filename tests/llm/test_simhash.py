import random
from collections import Counter

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swayline.llm import simhash
from tests.llm.common import AWKWARD, documents, rows_of


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB \t\n\x0b\x1c\x85 éÉ", max_size=60))
def test_fingerprint_by_definition(text):
    assert simhash._simhash(text, 3) & (1 << 64) - 1 == brute_print(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash._simhash(text, 3) & (1 << 64) - 1 == brute_print(text)


def test_awkward_rows(spark):
    found = simhash.near_duplicates(documents(spark, AWKWARD))
    prints = {t: brute_print(t) for _, t in AWKWARD}
    roots = brute_components(set(prints.values()))
    least = {}
    for i, t in AWKWARD:
        if i is not None:
            root = roots[prints[t]]
            least[root] = min(i, least.get(root, i))
    want = [(i, prints[t], least.get(roots[prints[t]])) for i, t in AWKWARD]
    got = [(i, fp & (1 << 64) - 1, c) for i, fp, c in rows_of(found, "doc_id", "fp", "component_id")]
    assert Counter(got) == Counter(want)


def test_links_of_crowds_and_pairs(spark):
    rnd = random.Random(3)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rnd.getrandbits(64)
        values.add(centre)
        for _ in range(25):
            value = centre
            for _ in range(rnd.randint(1, 4)):
                value ^= 1 << rnd.randrange(64)
            values.add(value)
    values = {v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = brute_components(values)
    for small in (2, 8, 1000):
        got = {r["node"]: r["label"] for r in simhash.components(simhash.links(df, small=small)).collect()}
        assert {v: got.get(v, v) for v in values} == roots


def test_long_path(spark):
    n = 300
    edges = spark.range(n).select((F.col("id") * 7 % 301).alias("a"), ((F.col("id") + 1) * 7 % 301).alias("b"))
    assert {r["label"] for r in simhash.components(edges).collect()} == {0}


def test_one_per_group(spark):
    docs = documents(spark, AWKWARD)
    got = sorted(rows_of(simhash.one_per_group(docs), "doc_id", "text"), key=repr)
    prints = {t: brute_print(t) for _, t in AWKWARD}
    roots = brute_components(set(prints.values()))
    groups = {}
    for i, t in AWKWARD:
        groups.setdefault(roots[prints[t]], []).append((i is None, i, t))
    want_ids = Counter(min((n, i or 0) for n, i, _ in g) for g in groups.values())
    assert Counter((i is None, i or 0) for i, _ in got) == want_ids
    assert simhash.one_per_group(docs).columns == docs.columns


def test_empty(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_per_group(docs).count() == 0
