"""SimHash near-duplicates: 64-bit fingerprints of word shingles, joined on shared blocks, then verified bit by bit.

A fingerprint within ``max_bits`` of another differs from it in at most ``max_bits`` of ``blocks`` blocks, so the two agree on
some choice of ``blocks - max_bits`` whole blocks. Distinct fingerprints meet on every such choice. A meeting of at most
``small`` fingerprints is verified pair by pair. The members of larger meetings (a boilerplate page with thousands of variants)
are linked exactly and without pairs: for ``max_bits`` = 2 each writes itself under its own value and under the 64 values one bit
away; all writers of one value lie within two bits of each other, and any two fingerprints within two bits share a value.
At most 65 fingerprints can write one value, so no key is hot.

Null texts count as empty, texts without words have fingerprint zero and link like any other. Rows with a null id take part;
a component's id is its smallest id that is not null, or null if it has none. Repeated rows are kept, each with its fingerprint.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swayline.llm.common import forget, fresh, keep, small_batches, whole_text

CHUNK = 1 << 16
SEED = 42


def _simhash(text: str, words: int) -> int:
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
    if not tokens:
        return 0
    size = min(words, len(tokens))
    total, seen = np.zeros(64, np.int64), len(tokens) - size + 1
    digest, space = xxhash.xxh64_intdigest, b" "
    for start in range(0, seen, CHUNK):
        part = tokens[start:min(start + CHUNK, seen) + size - 1]
        if size == 3:
            hashes = [digest(b"%b %b %b" % t, SEED) for t in zip(part, part[1:], part[2:])]
        else:
            hashes = [digest(space.join(part[i:i + size]), SEED) for i in range(len(part) - size + 1)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > seen, bitorder="little").tobytes(), "little", signed=True)


def fingerprint_column(text: Column, words: int = 3) -> Column:
    """64-bit SimHash (signed long) of a text's shingles of ``words`` words, repeats included, each hashed by XXH64 with seed 42."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([_simhash(t, words) for t in texts], dtype="int64")

    return simhash(text)


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _mask(chosen: tuple[int, ...], blocks: int) -> int:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, max_bits: int = 2, blocks: int = 4, small: int = 48) -> DataFrame:
    """``a < b`` fingerprint links that connect exactly what the pairs within ``max_bits`` connect. ``distinct`` has column ``fp``."""
    if max_bits != 2:
        raise ValueError("the exact way for large meetings is written for two bits")
    masks = [_mask(c, blocks) for c in combinations(range(blocks), blocks - max_bits)]
    met = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])).alias("m"))
    met = met.select("m.choice", "m.key", "fp")
    sizes = met.groupBy("choice", "key").agg(F.count("*").alias("size")).filter("size > 1")
    met = keep(met.join(sizes, ["choice", "key"]), "meetings")
    few = met.filter(F.col("size") <= small)
    pairs = (few.select("choice", "key", F.col("fp").alias("a"))
             .join(few.select("choice", "key", F.col("fp").alias("b")), ["choice", "key"])
             .filter((F.col("a") < F.col("b")) & (distance("a", "b") <= max_bits)).select("a", "b"))
    crowd = met.filter(F.col("size") > small).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i) for i in range(64)])
    near = (crowd.select("fp", F.explode(flips).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
            .groupBy("value").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # 65 at most
            .filter(F.size("fps") > 1))
    paths = near.select(F.explode(F.arrays_zip(
        F.expr("slice(fps, 1, size(fps) - 1)").alias("a"), F.expr("slice(fps, 2, size(fps) - 1)").alias("b"))).alias("p"))
    return pairs.union(paths.select("p.a", "p.b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of ``edges`` (``a``, ``b``): ``node``, ``label``.

    Each round takes the least label of the neighbours and then the label of that label, so a path of n nodes needs about log n
    rounds. Every round is a written table; a lost executor costs its own tasks. Links have bounded degree, and lookups of a
    popular label are a plain join of two tables, which adaptive execution can split.
    """
    both = keep(edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
                .union(edges.select(F.col("b").alias("src"), F.col("a").alias("dst"))), "links")
    state = keep(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("node"), F.min("dst")).alias("label")), "labels")
    while True:
        jump = state.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = keep(state.join(jump, "label", "left").select("node", F.least("label", "further").alias("label")), "labels")
        seen = (both.join(jumped, both["src"] == jumped["node"]).groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("near")))
        after = keep(jumped.join(seen, "node", "left").select("node", F.least("label", "near").alias("label"),
                                                              (F.col("near") < F.col("label")).alias("moved")), "labels")
        forget(state)
        forget(jumped)
        state = after.select("node", "label")
        if not after.filter("moved").limit(1).count():
            return state


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, max_bits: int, blocks: int) -> DataFrame:
    prints = keep(small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole_text(text)).alias("text_hash"),
                              fingerprint_column(whole_text(text), words).alias("fp")), "fingerprints")
    classes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    found = components(links(classes.select("fp"), max_bits, blocks))
    grouped = keep(classes.join(found, classes["fp"] == found["node"], "left")
                   .select("fp", "least_id", F.coalesce("label", "fp").alias("group_fp")), "groups")
    least = keep(grouped.groupBy("group_fp").agg(F.min("least_id").alias("component_id")), "least")
    named = keep(grouped.join(least, "group_fp").select("fp", "group_fp", "component_id"), "named")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2,
                    blocks: int = 4) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (long), ``group_fp`` (least fingerprint reachable) and ``component_id``."""
    return _grouped(docs, doc_id, text, words, max_bits, blocks).select(
        F.col("doc_id").alias(doc_id), "fp", "group_fp", "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2,
                  blocks: int = 4) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id (null after all others), of several texts under that id the
    one with the least hash, of equal rows one."""
    rows = _grouped(docs, doc_id, text, words, max_bits, blocks)
    kept_id, kept_hash, row_hash = (fresh(docs, n) for n in ("kept_id", "kept_hash", "row_hash"))
    first = (rows.groupBy("group_fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("m"))
             .select(F.col("m.doc_id").alias(kept_id), F.col("m.text_hash").alias(kept_hash)).distinct())
    marked = docs.withColumn(row_hash, F.xxhash64(whole_text(text)))
    same = marked[doc_id].eqNullSafe(first[kept_id]) & (marked[row_hash] == first[kept_hash])
    return marked.join(first, same, "left_semi").dropDuplicates([doc_id, row_hash]).select(*docs.columns)
