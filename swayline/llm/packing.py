"""Best-fit packing of documents into sequences by sums of squares.

A document is its token ids and an end id; only documents longer than a sequence are cut. Each piece goes where the sum of the
squared counts of open sequences per residual gap becomes smallest, longest pieces first. Pieces are dealt into shards of about
``shard_pieces`` by row, not by key; each shard is packed in its own task. Sequences left with a gap of more than ``loose``
tokens are opened again and their pieces dealt anew, over fewer shards, until one shard holds them or reopening no longer helps,
so the loss does not grow with the number of shards.

Null and empty texts are one end id. Repeated rows are packed each for itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swayline.llm.common import keep, map_texts
from swayline.llm.tokens import encoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = 1,
           capacity: int = 4096) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    end = end_id.to_bytes(4, "little")

    def make() -> Callable[[list[str]], list[list]]:
        def work(texts: list[str]) -> list[list]:
            out = []
            for ids in encoder(vocabulary).encode(texts):
                ids += end
                step = 4 * capacity
                out.append([{"start": at // 4, "length": len(ids[at:at + step]) // 4, "ids_crc32": zlib.crc32(ids[at:at + step])}
                            for at in range(0, len(ids), step)])
            return [out]

        return work

    cut = map_texts(docs, doc_id, text, "cut array<struct<start: long, length: long, ids_crc32: long>>", make, 2 << 20)
    return (cut.select(F.col(doc_id).alias("doc_id"), F.posexplode("cut").alias("piece", "p"))
            .select("doc_id", "piece", "p.start", "p.length", "p.ids_crc32"))


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, and every sequence's gap."""
    counts = np.zeros(capacity + 1, np.int64)   # open sequences by gap; full and unopened ones are not counted
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for item in np.argsort(-lengths, kind="stable"):
        size = int(lengths[item])
        # Moving a sequence from gap g to g - size changes the sum by 2 (n[g - size] - n[g] + 1), filling it up by 1 - 2 n[g].
        change = 2 * (counts[:capacity - size] - counts[size:capacity]) + 2
        if len(change):
            change[0] = 1 - 2 * counts[size]
            change[counts[size:capacity] == 0] = np.iinfo(np.int64).max
        fresh = 2 * counts[capacity - size] + 1 if size < capacity else 0
        best = int(change.argmin()) if len(change) else -1
        if best >= 0 and change[best] <= fresh:
            gap = size + best
            number = open_by_gap[gap].pop()
            counts[gap] -= 1
        else:
            gap, number = capacity, len(gaps)
            gaps.append(capacity)
        sequence[item], offset[item] = number, capacity - gap
        gaps[number] = gap - size
        if gap > size:
            counts[gap - size] += 1
            open_by_gap[gap - size].append(number)
    return sequence, offset, np.array(gaps, np.int64)


def _packed(rows: DataFrame, shards: int, number: int, capacity: int, loose: int) -> DataFrame:
    def one(shard: pd.DataFrame) -> pd.DataFrame:
        sequence, offset, gaps = pack_lengths(shard["length"].to_numpy(), capacity)
        base = (number << 56) | (int(shard["shard"].iloc[0]) << 24)
        return pd.DataFrame({"row": shard["row"], "sequence_id": base + sequence, "offset": offset, "again": gaps[sequence] > loose})

    dealt = rows.select("row", "length", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(one, "row long, sequence_id long, offset long, again boolean")


def pack(cut: DataFrame, capacity: int = 4096, shard_pieces: int = 4096, loose: int = 16) -> DataFrame:
    """``cut`` (with ``length``) and for each row its ``sequence_id`` and ``offset``."""
    cut = keep(keep(cut, "pieces").withColumn("row", F.monotonically_increasing_id()), "rows")
    placed, todo, count, number = None, cut.select("row", "length"), cut.count(), 0
    while True:
        shards = max(1, -(-count // shard_pieces))
        done = keep(_packed(todo, shards, number, capacity, loose), "placed")
        left = done.filter("again").count() if shards > 1 else 0
        last = left == 0 or left > count / 2
        closed = done if last else done.filter(~F.col("again"))
        placed = closed if placed is None else placed.unionByName(closed)
        if last:
            break
        todo, count, number = done.filter("again").join(cut.select("row", "length"), "row").select("row", "length"), left, number + 1
    return cut.join(placed.drop("again"), "row").drop("row")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = 1,
                   capacity: int = 4096) -> DataFrame:
    return pack(pieces(docs, doc_id, text, vocabulary, end_id, capacity), capacity)
