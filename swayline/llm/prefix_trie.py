"""Prefix trie of conversations: one row per node, from sorted matrices of turn ids.

A turn's id is 16 bytes of a SHA-256 digest of role and text. A conversation is the array of its turns' ids; Spark orders all
conversations by that array and their own id and deals them as ranges, so members of a node stand together, and conversations that are
alike are dealt over as many ranges as they need. A task reads its range in blocks of bounded size:

- a block is a padded matrix of turn numbers, put in order by ``numpy.lexsort``;
- the masks of column changes between neighbours, OR-accumulated along the columns, tell at which depths a row starts nodes;
- ``reduceat`` over those starts sums up every node of a depth. All measures are sums over rows once the length of the prefix that a
  row shares with the row before it is known: a row adds a child to the depths from that length on, the words of the shared turns
  are those that it saves, and a row that the next one does not extend is a leaf.

Nodes on the path of a block's last row stay open for the next block. Nodes on the paths of a range's first and last row may go on in
other ranges: their sums are partial, keyed by a digest of the prefix, and are added up over ranges. A range takes its first row for
a new conversation; a pass over the ranges' first and last paths (two rows a range) tells how much that was wrong, as further partial sums.

The digest of the ids that end in a node is taken in order as rows come by. Where a run of alike conversations crosses ranges, or is
longer than ``chunk`` bytes, its text goes on in chunks, which one task a node reads in order with bounded memory.

Rows without a conversation id take no part; null role or text counts as empty; turns are ordered by number (null first), then by id
of the turn. An empty table has no node. A conversation (16 bytes a turn) is one row, and its path one task's; everything else is split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swayline.llm.common import keep

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 1 << 18   # of a block's matrix
CHUNK = 1 << 20   # bytes of joined ids held for one node
ROOT = bytes(16)
NOTHING = sha256(b"").hexdigest()

PIECE = ("kind string, key binary, parent_key binary, parent_conv_id long, depth long, conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends string, place long, first_keys array<binary>, first_words array<long>, last_keys array<binary>")
_ARROW = pa.schema([("kind", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("parent_conv_id", pa.int64()), ("depth", pa.int64()),
                    ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved_tokens", pa.int64()), ("ends", pa.string()), ("place", pa.int64()), ("first_keys", pa.list_(pa.binary())),
                    ("first_words", pa.list_(pa.int64())), ("last_keys", pa.list_(pa.binary()))])


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation id: ``conv_id`` (long) and ``turns``, an array of (id, words) in order."""
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.sha2(whole(role), 256), F.sha2(whole(text), 256)), 256)
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.substring(F.unhex(digest), 1, 16).alias("id"),
                 F.regexp_count(whole(text), F.lit(WORD)).cast("long").alias("words")).alias("turn"))
    listed = F.sort_array(F.collect_list("turn"))  # null turn numbers come first
    return rows.groupBy("conv_id").agg(listed.alias("listed")).select(
        "conv_id", F.transform("listed", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def with_shared_start(convs: DataFrame, source: Column, shared: Column, most: int) -> DataFrame:
    """``convs``, rebuilt: the first ``shared`` turns (at most ``most``) of conversation ``source`` (none if absent), then the own turns after
    the first ``shared``."""
    heads = convs.select(F.col("conv_id").alias("source"), F.slice("turns", 1, most).alias("head"))
    rebuilt = convs.withColumns({"source": source, "shared": shared}).join(heads, "source", "left")
    none = F.slice("turns", 1, 0)
    first = F.coalesce(F.slice("head", F.lit(1), F.col("shared")), none)
    rest = F.when(F.size("turns") > F.col("shared"), F.slice("turns", F.col("shared") + 1, F.size("turns"))).otherwise(none)
    return rebuilt.select("conv_id", F.concat(first, rest).alias("turns"))


@dataclass
class _Ends:
    """The ids that end in a node, joined, as they come."""

    first: int = 0
    parts: list[str] = field(default_factory=list)
    size: int = 0
    chunked: bool = False  # goes on, or began, elsewhere: only chunks tell the whole


@dataclass
class _Open:
    """A node on the path of the last row read."""

    depth: int
    key: bytes
    n: int
    conv: int
    children: int
    leaves: int
    saved: int
    partial: bool  # holds the range's first row
    ends: _Ends | None


def _chain(key: bytes, turn_id: bytes) -> bytes:
    return blake2b(key + turn_id, digest_size=16).digest()


class Shard:
    """The trie of one range, block by block; gives rows of ``PIECE``."""

    def __init__(self, number: int, chunk: int = CHUNK):
        self.number, self.chunk, self.open, self.rows = number, chunk, [], []
        self.last: tuple[bytes, np.ndarray] | None = None  # ids and words of the last row
        self.first_keys: list[bytes] = []
        self.first_words: list[int] = []

    def _row(self, **values) -> None:
        self.rows.append(values)

    def told(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _ARROW], schema=_ARROW)

    def _write(self, ends: _Ends, key: bytes) -> None:
        if ends.parts:
            self._row(kind="chunk", key=key, place=ends.first, ends=",".join(ends.parts))
        ends.parts, ends.size, ends.chunked = [], 0, True

    def _add(self, ends: _Ends | None, ids: list[int], key: bytes | None) -> _Ends:
        ends = ends or _Ends(ids[0])
        if not ends.parts:
            ends.first = ids[0]
        text = ",".join(map(str, ids))
        ends.parts.append(text)
        ends.size += len(text)
        if ends.size > self.chunk and key is not None:
            self._write(ends, key)
        return ends

    def _digest(self, ends: _Ends | None, key: bytes | None, whole: bool = True) -> str | None:
        """The digest of a finished run; none where chunks tell it, or (of a partial node) another range may."""
        if ends is None:
            return NOTHING if whole else None
        if ends.chunked:
            self._write(ends, key)
            return None
        return sha256(",".join(ends.parts).encode()).hexdigest()

    def block(self, convs: np.ndarray, lengths: np.ndarray, ids: list[bytes], words: np.ndarray) -> None:
        """``ids`` and ``words`` are those of all turns of the block, row after row."""
        begin = not self.open
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        ghost = self.last is not None
        if ghost:  # the last row of the block before, which counts no more
            past, past_words = self.last
            ids = [past[i:i + 16] for i in range(0, len(past), 16)] + ids
            words = np.concatenate([past_words, words])
            starts = np.concatenate([[0], starts + len(past) // 16])
            lengths = np.concatenate([[len(past) // 16], lengths])
            convs = np.concatenate([[np.iinfo(np.int64).max], convs])
        n, wide = len(convs), int(lengths.max(initial=0))
        pairs = np.frombuffer(b"".join(ids), ">u8").reshape(-1, 2)
        by_id = np.lexsort((pairs[:, 1], pairs[:, 0]))
        changed = np.ones(len(pairs), bool)
        changed[1:] = (pairs[by_id][1:] != pairs[by_id][:-1]).any(axis=1)
        number = np.empty(len(pairs), np.int32)
        number[by_id] = np.cumsum(changed)  # from 1; 0 is padding
        within = np.arange(wide) < lengths[:, None]
        matrix, weight = np.zeros((n, wide), np.int32), np.zeros((n, wide), np.int64)
        matrix[within], weight[within] = number, words
        real = np.ones(n, np.int64)
        real[0] = not ghost
        order = np.lexsort((convs, real, *matrix.T[::-1]))  # the last row read stays first
        matrix, weight, lengths, starts, convs = matrix[order], weight[order], lengths[order], starts[order], convs[order]
        new = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)  # row, depth - 1: the row starts a node
        shared = np.zeros(n, np.int64)
        shared[1:] = np.minimum(wide - new.sum(axis=1), lengths[1:])
        spent = np.concatenate([np.zeros((n, 1), np.int64), np.cumsum(weight, axis=1)], axis=1)  # words of the first turns
        leaf = np.zeros(n, np.int64)
        leaf[:-1] = shared[1:] < lengths[:-1]
        both = spent[np.arange(n), shared] * real

        last_ids = ids[starts[-1]:starts[-1] + lengths[-1]]
        keys, before = [ROOT], [o.key for o in self.open]
        last_shared = int(shared[1:].min(initial=wide)) if ghost else 0
        for depth in range(1, int(lengths[-1]) + 1):
            keys.append(before[depth] if depth <= last_shared and depth < len(before) else _chain(keys[-1], last_ids[depth - 1]))
        if begin:
            self.first_keys = [ROOT]
            for turn_id in ids[starts[0]:starts[0] + lengths[0]]:
                self.first_keys.append(_chain(self.first_keys[-1], turn_id))
            self.first_words = spent[0, :lengths[0] + 1].tolist()

        opened: list[_Open] = []
        above, above_conv, above_key = None, None, None  # of the depth before: segment of a row, its id (if whole), its key
        for depth in range(wide + 1):
            start = np.flatnonzero(np.concatenate([[True], new[:, depth - 1]])) if depth else np.zeros(1, np.int64)
            segment = np.zeros(n, np.int64)
            segment[start[1:]] = 1
            segment = np.cumsum(segment)
            deep = lengths[start] >= depth
            end = np.concatenate([start[1:], [n]])
            members = np.add.reduceat(real, start)
            conv = np.minimum.reduceat(convs, start)
            children = np.add.reduceat(((shared <= depth) & (lengths > depth)) * real, start)
            leaves = np.add.reduceat(leaf, start)
            saved = np.add.reduceat(np.where(shared >= depth, both - spent[:, max(depth - 1, 0)] * real, 0), start)
            here = np.add.reduceat((lengths == depth) * real, start)
            whole_conv: list[int | None] = [None] * len(start)
            key_of: dict[int, bytes] = {}
            for s in np.flatnonzero(deep).tolist():
                old = self.open[depth] if s == 0 and depth < len(self.open) else None
                stays = int(end[s]) == n
                node = _Open(depth, b"", int(members[s]), int(conv[s]), int(children[s]), int(leaves[s]), int(saved[s]), begin and s == 0, None)
                if old:
                    node = _Open(depth, old.key, node.n + old.n, min(node.conv, old.conv), node.children + old.children,
                                 node.leaves + old.leaves, node.saved + old.saved, old.partial, old.ends)
                if stays:
                    node.key = keys[depth]
                elif node.partial:
                    node.key = node.key or self.first_keys[depth]
                key = node.key or None
                if here[s]:
                    at = int(start[s]) + (s == 0 and ghost)
                    if node.ends is None and begin and s == 0 and lengths[0] == depth:
                        node.ends = _Ends(chunked=True)  # an earlier range may hold more of this run
                    node.ends = self._add(node.ends, convs[at:at + int(here[s])].tolist(), key)
                if stays:
                    opened.append(node)
                if key:
                    key_of[s] = key
                if not stays and not node.partial:
                    whole_conv[s] = node.conv
                up = int(above[start[s]]) if depth else None
                if not stays:
                    self._close(node, None if up is None else above_conv[up], None if up is None else above_key.get(up))
            above, above_conv, above_key = segment, whole_conv, key_of
        self.open = opened
        self.last = b"".join(last_ids), weight[-1, :lengths[-1]].copy()

    def _close(self, node: _Open, parent_conv: int | None, parent_key: bytes | None) -> None:
        self._row(kind="partial" if node.partial else "node", key=node.key or None, parent_key=None if parent_conv is not None else parent_key,
                  parent_conv_id=parent_conv, depth=node.depth, conv_id=node.conv, n_convs=node.n, n_children=node.children,
                  n_leaves=node.leaves, saved_tokens=node.saved, ends=self._digest(node.ends, node.key or None, not node.partial))

    def finish(self) -> None:
        if not self.open:
            return
        end = self.open[-1]
        if end.ends is not None:
            end.ends.chunked = True  # a later range may hold more of this run
        for node in self.open:
            node.partial, node.leaves = True, node.leaves + 1  # the last row, until the next range says otherwise
            self._close(node, None, self.open[node.depth - 1].key if node.depth else None)
        self._row(kind="seam", place=self.number, first_keys=self.first_keys, first_words=self.first_words, last_keys=[o.key for o in self.open])


def _pieces(cells: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(TaskContext.get().partitionId(), chunk)
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            start = 0
            while start < batch.num_rows:
                size = np.maximum(np.maximum.accumulate(lengths[start:]), 1) * np.arange(1, batch.num_rows - start + 1)
                some = max(1, int(np.searchsorted(size, cells, side="right")))
                part = batch.slice(start, some)
                turns = part.column(1).flatten()
                shard.block(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), lengths[start:start + some],
                            turns.field(0).to_pylist(), turns.field(1).to_numpy(zero_copy_only=False).astype(np.int64))
                start += some
                if shard.rows:
                    yield shard.told()
        shard.finish()
        if shard.rows:
            yield shard.told()

    return run


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per seam between two ranges: what the later's first row and the earlier's last row counted too much or too little."""
    shard = Shard(-1)
    for batch in batches:
        for last, first, words in zip(*(c.to_pylist() for c in batch.columns)):
            alike = sum(a == b for a, b in zip(last, first)) - 1  # keys of equal prefixes are equal
            for depth in range(alike + 1):
                shard._row(kind="partial", key=first[depth], depth=depth, n_convs=0, n_children=-int(depth < alike), n_leaves=0,
                           saved_tokens=words[alike] - words[max(depth - 1, 0)])
            if alike == len(last) - 1:
                for depth, key in enumerate(last):
                    shard._row(kind="partial", key=key, depth=depth, n_convs=0, n_children=0, n_leaves=-1, saved_tokens=0)
        if shard.rows:
            yield shard.told()


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of runs from their chunks, which come in order."""
    key, digest = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["same", "joined"])
    for batch in batches:
        for mine, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if mine != key:
                if digest:
                    yield out()
                key, digest = mine, sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
    if digest:
        yield out()


def nodes(convs: DataFrame, ranges: int | None = None, cells: int = CELLS, chunk: int = CHUNK) -> DataFrame:
    """One row per node of the trie of ``convs`` (``conv_id``, ``turns``): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. ``ranges``: how many, else as many as Spark's shuffles have.
    ``cells`` bounds a block's matrix, ``chunk`` the joined ids held for one node."""
    order = ["turns", "conv_id"]
    dealt = convs.repartitionByRange(ranges, *order) if ranges else convs.repartitionByRange(*order)
    ordered = dealt.sortWithinPartitions(*order).select("conv_id", "turns")
    pieces = keep(ordered.mapInArrow(_pieces(cells, chunk), PIECE), "pieces")
    seams = pieces.filter("kind = 'seam'").select(
        "last_keys", *(F.lead(c).over(Window.orderBy("place")).alias(c) for c in ("first_keys", "first_words")))  # one row a range
    wrong = seams.filter("first_keys is not null").mapInArrow(_corrections, PIECE)
    measures = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = (pieces.filter("kind = 'partial'").unionByName(wrong).groupBy("key")
              .agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                   *(F.sum(c).alias(c) for c in measures), F.max("ends").alias("ends"))
              .withColumn("parent_conv_id", F.lit(None).cast("long")))
    columns = ["key", "parent_key", "parent_conv_id", "depth", "conv_id", *measures, "ends"]
    merged = keep(merged.select(columns), "merged")
    named = pieces.filter("kind = 'node' and key is not null").select("key", "conv_id").unionByName(merged.select("key", "conv_id")).select(
        F.col("key").alias("named"), F.col("conv_id").alias("above"))
    ends = (pieces.filter("kind = 'chunk'").select("key", "ends", "place").repartition("key").sortWithinPartitions("key", "place")
            .select("key", "ends").mapInArrow(_joined_ends, "same binary, joined string"))
    whole = pieces.filter("kind = 'node'").select(columns)
    keyed = whole.filter("key is not null").unionByName(merged)
    keyed = keyed.join(ends, keyed["key"] == ends["same"], "left").withColumn("ends", F.coalesce("joined", "ends")).select(columns)
    every = whole.filter("key is null").unionByName(keyed)
    # Rows that need no parent looked up are not sent to the join.
    looked = every.filter("parent_key is not null")
    looked = looked.join(named, looked["parent_key"] == named["named"], "left").withColumn("parent_conv_id", F.col("above"))
    result = ["conv_id", "depth", "parent_conv_id", *measures, F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")]
    return every.filter("parent_key is null").select(result).unionByName(looked.select(result))
