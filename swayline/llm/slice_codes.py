"""Vector codes: vectors are cut into equal parts, and each part is replaced by the number of its codebook's nearest entry.

Components become integers, floor(``scale`` * x), so every sum and distance is exact. The codebook of a part position starts as that
part of the ``entries`` smallest keys. Each of ``rounds`` rounds assigns every part to its nearest entry (squared Euclidean distance,
ties to the lower number) and replaces every entry by the floored mean of its parts; an unused entry stays. A round is one pass over
the written integers: tasks add up their parts, Spark adds up the tasks, and the driver sees one sum per entry and component.

The nearest entry is found by slice and intersect. On every dimension the entries are sorted by their coordinate, and a prefix mask
tells which entries come before a place. A radius around a part selects a range of places on each dimension; the masks of the ranges,
ANDed as 64-bit words, are the entries inside the cube. If the best of them lies within the radius it is the nearest of all;
otherwise the radius becomes its distance (an empty cube doubles it) and the part is looked up again.

Rows whose vector is null or holds null or non-finite components are dropped. Of the others those take part whose vector is as long
as that of the smallest key which has a length divisible by ``parts``, and whose integers stay below 2 ** 27; the rest keep their
row with null code and error. Rows without a key are coded but give no first entries; rows that share a key are ordered by vector.
Fewer than ``entries`` rows make a smaller codebook; an empty table an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swayline.llm.common import keep

LARGEST = 1 << 27  # squares of differences of up to 64 components add up below 2 ** 63
BLOCK = 4096       # vectors in one search


class Slices:
    """Exact nearest entry of one codebook (entry by dimension, integers)."""

    def __init__(self, entries: np.ndarray):
        count, dimensions = entries.shape
        self.entries, self.words = entries, -(-count // 64)
        bits = np.zeros((count, self.words), np.uint64)
        places = np.arange(count)
        bits[places, places // 64] = np.uint64(1) << (places % 64).astype(np.uint64)
        order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(entries.T, order, axis=1)           # dimension, place -> coordinate
        self.before = np.zeros((dimensions, count + 1, self.words), np.uint64)  # dimension, place -> entries before it
        np.bitwise_or.accumulate(bits[order], axis=1, out=self.before[:, 1:])
        apart = ((entries[:, None] - entries[None]) ** 2).sum(axis=2) if count <= 256 else np.zeros((1, 1))
        other = apart[~np.eye(len(apart), dtype=bool)]
        self.radius = int(np.sqrt(np.median(other)) / 2) + 1 if len(other) else 1

    def inside(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ from a part by at most its radius on every dimension."""
        mask = np.full((len(parts), self.words), ~np.uint64(0))
        for values, line, before in zip(parts.T, self.sorted, self.before):
            first = np.searchsorted(line, values - radius)
            last = np.searchsorted(line, values + radius, side="right")
            mask &= before[last] ^ before[first]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and squared distance to it, ties to the lower number."""
        number, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        left, radius = np.arange(len(parts)), np.full(len(parts), self.radius)
        while len(left):
            mask = self.inside(parts[left], radius)
            bits = np.unpackbits(mask.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :len(self.entries)]
            row, entry = np.nonzero(bits)
            found = ((parts[left[row]] - self.entries[entry]) ** 2).sum(axis=1)
            least = np.full(len(left), np.iinfo(np.int64).max)
            np.minimum.at(least, row, found)
            best = np.flatnonzero(found == least[row])[::-1]  # from the back: the lowest number is written last
            chosen = np.zeros(len(left), np.int64)
            chosen[row[best]] = entry[best]
            empty = np.bincount(row, minlength=len(left)) == 0
            done = ~empty & (least <= radius ** 2)
            number[left[done]], distance[left[done]] = chosen[done], least[done]
            wider = np.where(empty, 2 * radius, np.sqrt(np.where(empty, 0, least).astype(float)).astype(np.int64) + 1)
            left, radius = left[~done], wider[~done]
        return number, distance


def integers(rows: DataFrame, vector: str, scale: int, keep_columns: Sequence[Column]) -> DataFrame:
    """``keep_columns`` and ``values`` (integers; null where one is too large) of the rows with a whole, finite vector."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fits = F.forall(vector, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < float(LARGEST))
    return rows.filter(F.col(vector).isNotNull() & finite).select(*keep_columns, F.when(fits, scaled).alias("values"))


def _matrix(column: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and their integers."""
    counts = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fit = np.flatnonzero(counts == length)
    taken = column.take(pa.array(fit))
    return fit, taken.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(fit), max(length, 0))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


class Codebooks:
    """``entries``: part, number, component -> integer. Bounded by its parameters, whatever the table's size."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2] if self.entries.size else -1

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, row by part."""
        parts, _, wide = self.entries.shape
        found = [Slices(self.entries[p]).nearest(vectors[:, p * wide:(p + 1) * wide]) for p in range(parts)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: str, scale: int = 4096) -> list[float]:
        """The vector that a code stands for."""
        numbers = [int(code[i:i + 2], 16) for i in range(0, len(code), 2)]
        return [x / scale for p, number in enumerate(numbers) for x in self.entries[p, number].tolist()]


def fit(written: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, key: str = "key") -> Codebooks:
    """Codebooks of a written table with ``key`` and ``values``."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    usable = written.filter(F.col(key).isNotNull() & (F.size("values") > 0) & (F.size("values") % parts == 0))
    first = usable.orderBy(key, "values").select("values").first()
    length = len(first["values"]) if first else 0
    smallest = [r["values"] for r in usable.filter(F.size("values") == length).orderBy(key, "values").select("values").limit(entries).collect()]
    wide = length // parts
    books = Codebooks(np.array(smallest, np.int64).reshape(len(smallest), parts, wide).transpose(1, 0, 2).copy())
    for _ in range(rounds if smallest else 0):
        books = _round(written, books)
    return books


def _round(written: DataFrame, books: Codebooks) -> Codebooks:
    parts, count, wide = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros((parts, count, wide), np.int64), np.zeros((parts, count), np.int64)
        for block in _blocks(batches):
            _, vectors = _matrix(block.column(0), books.length)
            numbers, _ = books.assign(vectors)
            for p in range(parts):
                np.add.at(total[p], numbers[:, p], vectors[:, p * wide:(p + 1) * wide])
                met[p] += np.bincount(numbers[:, p], minlength=count)
        part, entry = np.nonzero(met)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (np.repeat(part, wide), np.repeat(entry, wide), np.tile(np.arange(wide), len(part)),
                                   total[part, entry].ravel(), np.repeat(met[part, entry], wide))], ["part", "entry", "place", "total", "n"])

    sums = (written.select("values").mapInArrow(add, "part long, entry long, place long, total long, n long")
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    entries = books.entries.copy()
    for r in sums.collect():  # at most one row per entry and component
        entries[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return Codebooks(entries)


def encode(written: DataFrame, books: Codebooks) -> DataFrame:
    """The columns of ``written`` without ``values``, with ``code`` (two hex digits a part) and ``error`` (squared distances summed)."""
    names = [c for c in written.columns if c != "values"]
    schema = T.StructType([*(written.schema[c] for c in names), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            fit_rows, vectors = _matrix(block.column(len(names)), books.length)
            codes, errors = [None] * block.num_rows, [None] * block.num_rows
            if len(fit_rows):
                numbers, distances = books.assign(vectors)
                for row, text, error in zip(fit_rows, (bytes(r).hex() for r in numbers.astype(np.uint8)), distances.sum(axis=1).tolist()):
                    codes[row], errors[row] = text, error
            yield pa.RecordBatch.from_arrays([*block.columns[:len(names)], pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=schema.names)

    return written.select(*names, "values").mapInArrow(code, schema)


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", carry: Sequence[str] = (), scale: int = 4096, parts: int = 8,
             entries: int = 16, rounds: int = 6) -> tuple[DataFrame, Codebooks]:
    """Coded rows (``key``, ``carry``, ``code``, ``error``) and the codebooks. The integers are written once and read in every round."""
    carried = [f"carried_{i}" for i in range(len(carry))]
    written = keep(integers(rows, vector, scale, [F.col(key).alias("key"), *(F.col(c).alias(n) for c, n in zip(carry, carried))]), "integers")
    books = fit(written, parts, entries, rounds)
    coded = encode(written, books).select(F.col("key").alias(key), *(F.col(n).alias(c) for c, n in zip(carry, carried)), "code", "error")
    return coded, books


def with_group_error(coded: DataFrame, group: str, out: str) -> DataFrame:
    """``coded`` with ``error`` summed over equal ``group`` values, nulls together. Sums are small rows joined back, so no group is one task."""
    coded = keep(coded, "coded")
    sums = coded.groupBy(F.col(group).alias("same")).agg(F.sum("error").alias(out))
    return coded.join(sums, coded[group].eqNullSafe(sums["same"]), "left").drop("same")
