"""Document fingerprints: a homomorphic multiset hash of a document's paragraphs.

Every paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors, component by component
modulo 2 ** 16. So the order of paragraphs does not matter, repeats count, and a paragraph is inserted or deleted by adding or
subtracting its vector, without the rest of the document. Fingerprints are those vectors, two bytes a component, in hex.

A vector has two parts. The first ``LIMBS`` components are uniform (an extendable hash of the paragraph): they differ unless the
multisets of paragraphs are equal. The other ``BUCKETS`` are a signed count of the paragraph's windows of ``WINDOW`` code points (each
window adds 1 or -1 to the bucket that its hash names): sums of them estimate inner products between multisets of windows. The
likeness of two fingerprints is the inner product over what both have together (both squares less the product), between 0 and 1; equal
fingerprints have 1. It estimates with a spread of about ``BUCKETS`` ** -0.5.

Paragraphs are the pieces between line feeds; empty ones do not count. A text without any (null, empty, line feeds only) has the zero
fingerprint. Equal texts have equal fingerprints, as have texts with the same paragraphs in another order.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256, shake_128

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from swayline.llm.common import small_batches, whole_text

LIMBS, BUCKETS, WINDOW = 32, 256, 8
STEP = 1 << 16    # code points hashed at a time
FACTOR = 0x9E3779B97F4A7C15
SAMPLED = 32      # ids looked at for each bucket's border
BUCKET_ROWS = 4096


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix: every bit of the outcome depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(paragraphs: list[str]) -> np.ndarray:
    """Signed counts of the windows that begin at each code point; those at a paragraph's end run into padding."""
    counts = np.zeros(BUCKETS, np.int64)
    points = np.frombuffer(("\n" * (WINDOW - 1)).join([*paragraphs, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(points) - WINDOW + 1, STEP):
        some = points[start:start + STEP + WINDOW - 1].astype(np.uint64)
        value, factor, size = some, FACTOR, 1
        while size < WINDOW:  # a window's value from those of its halves
            value = value[:-size] * np.uint64(factor) + value[size:]
            factor, size = factor * factor % (1 << 64), size * 2
        value = _mixed(value[some[:len(value)] != 10])
        counts += np.bincount((value >> np.uint64(32)).astype(np.int64) % BUCKETS, (value & np.uint64(1)).astype(float) * 2 - 1, BUCKETS).astype(np.int64)
    return counts


def paragraphs(text: str) -> list[str]:
    return [p for p in text.split("\n") if p]


def vector(found: list[str]) -> np.ndarray:
    """The sum of the vectors of ``found`` paragraphs."""
    out = np.zeros(LIMBS + BUCKETS, np.uint16)
    if found:
        wide = b"".join(shake_128(p.encode("utf-8", "surrogatepass")).digest(2 * LIMBS) for p in found)
        out[:LIMBS] = np.frombuffer(wide, "<u2").reshape(-1, LIMBS).sum(axis=0, dtype=np.uint64) & 0xFFFF
        out[LIMBS:] = _windows(found) & 0xFFFF
    return out


def insert(fingerprint: np.ndarray, found: list[str]) -> np.ndarray:
    return fingerprint + vector(found)  # components of 16 bits wrap


def delete(fingerprint: np.ndarray, found: list[str]) -> np.ndarray:
    return fingerprint - vector(found)


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype("<u2").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), "<u2").astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; the components' counts are read as signed."""
    if (a == b).all():
        return 1.0
    x, y = (v[LIMBS:].astype(np.int16).astype(float) for v in (a, b))
    product = float(x @ y)
    both = float(x @ x + y @ y) - product
    return min(max(product / both, 0.0), 1.0) if both else 0.0


def spliced(text: str, next_text: str) -> str:
    """``text`` with its last quarter replaced by as many code points of the beginning of ``next_text``."""
    size = len(text) // 4
    return text[:len(text) - size] + next_text[:size]


def edited(fingerprint: np.ndarray, text: str, changed: str, alike: int) -> np.ndarray:
    """The fingerprint of ``changed`` from that of ``text``, which begins with the same ``alike`` code points: only later paragraphs are hashed."""
    cut = text.rfind("\n", 0, alike) + 1
    return insert(delete(fingerprint, paragraphs(text[cut:])), paragraphs(changed[cut:]))


# documents in the order of their ids, each with the one after it

def _borders(docs: DataFrame, doc_id: str) -> list:
    """Ids at which buckets begin, the smallest of all first. They come from a hash sample of the ids alone, which only places borders."""
    ids = docs.select(F.col(doc_id).alias("id")).filter("id is not null")
    told = ids.agg(F.count("*").alias("n"), F.min("id").alias("least")).first()
    if not told["n"]:
        return []
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-told["n"] // BUCKET_ROWS))
    every = max(1, told["n"] // (buckets * SAMPLED))
    sample = sorted(r["id"] for r in ids.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).distinct().collect())
    return sorted({told["least"], *sample[::max(1, len(sample) // buckets)]})


def ordered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``place``, ``follows``, ``id`` and ``text``, dealt by ``place`` (ranges of ids, from 1) and sorted. The first document of a range is there a
    second time, ``follows`` = 1, behind the range before; that of the first range behind the last. Null ids are in places below 0."""
    found = _borders(docs, doc_id)
    borders = docs.sparkSession.sparkContext.broadcast(found)
    chosen = small_batches(docs).select(F.col(doc_id).alias("id"), whole_text(text).alias("text"))

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array) -> pa.Array:
        starts, out = borders.value, []
        for value in ids.to_pylist():
            at = 0 if value is None else bisect_right(starts, value)
            out.append([at, (at - 1) or len(starts)] if at and starts[at - 1] == value else [at])
        return pa.array(out, pa.list_(pa.int32()))

    loose = -1 - F.pmod(F.xxhash64("text"), F.lit(max(1, len(found)))).cast("int")
    dealt = chosen.select("id", "text", F.posexplode(places("id")).alias("follows", "place"))
    return (dealt.withColumn("place", F.when(F.col("place") == 0, loose).otherwise(F.col("place")))
            .repartition("place").sortWithinPartitions("place", "follows", "id", "text").select("place", "follows", "id", "text"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_chars``, ``edited_sha256`` (of the text whose last quarter gave way to the beginning of the next document),
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``, likenesses of the fingerprint to that of the edited text and that of
    the next document.

    The next document is that of the next id; after the last comes the first. Rows that share an id follow each other by their text, in
    one task's stream. A row without an id is its own next document. Null texts are empty.
    """
    rows = ordered(docs, doc_id, text)
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")])

    def told(document: tuple, next_text: str, next_print: np.ndarray) -> tuple:
        _, value, mine, own = document
        changed = spliced(mine, next_text)
        other = edited(own, mine, changed, len(mine) - len(mine) // 4)
        return (value, len(mine), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(own), as_text(other),
                likeness(own, other), likeness(own, next_print))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document before, which waits for its next one
        for batch in batches:
            out = []
            values = batch.column(2)
            for row, (place, follows, mine) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3))):
                if follows and held is None:
                    continue  # another document with the id of the first
                mine = mine.as_py()
                own = vector(paragraphs(mine))
                document = (place, values[row].as_py(), mine, own)
                if place < 0:
                    out.append(told(document, mine, own))
                    continue
                if held is not None:
                    out.append(told(held, mine, own))
                held = None if follows else document
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out), kinds)], names=schema.names)

    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    return rows.mapInArrow(stream, schema).withColumnRenamed("id", doc_id)
