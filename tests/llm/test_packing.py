import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from swayline.llm import packing
from swayline.llm.tokens import WordEncoder
from tests.llm.common import AWKWARD, documents

LIBRARY = Tokenizer.from_file(packing.VOCABULARY)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def whole(rows, texts, capacity):
    """Every document's pieces are there, in order, and every sequence is gapless and within ``capacity``."""
    want = []
    for i, t in texts:
        ids = ids_of(t)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            want.append((i, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(repr, ((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows))) == sorted(map(repr, want))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in rows)


def test_awkward(spark):
    whole(packing.pack_documents(documents(spark, AWKWARD)).collect(), AWKWARD, 4096)
    whole(packing.pack_documents(documents(spark, AWKWARD), capacity=64).collect(), AWKWARD, 64)


def test_whole_table_is_nearly_full(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for shard in (4096, 128):
        rows = packing.pack(packing.pieces(docs), shard_pieces=shard).collect()
        sequences, tokens = whole(rows, texts, 4096)
        assert sequences <= 1.02 * -(-tokens // 4096) + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB'st ,.\t\n\x0b\x1c\x85 éÉéΣΟΣİ日本ªºµßÿ×÷½😀1²<|endoftext|>", max_size=40), max_size=5))
def test_chunks_give_the_ids_of_the_whole(texts):
    got = WordEncoder(packing.VOCABULARY).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(t)[:-1] for t in texts]


def test_special_strings_and_full_cache(monkeypatch):
    from swayline.llm import tokens
    monkeypatch.setattr(tokens, "KNOWN", 8)
    coder = WordEncoder(packing.VOCABULARY)
    for texts in (["a<|endoftext|>b one two three", "x" * 100], ["one four five", "two six"], ["one two x " + "y" * 60]):
        assert [np.frombuffer(g, "<u4").tolist() for g in coder.encode(texts)] == [ids_of(t)[:-1] for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_every_step_has_the_smallest_sum(lengths):
    sequence, offset, gaps = packing.pack_lengths(np.array(lengths, np.int64), 12)
    state = {}
    for item in np.argsort(-np.array(lengths, np.int64), kind="stable"):
        size, number = lengths[item], int(sequence[item])

        def value(change):
            after = {**state, **change}
            counts = defaultdict(int)
            for g in after.values():
                counts[g] += g > 0
            return sum(n * n for n in counts.values())

        options = [value({b: g - size}) for b, g in state.items() if g >= size] + [value({-1: 12 - size})]
        assert value({number: state.get(number, 12) - size}) == min(options)
        assert offset[item] == 12 - state.get(number, 12)
        state[number] = state.get(number, 12) - size
    assert gaps.tolist() == [state[k] for k in range(len(state))]


def test_pieces_that_never_pair_end(spark):
    cut = spark.range(500).selectExpr("id doc_id", "0 piece", "0L start", "cast(60 + id % 5 as long) length", "0L ids_crc32")
    rows = packing.pack(cut, capacity=100, shard_pieces=50).collect()
    assert len({r["sequence_id"] for r in rows}) == 500


def test_empty(spark):
    assert packing.pack_documents(documents(spark, [])).count() == 0
