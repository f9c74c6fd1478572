import itertools
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from swayline.llm import viterbi
from tests.llm.common import AWKWARD, documents

TABLE = viterbi.Pieces(viterbi.VOCABULARY)


def best_score(text):
    best = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + TABLE.longest) + 1):
            if text[i:j] in TABLE.known:
                best[j] = max(best[j], best[i] + TABLE.known[text[i:j]][1])
        if text[i] not in TABLE.known:
            best[i + 1] = max(best[i + 1], best[i] + TABLE.unknown)
    return best[-1]


def score_of(ids, text):
    names = {i: s for i, s in TABLE.known.values()}
    unknown = sum(c not in TABLE.known for c in text)
    return sum(names[i] for i in ids if i in names) + unknown * TABLE.unknown


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="thernadiog .,\nABé日😀\u0000", max_size=60))
def test_best_and_reversible(text):
    ids = np.frombuffer(TABLE.encode(text), "<u4").tolist()
    marked = viterbi.BLANK + text.replace(" ", viterbi.BLANK) if text else ""
    assert score_of(ids, marked) == pytest.approx(best_score(marked))
    assert TABLE.decode(TABLE.encode(text)) == text


def test_commits_early_and_holds_little():
    text = "therandtheirnationing" * 400
    portions = list(TABLE.stream(itertools.chain.from_iterable([text[i:i + 7]] for i in range(0, len(text), 7))))
    assert len(portions) > 50 and max(map(len, portions)) < 60
    assert [i for p in portions for i in p] == [i for p in TABLE.stream([text]) for i in p]
    assert score_of([i for p in portions for i in p], text) == pytest.approx(best_score(text))


def test_against_the_library(spark):
    """The library's own lattice over the same pieces, read as a unigram vocabulary."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    model.ParseFromString(open(viterbi.VOCABULARY, "rb").read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    words = sorted({w for r in rows for w in r["text"].split() if all(c in TABLE.known for c in w)})[::17]
    for word in words:
        best = library.nbest_encode_as_ids(word, 4)
        marked = viterbi.BLANK + word
        assert score_of(np.frombuffer(TABLE.encode(word), "<u4").tolist(), marked) == max(score_of(b, marked) for b in best)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(viterbi, "CACHED", 5)
    table = viterbi.Pieces(viterbi.VOCABULARY)
    text = " ".join(f"word{i % 40}" for i in range(400))
    assert table.encode(text) == TABLE.encode(text) and len(table.young) <= 5


def test_queries(spark):
    rows = viterbi.digest(documents(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r["restored"] for r in rows if r["doc_id"] != 12) and not next(r for r in rows if r["doc_id"] == 12)["restored"]
    ids = {repr(r["doc_id"]): r["ids"] for r in viterbi.encode(documents(spark, AWKWARD)).collect()}
    for r in rows:
        if r["doc_id"] is not None:
            raw = np.array(ids[repr(r["doc_id"])], "<u4").tobytes()
            assert r["n_ids"] == len(raw) // 4 and r["ids_crc32"] == zlib.crc32(raw)
    assert viterbi.digest(documents(spark, [])).count() == 0
