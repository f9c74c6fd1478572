import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from swayline.llm import toxicity
from swayline.llm.queries import op4_toxicity
from tests.llm.common import AWKWARD, documents


def test_nearest_is_exact():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(700):
        terms = rng.choice(60, rng.integers(1, 8), replace=False)
        weights = rng.integers(1, 4, len(terms)).astype(float)
        rows.append(dict(zip(terms.tolist(), (weights / np.linalg.norm(weights)).tolist())))
    triples = [(i, t, w) for i, r in enumerate(rows) for t, w in r.items()]
    index = toxicity.BlockMaxIndex(*(np.array(x) for x in zip(*triples)), len(rows))
    dense = np.zeros((len(rows), 60))
    for i, r in enumerate(rows):
        for t, w in r.items():
            dense[i, t] = w
    for q in range(0, 700, 23):
        scores = dense @ dense[q]
        found = index.nearest(rows[q], 10, without=q)
        scores[q] = 0
        want = np.sort(scores[scores > 0])[::-1][:10]
        assert np.allclose([s for s, _ in found], want)
        assert all(np.isclose(scores[r], s) for s, r in found) and len({r for _, r in found}) == len(found)


def test_monotone():
    votes, rates = toxicity._monotone([0.1, 0.2, 0.2, 0.9, 0.5], [0, 1, 0, 1, 0])
    assert (np.diff(votes) > 0).all() and (np.diff(rates) >= 0).all() and rates[-1] > 0.5


def test_equal_votes_are_one_pool():
    votes, rates = toxicity._monotone([0.1] * 10 + [0.5] * 20 + [0.9] * 20, [0] * 9 + [1] + [0] * 10 + [1] * 10 + [0] * 4 + [1] * 16)
    assert votes.tolist() == [0.1, 0.5, 0.9] and np.allclose(rates, [1.5 / 11, 10.5 / 21, 16.5 / 21])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = op4_toxicity(spark, folder)
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    good = [r["score"] for r in rows if r["toxic"] == 1]
    rest = [r["score"] for r in rows if r["toxic"] == 0]
    assert sum(s >= 0.5 for s in good) >= 0.85 * len(good) and sum(s < 0.5 for s in rest) >= 0.98 * len(rest)


def test_labels_are_no_input(spark):
    texts = [(i, random.Random(i).choice(["nice day", "you idiot fool", "calm water", "idiot again"]) + f" w{i % 7}") for i in range(400)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int("idiot" in t)) for i, t in texts], "doc_id long, toxic int")
    usable = F.col("doc_id") % 5 != 0
    a = toxicity.score(docs, toxicity.fit(docs, labels, usable)).orderBy("doc_id").collect()
    turned = labels.withColumn("toxic", F.when(usable, F.col("toxic")).otherwise(1 - F.col("toxic")))
    b = toxicity.score(docs, toxicity.fit(docs, turned, usable)).orderBy("doc_id").collect()
    assert a == b
    assert all((r["score"] >= 0.5) == ("idiot" in t) for r, (_, t) in zip(a, texts))
    assert all(e["doc_id"] % 5 for r in a for e in r["evidence"])


def test_awkward_and_empty(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (7, 1), (7, 0), (99, 1)], "doc_id long, toxic int")
    docs, none = documents(spark, AWKWARD), documents(spark, [])
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect())
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    kept = toxicity.without_toxic(docs, toxicity.fit(docs, labels.limit(0)))
    assert kept.columns == docs.columns and kept.count() == len(AWKWARD)


def test_copies_are_one_example(spark):
    """A group of copies does not crowd out the other examples."""
    texts = [(i, random.Random(i).choice(["nice day", "you idiot fool", "calm water", "idiot again"]) + f" w{i}") for i in range(300)]
    copies = [(i, "the same idle page idle page") for i in range(1000, 1900)]
    labels = [(i, int("idiot" in t)) for i, t in texts] + [(i, int(i % 3 == 0)) for i, _ in copies]
    model = toxicity.fit(documents(spark, texts + copies), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert sum(i >= 1000 for i in model.ids) <= 1
    rows = toxicity.score(documents(spark, texts + copies), model).collect()
    marked = dict(texts)
    assert all((r["score"] >= 0.5) == ("idiot" in marked[r["doc_id"]]) for r in rows if r["doc_id"] in marked)
    assert all(e["label"] in (0, 1) for r in rows for e in r["evidence"])


def test_words_of_whole_texts_are_compared_exactly():
    rng = np.random.default_rng(2)
    often = rng.random((500, 40)) < 0.5
    seldom = rng.random((500, 300)) < 0.02
    dense = np.hstack([often, seldom]) * rng.random((500, 340))
    dense[7] = 0
    norms = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, norms, out=np.zeros_like(dense), where=norms > 0)
    row, word = np.nonzero(dense)
    index = toxicity.WordIndex(row, word, dense[row, word], 500, 340)
    for q in range(0, 500, 7):
        words = np.flatnonzero(dense[q])
        (products, rows), = index.nearest([(words, dense[q][words])], 10, without=[q])
        scores = dense @ dense[q]
        assert np.allclose(products, scores[rows])
        scores[q] = 0
        assert np.allclose(products, np.sort(scores[scores > 0])[::-1][:10])


def _word(kind, i):
    """Words without a common beginning."""
    return "".join(random.Random(f"{kind}{i}").choices("abcdefghijklmnopqrstuvwxyz", k=9))


def _by_words(spark):
    """Calm texts, and toxic ones whose marked words are in three examples only: too few for a kept feature."""
    rng = random.Random(5)
    calm = [(i, " ".join(rng.choices([_word("plain", j) for j in range(60)], k=8))) for i in range(200)]
    toxic = [(1000 + i, f"{_word('grim', i // 3)} {_word('foul', i // 3)} {_word('grim', i // 3)} {_word('odd', i)}") for i in range(60)]
    labels = spark.createDataFrame([(i, 0) for i, _ in calm] + [(i, 1) for i, _ in toxic], "doc_id long, toxic int")
    return calm, toxic, labels


def test_words_that_few_examples_have_count(spark):
    calm, toxic, labels = _by_words(spark)
    others = [(5000 + i, t) for i, (_, t) in enumerate(toxic[::3])] + [(6000 + i, f"{_word('grim', i)} {_word('foul', i)} unheard{i}") for i in range(20)]
    docs = documents(spark, calm + toxic + others)
    model = toxicity.fit(docs, labels)
    assert not model.numbers  # no feature is kept
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(rows[i]["predicted"] == 1 and rows[i]["evidence"][0]["label"] == 1 for i, _ in others)
    assert all(rows[i]["predicted"] == 0 for i, _ in calm)
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {i for i, _ in calm}


def test_cosines_are_those_of_whole_texts(spark):
    """Also words that no example has are weighed, by their frequency in all documents."""
    calm, toxic, labels = _by_words(spark)
    others = [(7000 + i, f"{_word('plain', i)} {_word('plain', i + 1)} {_word('grim', i % 20)} new{i % 4} own{i} own{i}") for i in range(40)]
    docs = calm + toxic + others
    df = Counter(w for _, t in docs for w in set(t.split()))
    def vector(t):
        raw = {w: (1 + np.log(n)) * (np.log((len(docs) + 1) / (df[w] + 1)) + 1) for w, n in Counter(t.split()).items()}
        norm = np.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()}
    examples = {i: vector(t) for i, t in calm + toxic}
    rows = {r["doc_id"]: r for r in toxicity.score(documents(spark, docs), toxicity.fit(documents(spark, docs), labels)).collect()}
    for i, t in others:
        mine = vector(t)
        cosines = {j: sum(x * v.get(w, 0) for w, x in mine.items()) for j, v in examples.items()}
        got = rows[i]["evidence"]
        assert np.allclose([e["similarity"] for e in got], sorted(cosines.values())[::-1][:3])
        assert all(np.isclose(e["similarity"], cosines[e["doc_id"]]) for e in got)


def test_blocks_are_judged_by_sums_not_by_sums_of_maxima():
    """Six blocks: four hold near examples, two have all of a text's words, but one to an example. Only the four are scored."""
    size, k = 6 * toxicity.BLOCK, 3
    entries = [(row, 0, 0.01) for row in range(size)]  # a word of many examples
    entries += [(row, 1 + row // toxicity.BLOCK, 0.9) for at in range(4) for row in range(at * toxicity.BLOCK, at * toxicity.BLOCK + 5)]
    entries += [(row, 5 + row % toxicity.BLOCK, 0.5 + row / 1000) for row in range(4 * toxicity.BLOCK, size)]
    row, word, weight = (np.array(x) for x in zip(*entries))
    words = 5 + toxicity.BLOCK
    index = toxicity.WordIndex(row, word, weight, size, words)
    whole, seen = index.often, []

    class Watched:
        shape = whole.shape

        def __getitem__(self, rows):
            seen.append(rows.start // toxicity.BLOCK)
            return whole[rows]

    index.often = Watched()
    query = np.array([1.0, *[1.0, 0.9, 0.8, 0.7], *[0.1] * toxicity.BLOCK])
    (scores, rows), = index.nearest([(np.arange(words), query)], k)
    held = np.zeros((size, words))
    held[row, word] = weight
    want = np.lexsort((np.arange(size), -(held @ query)))[:k]
    assert rows.tolist() == want.tolist() and np.allclose(scores, (held @ query)[want], rtol=0, atol=1e-12)
    assert sorted(seen) == [0, 1, 2, 3]


def test_plain_texts_have_the_same_words():
    for text in ("", "Plain text_1, x-y 2.5\n\tEND", "naïve Ünder_9 İstanbul Kelvin K ٠١ z", "a\x1cb\x7fc\x85d"):
        assert toxicity.words_of(text) == toxicity.WORD.findall(text.lower())


def test_ordinary_texts_are_not_searched_character_by_character(monkeypatch):
    """Words come from replacing what is in no word; the pattern is for texts with very many other characters, or a capital sigma."""
    texts = ("Plain text_1, x-y 2.5\n\tEND", "naïve Ünder_9 — “İstanbul” ’s ٠١ z Ǆ")
    want = [toxicity.WORD.findall(t.lower()) for t in texts]
    class Characters:
        def match(self, text):
            assert len(text) == 1
            return text.isalnum() or text == "_"

    monkeypatch.setattr(toxicity, "WORD", Characters())
    toxicity._in_words.cache_clear()
    assert [toxicity.words_of(t) for t in texts] == want


def test_words_of_any_character():
    signs = "".join(map(chr, range(0x2010, 0x2060)))
    for text in (*(f"Aa{chr(c)}B " for c in range(0, 0x3000)), *(f"Aa{chr(c)}B " for c in range(0x3000, 0x110000, 97)), "ΟΔΟΣ ΣΑΣ Σ", f"A {'b'.join(signs)}É"):
        assert toxicity.words_of(text) == toxicity.WORD.findall(text.lower())


def test_words_of_many_documents_come_first(spark):
    """What is looked up most lies together; the order is the same in every run."""
    docs = [(i, " ".join(["every", *["third"] * (i % 3 == 0), *["tenth"] * (i % 10 == 0), *["alone"] * (i == 7), "idiot" if i % 2 else "calm"])) for i in range(60)]
    model = toxicity.fit(documents(spark, docs), spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int"))
    assert list(model.words) == ["every", "calm", "idiot", "third", "tenth", "alone"]
