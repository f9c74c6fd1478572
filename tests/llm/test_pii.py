import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from swayline.llm import pii
from tests.llm.common import AWKWARD, documents


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0011239.@a-+() %b", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_patterns_whole_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()] + AWKWARD
    got = {(r["doc_id"], r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in pii.find(documents(spark, texts)).collect()}
    want = set()
    for i, t in texts:
        found = brute(t)
        digest = hashlib.sha256(pii.joined_spans(found).encode()).hexdigest()
        want.add((i, digest, *(sum(s[1] == k for s in found) for k in range(4))))
    assert got == want


def test_long_runs_are_linear():
    assert pii.base_spans("a" * 300_000 + " " + "1" * 300_000 + "." * 1000 + "@" * 1000) == []


def _phones(n):
    return [f"call +1 ({200 + i % 700}) 555-{1000 + i} or mail u{i}@mail.example.com with 10.0.{i % 250}.7 ok" for i in range(n)] + \
        [f"page {i} of {i + 3}, in 19{i % 90 + 10} there were {i * 37} words" for i in range(n)]


def test_repeats_take_the_label_of_the_full_form():
    weights = pii.train(_phones(300))
    text = "call +1 (415) 555-2671 now. " + "words and more words. " * 200 + "later dial 555-2671 again"
    base = [pii.base_spans(text)]
    alone = "later dial 555-2671 again"
    added = pii._added([text, alone], [base[0], pii.base_spans(alone)], weights, 0.9)
    assert [text[s:e] for s, k, e in added[0]] == ["555-2671"] and pii.KINDS[added[0][0][1]] == "phone"
    without = pii._added([text.replace("+1 (415) 555-2671", "nobody")], [[]], weights, 0.9)
    assert len(without[0]) <= len(added[0])


def test_clean_texts_stay(spark):
    docs = documents(spark, list(enumerate(_phones(200))))
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert all(found[i]["spans"] == "" for i in range(200, 400))
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    assert masked[0] == "call <PHONE> or mail <EMAIL> with <IP> ok"
    assert all(masked[i] == t for i, t in enumerate(_phones(200)) if i >= 200)


def test_messages_give_exact_marginals_on_a_chain():
    field = pii.Field(["1a 2b 3c"])
    rng = np.random.default_rng(0)
    n = len(pii.KINDS) + 1
    weights = rng.normal(size=(pii.FEATURES, n)), rng.normal(size=(n, n)), rng.normal(size=(n, n))
    rows, cols = field.sparse()
    unary = np.zeros((len(field), n))
    np.add.at(unary, rows, weights[0][cols])
    joint = unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None, :]
    joint = joint + weights[1][:, :, None] + weights[1][None, :, :]
    p = np.exp(joint - joint.max())
    p /= p.sum()
    old, pii.ROUNDS = pii.ROUNDS, 80
    got = pii.marginals(field, weights)
    pii.ROUNDS = old
    assert np.allclose(got, [p.sum((1, 2)), p.sum((0, 2)), p.sum((0, 1))], atol=1e-6)


def test_awkward_and_empty(spark):
    assert pii.find(documents(spark, AWKWARD)).count() == len(AWKWARD)
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in pii.mask(documents(spark, AWKWARD)).collect()))) == sorted(map(repr, AWKWARD))
    assert pii.find(documents(spark, [])).count() == 0 and pii.mask(documents(spark, [])).count() == 0


def _found(text, weights):
    return [text[s:e] for s, _, e in pii._added([text], [pii.base_spans(text)], weights, 0.9)[0]]


def test_every_repeat_hears_of_the_full_form():
    weights = pii.train(_phones(300))
    text = "call +1 (415) 555-2671 now. " + "words and more words, later dial 555-2671 again. " * 20
    assert _found(text, weights) == ["555-2671"] * 20


def test_runs_and_short_addresses_are_repeats():
    def linked(text):
        field = pii.Field([text])
        return [tuple(text[field.start[n]:field.end[n]] for n in pair) for pair in field.skip]
    assert linked("x +1 (415) 555-2671 y and 415 555 2671 z") == [("(415", "415"), ("555-2671", "555"), ("555-2671", "2671")]
    assert linked("x 4111 1111 1111 1111 y and 4111 1111 1111 1111 z") == [("4111", "4111")] + [("1111", "1111")] * 3
    assert linked("x 1.2.3.4 y and 1.2.3.4 z") == [("1.2.3.4", "1.2.3.4")]
    assert linked("in 19 days of 20 in 19") == []


def test_messages_have_settled():
    weights = pii.train(_phones(100))
    field = pii.Field([" ".join(_phones(60)) + " 555-1007 and 555-1008" * 30, "call 1"])
    got = pii.marginals(field, weights)
    old, pii.SETTLED = pii.SETTLED, 0
    assert np.allclose(got, pii.marginals(field, weights), atol=1e-3)
    pii.SETTLED = old
