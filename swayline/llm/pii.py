"""Personal data: fixed patterns, and a skip-chain conditional random field that keeps labels consistent across a document.

Tokens with a digit or ``@`` are the field's nodes; every other token is plain text. Neighbouring nodes share a chain potential.
Repeats - of a token or of a run of numbers parted by blanks; the same letters and digits, or the same last seven digits - share a skip
potential with the longest of them, however far away, so that any two are two steps apart. Loopy belief propagation runs over all
nodes of a block of documents at once, in each document until its messages stay. A node whose marginal
for a kind reaches ``sure`` becomes a span unless a pattern's span covers it: a phone number repeated without its prefix is found
through its full form elsewhere. Spans of the patterns are never changed.

Weights are fitted by pseudo-likelihood on at most ``sample_docs`` documents with such tokens, chosen by hash; labels of the
nodes there are the patterns' own spans. Null texts count as empty, spans are in code points, rows are neither dropped nor merged.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swayline.llm.common import map_texts, small_batches, whole_text

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that cannot start a match cannot start one in its middle either, so only its first digit is tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NODE = re.compile(r"[0-9@]\S*")  # from a token's first digit or @; its start is found by walking back
NOT_DIGIT = re.compile(r"[^0-9]+")
EDGE = "\"'()[]{}<>,;:.!?="
FEATURES = 1 << 12
ROUNDS = 1000  # at most, where messages do not settle
SETTLED = 1e-7  # a document is done when no message changes more
NUMBER = re.compile(r"[+(]*[0-9][0-9().-]*")

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _part(digits: str) -> bool:
    value = digits.lstrip("0")
    return len(value) < 4 and int(value or 0) <= 255


def _emails(text: str) -> list[Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, 0, match.end()))
            free = match.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped, not retried."""
    found = _emails(text)
    for m in IP.finditer(text):
        if all(_part(p) for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _shape(token: str) -> str:
    out = []
    for c in token[:64]:
        kind = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:24])


def _hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


def _star(alike: list[tuple[int, int]], digits: list[str], first: int) -> list[tuple[int, int]]:
    """Each unit's nodes with those of the longest unit, where the same digits from the right stand."""
    size = lambda unit: sum(len(d) for d in digits[unit[0] - first:unit[1] + 1 - first])
    hub = max(alike, key=lambda unit: (size(unit), unit[1] - unit[0], -unit[0]))
    place = [node for node in range(hub[1], hub[0] - 1, -1) for _ in digits[node - first]] or [hub[1]]
    pairs = []
    for unit in alike:
        passed = 0
        for node in range(unit[1], unit[0] - 1, -1):
            other = place[min(passed, len(place) - 1)]
            if not hub[0] <= node <= hub[1]:
                pairs.append((min(node, other), max(node, other)))
            passed += len(digits[node - first])
    return pairs


class Field:
    """Nodes, features and edges of one block of documents."""

    def __init__(self, texts: list[str]):
        self.doc, self.start, self.end = [], [], []
        self.features: list[list[int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        for doc, text in enumerate(texts):
            units: list[tuple[int, int]] = []  # tokens and runs of numbers, as first and last node
            digits_of: list[str] = []
            keys: dict[str, list[tuple[int, int]]] = {}
            run = first_of_run = -1
            shapes: list[str] = []
            first = len(self.doc)
            for m in NODE.finditer(text):
                start, end = m.span()
                while start and not text[start - 1].isspace():
                    start -= 1
                while start < end and text[start] in "\"'[]{}<>,;:.!?=":
                    start += 1
                while end > start and text[end - 1] in EDGE:
                    end -= 1
                if start == end:
                    continue
                token, node = text[start:end], len(self.doc)
                digits = NOT_DIGIT.sub("", token)
                shape = _shape(token)
                own = [_hashed("shape " + shape), _hashed(f"digits {min(len(digits), 24)} {shape.count('.')}")]
                if 12 <= len(digits) <= 19 and luhn(digits):
                    own.append(_hashed("luhn"))
                if shape == "9.9.9.9":
                    own.append(_hashed("quad" if all(map(_part, NOT_DIGIT.sub(" ", token).split())) else "no quad"))
                touching = node > first and not text[self.end[-1]:start].strip(" ()[],.;:!?=\"'")
                if touching:
                    self.chain.append((node - 1, node))
                    own.append(_hashed("after " + shapes[-1]))
                    self.features[-1].append(_hashed("before " + shape))
                number = NUMBER.fullmatch(token) is not None
                if not (number and run >= 0 and not text[self.end[-1]:start].strip(" ()-")):
                    if run > first_of_run >= 0:
                        units.append((first_of_run, run))
                    first_of_run = node if number else -1
                run = node if number else -1
                digits_of.append(digits)
                same = "".join(c for c in token.lower() if c.isalnum())
                key = digits[-7:] if len(digits) >= 7 else same if len(same) >= 6 else token if shape == "9.9.9.9" else ""
                if key:
                    keys.setdefault(key, []).append((node, node))
                shapes.append(shape)
                self.doc.append(doc)
                self.start.append(start)
                self.end.append(end)
                self.features.append(own)
            if run > first_of_run >= 0:
                units.append((first_of_run, run))
            for unit in units:
                digits = "".join(digits_of[unit[0] - first:unit[1] + 1 - first])
                if len(digits) >= 6:
                    keys.setdefault(digits[-7:], []).append(unit)
            self.skip += sorted({pair for alike in keys.values() if len(alike) > 1 for pair in _star(alike, digits_of, first)})

    def __len__(self) -> int:
        return len(self.doc)

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        counts = [len(f) for f in self.features]
        return np.repeat(np.arange(len(self)), counts), np.fromiter((x for f in self.features for x in f), np.int64, sum(counts))


def _pairs(edges: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    both = np.array(edges, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _silver(field: Field, spans: list[list[Span]]) -> np.ndarray:
    labels = np.zeros(len(field), np.int64)
    for node in range(len(field)):
        for start, kind, end in spans[field.doc[node]]:
            if start < field.end[node] and field.start[node] < end:
                labels[node] = kind + 1
                break
    return labels


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], steps: int = 200, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node weights, chain potentials (left label, right label) and symmetric skip potentials, by pseudo-likelihood (Adagrad)."""
    n = len(KINDS) + 1
    unary, chain, skip = np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros((n, n))
    unary[:, 0] = 0.5  # an unseen shape is plain text
    field = Field(texts)
    if not len(field):
        return unary, chain, skip
    gold = np.eye(n)[_silver(field, [base_spans(t) for t in texts])]
    rows, cols = field.sparse()
    (left, right), (one, other) = _pairs(field.chain), _pairs(field.skip)
    sums = [np.full_like(unary, 1e-8), np.full_like(chain, 1e-8), np.full_like(skip, 1e-8)]
    for _ in range(steps):
        logits = np.zeros((len(field), n))
        np.add.at(logits, rows, unary[cols])
        np.add.at(logits, right, gold[left] @ chain)
        np.add.at(logits, left, gold[right] @ chain.T)
        np.add.at(logits, other, gold[one] @ skip)
        np.add.at(logits, one, gold[other] @ skip)
        miss = (gold - _softmax(logits)) / len(field)
        grads = [np.zeros_like(unary), gold[left].T @ miss[right] + miss[left].T @ gold[right], gold[one].T @ miss[other] + gold[other].T @ miss[one]]
        np.add.at(grads[0], cols, miss[rows])
        grads[2] = (grads[2] + grads[2].T) / 2
        for weight, grad, total in zip((unary, chain, skip), grads, sums):
            grad -= decay / len(field) * weight
            total += grad * grad
            weight += rate * grad / np.sqrt(total)
    return unary, chain, skip


def marginals(field: Field, weights: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Loopy sum-product, in each round all edges of the documents whose messages still change; messages are damped by half."""
    unary, chain, skip = weights
    n = chain.shape[0]
    logits = np.zeros((len(field), n))
    rows, cols = field.sparse()
    np.add.at(logits, rows, unary[cols])
    (left, right), (one, other) = _pairs(field.chain), _pairs(field.skip)
    source = np.concatenate([left, right, one, other])
    target = np.concatenate([right, left, other, one])
    if not len(source):
        return _softmax(logits)
    tables = np.exp(np.stack([chain, chain.T, skip, skip.T]))
    which = np.repeat(np.arange(4), [len(left), len(left), len(one), len(one)])
    back = np.concatenate([np.arange(len(left)) + len(left), np.arange(len(left)),
                           2 * len(left) + len(one) + np.arange(len(one)), 2 * len(left) + np.arange(len(one))])
    messages = np.zeros((len(source), n))
    doc = np.array(field.doc)[source]
    live = np.arange(len(source))  # edges of documents that have not settled
    for _ in range(ROUNDS):
        belief = logits.copy()
        np.add.at(belief, target[live], messages[live])
        out = _softmax(belief[source[live]] - messages[back[live]])
        new = np.empty_like(out)
        for t in range(4):
            mine = which[live] == t
            new[mine] = np.log(out[mine] @ tables[t])
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - messages[live]).max(axis=1)
        messages[live] = 0.5 * messages[live] + 0.5 * new
        moving = np.zeros(field.doc[-1] + 1, bool)
        moving[doc[live[change > SETTLED]]] = True
        live = live[moving[doc[live]]]
        if not len(live):
            break
    np.add.at(logits, target, messages)
    return _softmax(logits)


def _added(texts: list[str], base: list[list[Span]], weights, sure: float) -> list[list[Span]]:
    field = Field(texts)
    added: list[list[Span]] = [[] for _ in texts]
    if not len(field):
        return added
    belief = marginals(field, weights)
    label = belief.argmax(axis=1)
    certain = (label > 0) & (belief.max(axis=1) >= sure)
    joined = {right for left, right in field.chain}
    for node in np.flatnonzero(certain):
        doc, start, end, kind = field.doc[node], field.start[node], field.end[node], int(label[node]) - 1
        if any(s < end and start < e for s, _, e in base[doc]):
            continue
        mine = added[doc]
        if mine and int(node) in joined and mine[-1][1] == kind and mine[-1][2] == field.end[node - 1]:
            mine[-1] = (mine[-1][0], kind, end)
        else:
            mine.append((start, kind, end))
    return added


def joined_spans(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def fit(docs: DataFrame, text: str = "text", sample_docs: int = 2000, sample_chars: int = 20_000):
    """Weights from at most ``sample_docs`` documents that hold a digit or ``@`` and are at most ``sample_chars`` long."""
    rows = (docs.select(whole_text(text).alias("text")).filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= sample_chars))
            .select("text", F.xxhash64("text").alias("order")))
    chosen = rows.select("order").distinct().orderBy("order").limit(sample_docs)
    sample = rows.join(F.broadcast(chosen), "order").dropDuplicates(["order"]).orderBy("order").collect()
    return train([r["text"] for r in sample])


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sure: float = 0.9, weights=None, **sample) -> DataFrame:
    """Per row: id, ``n_<kind>`` and ``base_sha256`` of the patterns' spans, and ``spans``, those and the field's."""
    weights = weights or fit(docs, text, **sample)

    def make() -> Callable[[list[str]], list[list]]:
        def work(texts: list[str]) -> list[list]:
            base = [base_spans(t) for t in texts]
            added = _added(texts, base, weights, sure)
            return [*([sum(s[1] == k for s in found) for found in base] for k in range(len(KINDS))),
                    [hashlib.sha256(joined_spans(found).encode()).hexdigest() for found in base],
                    [joined_spans(a + b) for a, b in zip(base, added)]]

        return work

    fields = ", ".join([f"n_{k} long" for k in KINDS] + ["base_sha256 string", "spans string"])
    return map_texts(docs, doc_id, text, fields, make)


def _replaced(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def mask(docs: DataFrame, text: str = "text", sure: float = 0.9, weights=None, **sample) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; a text without spans, or null, stays as it is.
    Where spans overlap, the one that starts first (of those, the first kind) counts and the union of both is replaced."""
    weights = weights or fit(docs, text, **sample)

    @F.pandas_udf("string")
    def masked(texts):
        out = []
        for start in range(0, len(texts), 256):
            given = texts.iloc[start:start + 256].tolist()
            values = [t or "" for t in given]
            base = [base_spans(t) for t in values]
            out += [_replaced(v, spans + more) if spans or more else t
                    for t, v, spans, more in zip(given, values, base, _added(values, base, weights, sure))]
        return type(texts)(out, dtype=object)

    return small_batches(docs).withColumn(text, masked(F.col(text)))
