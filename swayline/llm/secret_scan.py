"""Secret scans over trigram indexes.

Every rule's regular expression gives a Boolean query over trigrams that any match must contain. Documents are indexed block by
block where they lie: a block's postings (trigram -> documents) are built, the rules' queries are answered by intersecting and
uniting postings, and only the candidates are verified with the expression itself. A rule without mandatory trigrams (a run of
hex digits) scans every document of the block. Index and text stay in one task, so nothing is shuffled and a lost executor
costs its blocks only.

Trigrams are those of the UTF-8 bytes with ASCII letters in lower case, so a query never misses a match in another case.
Null texts count as empty. Rows are neither dropped nor merged; spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
from pyspark.sql import DataFrame

from swayline.llm.common import map_texts

FEW = 64  # literal alternatives followed before a query falls back to what it has
GAP = b"\x00\x00\x00"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0          # least length of the match, or of ``group``
    group: int = 0
    any_case: bool = False


#: Fixed patterns of the task.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
#: Published formats of tokens and keys.
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
)

Query = tuple  # ("all", [queries]) | ("any", [queries]) | ("gram", int)
EVERY: Query = ("all", ())


def _grams(literal: str) -> Query | None:
    raw = literal.encode().lower()
    codes = {raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2] for i in range(len(raw) - 2)}
    return ("all", tuple(("gram", c) for c in sorted(codes))) if codes else None


def _of_strings(strings: set[str]) -> Query | None:
    parts = [_grams(s) for s in strings]
    if not parts or None in parts:
        return None
    return parts[0] if len(parts) == 1 else ("any", tuple(parts))


def _strings(node) -> set[str] | None:
    """All strings a piece of an expression can match, if they are few."""
    kind, arg = node
    if kind is op.LITERAL:
        return {chr(arg)}
    if kind is op.IN:
        found = set()
        for what, value in arg:
            if what is op.LITERAL:
                found.add(chr(value))
            elif what is op.RANGE and value[1] - value[0] < FEW:
                found |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= FEW // 4 else None
    if kind is op.SUBPATTERN:
        return _sequence_strings(arg[3])
    if kind is op.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if None in parts or sum(map(len, parts)) > FEW else set().union(*parts)
    if kind is op.MAX_REPEAT and arg[1] <= 4:
        one = _sequence_strings(arg[2])
        if one is None or sum(len(one) ** n for n in range(arg[0], arg[1] + 1)) > FEW:
            return None
        return {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
    if kind is op.AT:
        return {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    whole = {""}
    for node in nodes:
        part = _strings(node)
        if part is None or len(whole) * len(part) > FEW:
            return None
        whole = {a + b for a in whole for b in part}
    return whole


def _sequence_query(nodes) -> list[Query]:
    needed, run = [], {""}

    def flush() -> None:
        query = _of_strings(run)
        if query:
            needed.append(query)

    for node in nodes:
        part = _strings(node)
        if part is not None and len(run) * len(part) <= FEW:
            run = {a + b for a in run for b in part}
            continue
        flush()
        run = {""}
        if part is not None:
            run = part
        elif node[0] is op.SUBPATTERN:
            needed += _sequence_query(node[1][3])
        elif node[0] is op.BRANCH:
            sides = [_sequence_query(x) for x in node[1][1]]
            if all(sides):
                needed.append(("any", tuple(("all", tuple(s)) for s in sides)))
        elif node[0] is op.MAX_REPEAT and node[1][0] >= 1:
            needed += _sequence_query(node[1][2])
    flush()
    return needed


@lru_cache(maxsize=256)
def trigram_query(pattern: str) -> Query:
    """What trigrams a match of ``pattern`` must contain; ``EVERY`` where nothing is mandatory."""
    return ("all", tuple(_sequence_query(parser.parse(pattern))))


def _codes(query: Query) -> set[int]:
    return {query[1]} if query[0] == "gram" else set().union(*map(_codes, query[1])) if query[1] else set()


class BlockIndex:
    """Postings of the wanted trigrams over one block of texts."""

    def __init__(self, texts: list[bytes], wanted: np.ndarray):
        raw = np.frombuffer(GAP.join(texts).lower(), np.uint8)
        starts = np.cumsum([0, *(len(t) + len(GAP) for t in texts)])
        self.size, self.postings = len(texts), {}
        if len(raw) < 3:
            return
        codes = raw[:-2].astype(np.int32)
        codes <<= 8
        codes |= raw[1:-1]
        codes <<= 8
        codes |= raw[2:]
        at = np.flatnonzero(wanted[codes])
        docs = np.searchsorted(starts, at, side="right") - 1
        pairs = np.unique(codes[at].astype(np.int64) << 32 | docs)
        grams, rows = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.flatnonzero(np.diff(grams)) + 1
        self.postings = {int(g[0]): r for g, r in zip(np.split(grams, cuts), np.split(rows, cuts)) if len(g)}

    def find(self, query: Query) -> np.ndarray:
        kind, parts = query
        if kind == "gram":
            return self.postings.get(parts, np.empty(0, np.int64))
        if kind == "any":
            return np.unique(np.concatenate([self.find(p) for p in parts]))
        rows = None
        for part in sorted(parts, key=lambda p: len(self.postings.get(p[1], ())) if p[0] == "gram" else self.size):
            rows = self.find(part) if rows is None else np.intersect1d(rows, self.find(part), assume_unique=True)
            if not len(rows):
                break
        return np.arange(self.size) if rows is None else rows


def _verifier(rule: Rule) -> Callable[[str], list[tuple[int, int]]]:
    flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
    if rule.pattern == r"[0-9a-f]+":  # whole runs: the same matches, without an object for every shorter run
        found = re.compile(r"[0-9a-f]{%d,}" % rule.least, flags).finditer
    else:
        found = re.compile(rule.pattern, flags).finditer
    return lambda text: [m.span() for m in found(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _digest(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base: tuple[Rule, ...] = BASE,
         extra: tuple[Rule, ...] = EXTRA) -> DataFrame:
    """Per row: id, ``n_<kind>`` of every base rule, ``base_sha256`` and ``spans`` (``kind:start:end``, by start, then rule order)."""
    rules = (*base, *extra)
    counts = [f"n_{r.kind}" for r in base]

    def make() -> Callable[[list[str]], list[list]]:
        queries = [trigram_query(r.pattern) for r in rules]
        wanted = np.zeros(1 << 24, bool)
        wanted[list(set().union(*map(_codes, queries)))] = True
        verify = [_verifier(r) for r in rules]

        def search(texts: list[str]) -> list[list]:
            index = BlockIndex([t.encode("utf-8", "surrogatepass") for t in texts], wanted)
            spans: list[list] = [[] for _ in texts]
            for order, (rule, query) in enumerate(zip(rules, queries)):
                for row in index.find(query):
                    spans[row] += [(start, order, rule.kind, end) for start, end in verify[order](texts[row])]
            first = [[s for s in found if s[1] < len(base)] for found in spans]
            return [*([sum(s[1] == order for s in found) for found in first] for order in range(len(counts))),
                    [hashlib.sha256(_digest(found).encode()).hexdigest() for found in first], [_digest(found) for found in spans]]

        return search

    fields = ", ".join([f"{c} long" for c in counts] + ["base_sha256 string", "spans string"])
    return map_texts(docs, doc_id, text, fields, make)
