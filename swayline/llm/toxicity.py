"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes, distance-weighted votes, calibration.

Examples are at most ``max_examples`` labelled documents of at most ``max_chars`` characters together, half of either label where there are
so many, chosen by hash of their id; those with the same text are one example, under the smallest id, whose label is the share of them
that are marked. A vector holds every word of its text, weighed by document frequencies over all documents; the norm of a document also
counts the words that no example has, through a join with the table of frequencies. So cosines are those of whole texts, and the
index has a bound - the words of the examples - and is broadcast.

Beside it stands a second index over features that speak for the label: words, word beginnings of four to seven letters and their
share of the text's words, kept where the association with the label (chi-square over the examples) is beyond chance, at
most ``max_features``. It finds a few marked words in a long text, which hardly turn the whole text's vector.

A document's nearest examples are found exactly. In either index examples lie in blocks and each term has a maximum for each block; blocks
are scored only where the sum of their maxima can reach the k-th best cosine found in the most promising blocks. Whole texts are compared
several at a time: words of few examples by their postings, words of many as columns of a block. Votes weigh 1 / (1.05 - cosine). The
votes of either index are calibrated by a monotone fit to the examples' own leave-one-out votes, which tasks take from the same
indexes, weighed so that either label counts as among all labelled documents; the larger of the two rates, calibrated again, is the
score. A text without any word that an example has gets the label rate of the examples without a word. Evidence is the nearest examples
themselves, by whole texts.

Null texts count as empty. Without examples of both labels every score is 0. Several labels of one id: the largest; several texts
under one id: the least. Rows are neither dropped nor merged. Ids may be of any type that can be ordered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from swayline.llm.common import fresh, keep, map_texts, small_batches, whole_text

WORD = re.compile(r"\w+")
ASCII = bytes(range(128))
PLAIN = bytes(b if b > 127 else ord(chr(b).lower()) if WORD.match(chr(b)) else 32 for b in range(256))  # ASCII letters small, what is in no word a space
PLAIN_TEXT = PLAIN[:128].decode()
REPLACED = 24  # kinds of other characters replaced one after the other in a text
HEAD = 4
BEGINNINGS = (4, 5, 6, 7)
SHARES = ((100, "1%"), (30, "3%"))  # a beginning's share of all words, as features of their own
BLOCK = 64
FIRST = 4  # blocks scored before the others are judged
REMEMBERED = 2_000
WORDS_REMEMBERED = 1 << 18
OFTEN = 8  # a word that more than one in so many examples have is kept in dense columns
TOGETHER = 64  # texts compared at a time
PARTS = 8  # of the examples, fetched one after the other
TALLIED = 1 << 18  # words counted in a task before it hands on what it has


@lru_cache(1 << 12)
def _in_words(character: str) -> str:
    return "".join(c if WORD.match(c) else " " for c in character.lower())


def words_of(text: str) -> list[str]:
    """What ``WORD`` finds in the text in small letters, by replacing what is in no word."""
    if text.isascii():
        return text.translate(PLAIN_TEXT).split()
    raw = text.encode("utf-8", "surrogatepass")
    others = set(raw.translate(None, ASCII).decode("utf-8", "surrogatepass"))
    changed = [(c, new) for c in others if (new := _in_words(c)) != c]
    if len(changed) > REPLACED or "\u03a3" in others:  # the small form of a capital sigma depends on where it stands
        return WORD.findall(text.lower())
    for old, new in changed:  # none is changed twice: what is small stays small
        raw = raw.replace(old.encode("utf-8", "surrogatepass"), new.encode("utf-8", "surrogatepass"))
    return raw.translate(PLAIN).decode("utf-8", "surrogatepass").split()


def features(text: str) -> Counter:
    """Counts of words (``=word``) and of beginnings of longer words (``begi``, and ``begi 1%`` where they are so many of the words)."""
    listed = words_of(text)
    begun: Counter = Counter()
    found: Counter = Counter()
    for word, n in Counter(listed).items():
        found["=" + word] = n
        for size in BEGINNINGS:
            if len(word) > size:
                begun[word[:size]] += n
    for beginning, n in begun.items():
        found[beginning] = n
        for part, name in SHARES:
            if n > 1 and n * part >= len(listed):
                found[f"{beginning} {name}"] = 1
    return found


class KeptFeatures:
    """Which of the kept features a text has: what ``features`` gives, of these names only. What a word can add is remembered."""

    def __init__(self, names: list[str]):
        self.numbers = {name: i for i, name in enumerate(names)}
        self.begun = {name.split(" ")[0] for name in names if not name.startswith("=")}
        self.heads = {name.removeprefix("=")[:HEAD] for name in names}
        self.parts: dict[str, tuple] = {}

    def _parts(self, word: str) -> tuple:
        if len(self.parts) >= WORDS_REMEMBERED:
            self.parts.clear()
        begun = tuple(word[:size] for size in BEGINNINGS if len(word) > size and word[:size] in self.begun)
        found = self.parts[word] = (self.numbers.get("=" + word), begun)
        return found

    def __call__(self, words: Counter, total: int) -> dict[int, int]:
        """Numbers of the features and their counts, ascending."""
        found, begun, heads = {}, {}, self.heads
        for word in [w for w in words if w[:HEAD] in heads]:
            own, beginnings = self.parts.get(word) or self._parts(word)
            if own is not None:
                found[own] = words[word]
            for beginning in beginnings:
                begun[beginning] = begun.get(beginning, 0) + words[word]
        for beginning, n in begun.items():
            if beginning in self.numbers:
                found[self.numbers[beginning]] = n
            for part, name in SHARES:
                number = self.numbers.get(f"{beginning} {name}") if n > 1 and n * part >= total else None
                if number is not None:
                    found[number] = 1
        return dict(sorted(found.items()))


class BlockMaxIndex:
    """Postings by term over examples in blocks, from triples (row, term, weight); rows are unit vectors."""

    def __init__(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, size: int):
        self.size, self.postings = size, {}
        order = np.lexsort((row, term))
        cuts = np.flatnonzero(np.diff(term[order])) + 1
        for rows, weights, terms in zip(*(np.split(x[order], cuts) for x in (row.astype(np.int32), weight, term))):
            if len(rows):
                blocks, starts = np.unique(rows // BLOCK, return_index=True)
                self.postings[int(terms[0])] = (rows, weights, rows // BLOCK, blocks, np.maximum.reduceat(weights, starts))

    def _scores(self, terms: list[tuple], alive: np.ndarray) -> np.ndarray:
        scores = np.zeros(self.size)
        for weight, (rows, weights, block, _, _) in terms:
            among = np.flatnonzero(alive[block])
            scores[rows[among]] += weight * weights[among]
        return scores

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """The ``k`` largest cosines (positive ones only) as (cosine, example), ties to the smaller example.

        The blocks with the largest bounds are scored first; then, together, all others whose bound reaches the k-th best so far.
        """
        terms = [(weight, self.postings[t]) for t, weight in sorted(query.items()) if t in self.postings]
        bound = np.zeros(-(-self.size // BLOCK))
        for weight, (_, _, _, blocks, most) in terms:
            bound[blocks] += weight * most
        alive = bound > 0
        if alive.sum() > 2 * FIRST:
            alive &= bound >= np.partition(bound, len(bound) - FIRST)[len(bound) - FIRST]
        scores = self._scores(terms, alive)
        if without >= 0:
            scores[without] = 0
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else 0.0
        rest = (bound > 0) & (bound >= least) & ~alive
        if rest.any():
            scores += self._scores(terms, rest)  # a block is scored once only
            if without >= 0:
                scores[without] = 0
        rows = np.flatnonzero(scores > 0)
        if len(rows) > k:
            least = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
            rows = rows[scores[rows] >= least]
        rows = rows[np.lexsort((rows, -scores[rows]))[:k]]
        return list(zip(scores[rows].tolist(), rows.tolist()))


class WordIndex:
    """All words of the examples, from triples (row, word, weight); rows are unit vectors. Examples lie in blocks. Words of few examples have
    postings, which are summed first; those of many are columns. A block's bound is its largest sum and the maxima of its columns. Several
    texts are compared at a time, block by block: a block meets those texts whose bound there reaches their k-th best product so far."""

    def __init__(self, row: np.ndarray, word: np.ndarray, weight: np.ndarray, size: int, words: int):
        self.size, self.blocks = size, -(-size // BLOCK)
        often = np.flatnonzero(np.bincount(word, minlength=words) * OFTEN > size)
        self.column = np.full(words, -1, np.int32)
        self.column[often] = np.arange(len(often))
        dense = self.column[word] >= 0
        self.often = np.zeros((size, len(often)))
        self.often[row[dense], self.column[word[dense]]] = weight[dense]
        self.most_often = np.stack([self.often[at:at + BLOCK].max(axis=0) for at in range(0, size, BLOCK)]) if size else np.zeros((0, len(often)))
        seldom = np.flatnonzero(~dense)
        seldom = seldom[np.lexsort((row[seldom], word[seldom]))]
        self.rows, self.weights = row[seldom].astype(np.min_scalar_type(size)), weight[seldom]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(word[seldom], minlength=words))])

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (words, weights) the ``k`` largest products (positive ones only) and their examples, ties to the smaller example."""
        many = np.zeros((len(queries), self.often.shape[1]))
        scores = np.zeros((len(queries), self.blocks * BLOCK))
        for q, (words, weights) in enumerate(queries):
            column = self.column[words]
            many[q, column[column >= 0]] = weights[column >= 0]
            few, own = words[column < 0], weights[column < 0]
            at, count = _runs(self.start, few)
            products = self.weights.take(at, mode="wrap")  # every place is there; this mode is the fastest
            products *= np.repeat(own, count)
            scores[q] = np.bincount(self.rows.take(at, mode="wrap"), products, self.blocks * BLOCK)
        bound = scores.reshape(len(queries), self.blocks, BLOCK).max(axis=2) + many @ self.most_often.T
        done = np.zeros(bound.shape, bool)

        def best(q: int, reached: float) -> tuple[np.ndarray, np.ndarray]:
            if reached > 0:  # the k-th best so far
                rows = np.flatnonzero(scores[q] >= reached)
                rows = rows[done[q, rows // BLOCK]]
            else:
                rows = (np.flatnonzero(done[q])[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            found = scores[q, rows]
            if len(rows) > 4 * k:
                least = np.partition(found, len(rows) - k)[len(rows) - k]
                rows, found = rows[found >= least], found[found >= least]
            rows, found = rows[found > 0], found[found > 0]
            order = np.lexsort((rows, -found))[:k]
            return found[order], rows[order]

        wanted, least = bound > 0, np.zeros(len(queries))
        if self.blocks > FIRST:  # the most promising blocks first
            wanted &= bound >= np.partition(bound, self.blocks - FIRST, axis=1)[:, self.blocks - FIRST][:, None]
        for _ in range(2):
            for block in np.flatnonzero(wanted.any(axis=0)):
                asking, rows = np.flatnonzero(wanted[:, block]), slice(block * BLOCK, min(self.size, (block + 1) * BLOCK))
                scores[asking, rows] += many[asking] @ self.often[rows].T
            done |= wanted
            if without is not None:
                scores[np.arange(len(queries)), without] = 0
            found = [best(q, least[q]) for q in range(len(queries))]
            least = np.array([f[0][-1] if len(f[0]) >= k else 0.0 for f in found])
            wanted = ~done & (bound > 0) & (bound >= least[:, None] - 1e-9)
            if not wanted.any():
                break
        return found


def _runs(start: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the postings of ``words``, one run after the other, and the runs' lengths."""
    first = start[words]
    count = start[words + 1] - first
    at = np.repeat(first - np.cumsum(count) + count, count)
    at += np.arange(len(at))
    return at, count


def _vote(found: list[tuple[float, int]], labels: list[float]) -> float:
    weights = [1 / (1.05 - min(score, 1.0)) for score, _ in found]
    return sum(w * labels[row] for w, (_, row) in zip(weights, found)) / sum(weights)


def _monotone(votes: list[float], labels: list[float], weights: list[float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: votes and their label rates, each with half a case of either label added."""
    given: dict[float, list[float]] = {}
    for vote, label, weight in zip(votes, labels, weights or [1.0] * len(votes)):
        held = given.setdefault(vote, [0.0, 0.0])
        held[0] += label * weight
        held[1] += weight
    pools: list[list[float]] = []
    for vote in sorted(given):  # equal votes are one pool from the start
        pools.append([vote, *given[vote]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    rates = [(p + 0.5) / (n + 1) for _, p, n in pools]
    return np.array([p[0] for p in pools]), np.maximum.accumulate(np.array(rates)) if rates else np.array([])


class Rates:
    """A monotone fit of labels to votes. Weights undo that examples were drawn by label."""

    def __init__(self, votes: list[float], labels: list[float], weights: list[float] | None = None):
        self.votes, self.rates = _monotone(votes, labels, weights)

    def __call__(self, vote: float) -> float:
        return float(self.rates[min(int(np.searchsorted(self.votes, vote)), len(self.rates) - 1)])


class Model:
    """Examples by ``ids`` and ``labels`` (0 to 1). ``row`` (an example), ``term`` and ``count`` are the entries of their vectors of kept
    features; ``word_row``, ``word`` and ``word_count`` those of all their words. ``frequency`` has the rows (feature, n) of all
    documents; it stays on the driver. The index of all words is built in the tasks. ``calibrate`` takes the examples' own votes."""

    def __init__(self, names: list[str], idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, row: np.ndarray, term: np.ndarray,
                 count: np.ndarray, k: int, words: list[str], word_idf: np.ndarray, word_row: np.ndarray, word: np.ndarray,
                 word_count: np.ndarray, documents: int = 0, frequency: DataFrame | None = None, weights: tuple[float, float] = (1.0, 1.0),
                 id_type: T.DataType | None = None):
        self.documents, self.frequency, self.weights, self.id_type = documents, frequency, weights, id_type
        self.kept = KeptFeatures(names)
        self.numbers = self.kept.numbers
        self.words = {name: i for i, name in enumerate(words)}
        self.idf, self.word_idf, self.k, self.memory = idf, word_idf, k, {}
        weight = _unit(row, term, count, idf, len(ids))
        heaviest = np.full(len(ids), -1)
        rising = np.argsort(weight, kind="stable")
        heaviest[row[rising]] = term[rising]
        order = np.lexsort((np.arange(len(ids)), heaviest))  # alike examples share blocks; those without a feature come first
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(order))
        self.ids, self.labels = ids[order].tolist(), labels[order].tolist()
        self.index = BlockMaxIndex(place[row], term, weight, len(order))
        by_word = np.argsort(word, kind="stable")
        self.packed = tuple(x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in
                            (place[word_row][by_word], word_count[by_word], np.bincount(word, minlength=len(words))))
        self.spoken = np.bincount(place[word_row], minlength=len(ids)) > 0
        self.whole = None
        self.calibrate([])

    def calibrate(self, votes: list[tuple[int, float | None, float | None]]) -> None:
        """``votes``: row of an example and its votes by kept features and by whole text, itself left out."""
        zero, one = self.weights
        mass = [zero * (1 - label) + one * label for label in self.labels]
        share = [one * label / m for label, m in zip(self.labels, mass)]
        plain = [(s * m, m) for s, m, spoken in zip(share, mass, self.spoken) if not spoken]
        self.plain_rate = (sum(p for p, _ in plain) + 0.5) / (sum(m for _, m in plain) + 1) if self.ids else 0.0
        fitted = lambda given: Rates(*map(list, zip(*given))) if given else None
        self.rates = [fitted([(v[j], share[v[0]], mass[v[0]]) for v in votes if v[j] is not None]) for j in (1, 2)]
        self.final = fitted([(max(r(x) for r, x in zip(self.rates, v[1:]) if x is not None), share[v[0]], mass[v[0]])
                             for v in votes if v[1] is not None or v[2] is not None])

    def own_votes(self, found: list[tuple[int, dict[str, int]]]) -> list[tuple[int, float | None, float | None]]:
        """Votes of examples (rows and features) by the other examples."""
        out = []
        for at in range(0, len(found), TOGETHER):
            some = found[at:at + TOGETHER]
            queries = []
            for _, counts in some:
                known = sorted((self.words[f[1:]], n) for f, n in counts.items() if f[0] == "=" and f[1:] in self.words)
                words, count = np.array(known, np.int64).reshape(-1, 2).T
                weights = (1 + np.log(count)) * self.word_idf[words]
                queries.append((words, weights / (np.sqrt(weights @ weights) or 1.0)))
            for (row, counts), near in zip(some, self.whole.nearest(queries, self.k, [row for row, _ in some])):
                kept = self.index.nearest(self.weigh({self.numbers[f]: n for f, n in counts.items() if f in self.numbers}), self.k, row)
                out.append((row, *(_vote(f, self.labels) if f else None for f in (kept, list(zip(*(x.tolist() for x in near)))))))
        return out

    def __getstate__(self) -> dict:
        """What is sent to the tasks: counts instead of the index of all words, which is made there, and words in one text."""
        return {**self.__dict__, "frequency": None, "memory": {}, "words": " ".join(self.words)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.spelt = state["words"].split(" ") if state["words"] else []
        self.words = {name: i for i, name in enumerate(self.spelt)}
        self.headed = np.fromiter((name[:HEAD] in self.kept.heads for name in self.spelt), bool, len(self.spelt))  # may speak for a kept feature
        row, count, held = self.packed
        row, word = row.astype(np.int32), np.repeat(np.arange(len(self.words), dtype=np.int32), held)
        self.whole = WordIndex(row, word, _unit(row, word, count, self.word_idf, len(self.ids)), len(self.ids), len(self.words))

    def weigh(self, counts: dict[int, int]) -> dict[int, float]:
        raw = {t: (1 + np.log(n)) * self.idf[t] for t, n in sorted(counts.items())}
        norm = float(np.sqrt(sum(w * w for w in raw.values())))
        return {t: float(w / norm) for t, w in raw.items()} if norm else {}

    def kept_rate(self, counts: dict[int, int]) -> float | None:
        """The rate by kept features; none without a neighbour."""
        key = tuple(counts.items())
        if key not in self.memory:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            found = self.index.nearest(self.weigh(counts), self.k)
            self.memory[key] = self.rates[0](_vote(found, self.labels)) if found and self.rates[0] else None
        return self.memory[key]

    def compare(self, texts: list[str]) -> Iterator[tuple[float | None, list[float], list[int], float, list[tuple[str, int]]]]:
        """Each text's rate by kept features; the nearest examples by whole text as products with the unweighed text and their rows; the
        square of the text's norm as far as examples have its words, and its other words with their counts."""
        for at in range(0, len(texts), TOGETHER):
            queries, features, loose = [], [], []
            for text in texts[at:at + TOGETHER]:
                listed = words_of(text)
                word = np.fromiter(map(self.words.get, listed, repeat(-1)), np.int64, len(listed))
                others = Counter(compress(listed, (word < 0).tolist()))
                word.sort()  # sums run in one order for equal texts
                word = word[word.searchsorted(0):]
                first = np.flatnonzero(np.diff(word, prepend=-1))
                known, count = word[first], np.diff(first, append=len(word))
                queries.append((known, (1 + np.log(count)) * self.word_idf[known]))
                headed = np.flatnonzero(self.headed[known])
                told = dict(zip(map(self.spelt.__getitem__, known[headed].tolist()), count[headed].tolist()))
                features.append(self.kept(told | others, len(listed)))
                loose.append(list(others.items()))
            for counts, (_, weights), (products, rows), others in zip(features, queries, self.whole.nearest(queries, self.k), loose):
                yield self.kept_rate(counts), products.tolist(), rows.tolist(), float(weights @ weights), others

    def judge(self, kept: float | None, products: list[float], rows: list[int], square: float) -> tuple[float, list[dict]]:
        """Score and evidence; ``square`` is that of the whole norm."""
        near = [(min(p / np.sqrt(square), 1.0), r) for p, r in zip(products, rows)]
        rates = [] if kept is None else [kept]
        if near and self.rates[1]:
            rates.append(self.rates[1](_vote(near, self.labels)))
        value = self.final(max(rates)) if rates and self.final else self.plain_rate
        return value, [{"doc_id": self.ids[r], "similarity": float(s), "label": int(self.labels[r] >= 0.5)} for s, r in near[:3]]


def _unit(row: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    weight = np.log(count.astype(float))
    weight += 1
    weight *= idf[term]
    weight /= np.sqrt(np.bincount(row, weight * weight, rows))[row]
    return weight


def _frequency(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """Documents with each word (``=word``) and each kept feature, and with any (null): rows (feature, n), written."""
    others = [n for n in names if not n.startswith("=")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, totals, met, documents = KeptFeatures(others), Counter(), Counter(), 0

        def told() -> pa.RecordBatch:
            features = [None, *("=" + w for w in totals), *(others[i] for i in met)]
            rows = pa.RecordBatch.from_arrays([pa.array(features, pa.string()), pa.array([documents, *totals.values(), *met.values()], pa.int64())], ["feature", "n"])
            totals.clear()
            met.clear()
            return rows

        for batch in batches:
            for value in batch.column(0):
                listed = words_of(value.as_py())
                words = Counter(listed)
                totals.update(words.keys())
                met.update(kept(words, len(listed)).keys())
                documents += 1
                if len(totals) >= TALLIED:
                    yield told()
                    documents = 0
        yield told()

    return keep(small_batches(docs).select(whole_text(text)).mapInArrow(count, "feature string, n long")
                .groupBy("feature").agg(F.sum("n").alias("n")), "frequency")


def _chosen(rows: DataFrame, max_examples: int) -> tuple[DataFrame, tuple[float, float]]:
    """At most ``max_examples`` of ``rows``, as many of either label as there are up to a half, by hash of their id; and how many labelled
    documents an example of either label stands for, in units that average 1."""
    there = rows.agg(F.count_if(F.col("label") == 0).alias("no"), F.count_if(F.col("label") != 0).alias("yes")).first()
    take_yes = min(there["yes"], max(max_examples // 2, max_examples - there["no"]))
    take_no = min(there["no"], max_examples - take_yes)
    drawn = lambda condition, n: rows.filter(condition).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = drawn(F.col("label") == 0, take_no).unionByName(drawn(F.col("label") != 0, take_yes))
    whole = (there["no"] + there["yes"]) / max(1, take_no + take_yes)
    return chosen, (there["no"] / max(1, take_no) / (whole or 1.0), there["yes"] / max(1, take_yes) / (whole or 1.0))


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_examples: int = 4_096, max_chars: int = 1 << 26, max_features: int = 2_048, least_df: int = 5,
        least_chi2: float = 30.0, k: int = 15) -> Model:
    """``usable``: which rows of ``labels`` may be learnt from. ``max_chars`` bounds the examples' texts together: with longer texts there are
    fewer examples (whole texts still), and a text beyond it is none."""
    rows = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    rows = (rows.filter(usable) if usable is not None else rows).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("label"))
    chosen, weights = _chosen(rows, max_examples)
    texts = (docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")).filter(F.length("text") <= max_chars)
             .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    texts = keep(texts.groupBy(F.sha2("text", 256).alias("digest"))
                 .agg(F.min("doc_id").alias("doc_id"), F.avg("label").alias("label"), F.count("*").alias("copies"), F.min("text").alias("text")), "texts")
    # At most max_examples narrow rows in this window.
    room = texts.select("digest", F.sum(F.length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "digest")).alias("upto")).filter(F.col("upto") <= max_chars)
    texts = texts.join(F.broadcast(room.select("digest")), "digest", "left_semi")

    def make() -> Callable[[list[str]], list[list]]:
        return lambda values: [[list(features(v).items()) for v in values]]

    examples = keep(texts.withColumn("key", F.struct("doc_id", "label", "copies"))
                    .transform(lambda t: map_texts(t, "key", "text", "found map<string, int>", make, 1 << 19)), "examples")
    flat = examples.select("key.doc_id", "key.label", "key.copies", F.explode("found").alias("feature", "n"))
    total = examples.agg(F.sum("key.copies").alias("n"), F.sum(F.col("key.label") * F.col("key.copies")).alias("positive")).first()
    n, positive = total["n"] or 0, total["positive"] or 0
    none = np.empty(0, np.int64)
    if not 0 < positive < n:
        return Model([], np.empty(0), none, none, none, none, none, k, [], np.empty(0), none, none, none)
    expected = F.col("df") * F.lit(positive / n)
    chi2 = (F.col("p") - expected) ** 2 / expected + (F.col("p") - expected) ** 2 / (F.col("df") * F.lit(1 - positive / n))
    ranked = (flat.groupBy("feature").agg(F.sum("copies").alias("df"), F.sum(F.col("label") * F.col("copies")).alias("p")).filter(F.col("df") >= least_df)
              .withColumn("chi2", chi2).filter(F.col("chi2") >= least_chi2).orderBy(F.desc("chi2"), "feature").limit(max_features))
    names = [r["feature"] for r in ranked.collect()]
    frequency = _frequency(docs, text, names)
    documents = frequency.filter("feature is null").agg(F.sum("n")).first()[0] or 0
    used = examples.select(F.explode(F.map_keys("found")).alias("feature")).filter(F.col("feature").startswith("=") | F.col("feature").isin(names))
    met = frequency.join(used.distinct(), "feature", "left_semi").toArrow()  # at most the words of the examples
    met = met.sort_by([("n", "descending"), ("feature", "ascending")])  # what is looked up most lies together
    feature = met["feature"].combine_chunks()
    idf = np.log((documents + 1) / (met["n"].to_numpy() + 1)) + 1
    as_kept = pc.index_in(feature, value_set=pa.array(names, pa.string())).fill_null(-1).to_numpy().astype(np.int32)
    worded = np.flatnonzero(pc.starts_with(feature, "=").to_numpy(zero_copy_only=False))
    as_word = np.full(len(feature), -1, np.int32)
    as_word[worded] = np.arange(len(worded))
    kept_idf = np.ones(len(names))
    kept_idf[as_kept[as_kept >= 0]] = idf[as_kept >= 0]
    parts, ids = [], []
    for part in range(PARTS):  # a part's strings at a time
        listed = (examples.filter(F.pmod(F.xxhash64("key.doc_id"), F.lit(PARTS)) == part)
                  .select("key.doc_id", F.col("key.label").alias("label"),
                          F.map_filter("found", lambda f, _: f.startswith("=") | f.isin(names)).alias("found")).toArrow())
        for batch in listed.to_batches():
            found = batch.column(2)
            held = np.diff(found.offsets.to_numpy())
            keys, items = found.keys[found.offsets[0].as_py():], found.items[found.offsets[0].as_py():]
            code = pc.index_in(keys[:held.sum()], value_set=feature).to_numpy(zero_copy_only=False).astype(np.int32)
            ids += batch.column(0).to_pylist()  # of any type
            parts.append((batch.column(1).to_numpy(), held, code, items[:held.sum()].to_numpy().astype(np.int32)))
        del listed
    words = [f[1:] for f in feature.take(pa.array(worded)).to_pylist()]
    marks, held, code, count = (np.concatenate(x) for x in zip(*parts))
    del parts
    pa.default_memory_pool().release_unused()
    order = sorted(range(len(ids)), key=ids.__getitem__)
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids))
    named = np.empty(len(ids), object)
    named[:] = [ids[i] for i in order]
    marks, row = marks[order], np.repeat(place, held)
    kept, spoken = as_kept[code] >= 0, as_word[code] >= 0
    as_features = row[kept], as_kept[code[kept]], count[kept]
    row, word, count = row[spoken], as_word[code[spoken]], count[spoken]
    del code
    model = Model(names, kept_idf, named, marks, *as_features, k, words, idf[worded], row, word, count, documents, frequency, weights, docs.schema[doc_id].dataType)
    model.calibrate(_votes(examples, model))
    return model


def _votes(examples: DataFrame, model: Model) -> list[tuple[int, float | None, float | None]]:
    """Every example's votes by the others, taken in tasks: three numbers an example come back."""
    shared = examples.sparkSession.sparkContext.broadcast(model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        row_of = {i: row for row, i in enumerate(judge.ids)}
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                found = judge.own_votes([(row_of[i], dict(f)) for i, f in zip(part.column(0).to_pylist(), part.column(1).to_pylist())])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.float64(), pa.float64()))], ["row", "kept", "whole"])

    dealt = examples.select("key.doc_id", "found").repartition(examples.sparkSession.sparkContext.defaultParallelism)
    return sorted(tuple(r) for r in dealt.mapInArrow(vote, "row long, kept double, whole double").collect())


def _judged(texts: DataFrame, model: Model) -> DataFrame:
    """Per row of ``texts`` (``key`` of any type, ``text``): ``key``, ``score``, ``predicted`` and ``evidence``."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list[str]], list[list]]:
        judge = shared.value

        def work(values: list[str]) -> list[list]:
            found = list(zip(*judge.compare(values)))
            return [*map(list, found[:4]), list(found[4])]

        return work

    numbered = texts.select(F.struct("key", F.monotonically_increasing_id().alias("number")).alias("row"), "text")
    compared = map_texts(numbered, "row", "text", "kept double, products array<double>, places array<int>, square double, loose map<string, int>", make)
    if model.frequency is None:
        compared = compared.withColumn("more", F.lit(0.0))
    else:
        compared = keep(compared, "compared")  # written: a row keeps its number
        loose = (compared.select("row.number", F.explode("loose").alias("word", "count")).withColumn("feature", F.concat(F.lit("="), "word"))
                 .join(model.frequency, "feature", "left"))
        weight = (1 + F.log("count")) * (F.log(F.lit(model.documents + 1.0) / (F.coalesce("n", F.lit(0)) + 1)) + 1)
        more = loose.groupBy("number").agg(F.sum(weight * weight).alias("more"))
        compared = (compared.drop("loose").withColumn("number", F.col("row.number")).join(more, "number", "left")
                    .withColumn("more", F.coalesce("more", F.lit(0.0))))
    chosen = compared.select("row.key", "kept", "products", "places", (F.col("square") + F.col("more")).alias("square"))
    known = T.StructType([T.StructField("doc_id", model.id_type or T.LongType()), *T.StructType.fromDDL("similarity double, label int")])
    schema = T.StructType([chosen.schema["key"], *T.StructType.fromDDL("score double, predicted int"), T.StructField("evidence", T.ArrayType(known))])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            found = [judge.judge(*given) for given in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            columns = [[f[0] for f in found], [int(f[0] >= 0.5) for f in found], [f[1] for f in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=schema.names)

    return chosen.mapInArrow(finish, schema)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``score``, ``predicted`` and ``evidence`` (nearest examples: id, similarity, label)."""
    return _judged(docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")), model).withColumnRenamed("key", doc_id)


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    digest = fresh(docs, "digest")
    judged = _judged(docs.select(F.sha2(whole_text(text), 256).alias("key"), F.col(text).alias("text")), model)
    toxic = judged.filter("predicted = 1").select(F.col("key").alias(digest)).distinct()
    return small_batches(docs).withColumn(digest, F.sha2(whole_text(text), 256)).join(toxic, digest, "left_anti").drop(digest).select(docs.columns)
