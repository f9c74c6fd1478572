"""SentencePiece encoding and decoding by a streaming Viterbi search over a vocabulary's pieces and scores.

The best segmentation is the one with the largest sum of piece scores; of equal sums, the one whose last piece starts earlier.
The search walks the text once and keeps back pointers only since the last committed boundary: every ``LONGEST`` characters the
back pointers of all positions that a piece can still be appended to are followed until they meet, and ids up to there are final.
Characters without a piece become byte pieces, at the lowest score less ten.

White space that follows other characters always starts a piece in such vocabularies, and so do common marks after letters, so all
paths converge there: the search is run for each stretch between those boundaries, and its ids are kept in a bounded cache. Null texts count as empty. Decoding returns
the text but for U+2581 itself, which stands for a blank.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from swayline.llm.common import map_texts

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"
MARKS = ",.;:!?"
CACHED = 600_000
CACHED_CHARS = 48


class Pieces:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.known: dict[str, tuple[int, float]] = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
        self.longest = max(map(len, self.known))
        self.prefixes = {p[:n] for p in self.known for n in range(1, len(p) + 1)}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = min(s for _, s in self.known.values()) - 10
        self.surface = [b""] * model.get_piece_size()
        for piece, (i, _) in self.known.items():
            self.surface[i] = piece.replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([b])
        bad = [p for p in self.known if BLANK in p.lstrip(BLANK)]
        if bad:
            raise ValueError("a piece has white space after other characters: " + bad[0])
        # Marks that no piece has after a letter: where one follows a letter, a new piece starts.
        letter = r"[^\W\d_]"
        inner = {p[i] for p in self.known for i in range(1, len(p)) if re.match(letter, p[i - 1])}
        marks = re.escape("".join(m for m in MARKS if m not in inner)) or "\ue000"
        self.stretches = re.compile(f"{BLANK}*[^{BLANK}](?:[^{BLANK}{marks}]+|(?<!{letter})[{marks}])*|{BLANK}+").findall
        self.scored: dict[str, tuple[int, float] | None] = {p: self.known.get(p) for p in self.prefixes}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def stream(self, blocks: Iterable[str]) -> Iterator[list[int]]:
        """Ids of the concatenation of ``blocks``, in final portions. Holds the text since the last commitment only."""
        text, base, done = "", 0, False           # text[0] is position base, the last committed boundary
        best, back, at = {0: 0.0}, {}, 0            # back: end -> (start, id or None for byte pieces)
        feed = iter(blocks)
        while True:
            while not done and len(text) - (at - base) < self.longest:
                block = next(feed, None)
                done = block is None
                text += block or ""
            if at - base >= len(text):
                break
            here, score, i = at, best.pop(at), at - base
            single = False
            for j in range(i + 1, min(i + self.longest, len(text)) + 1):
                part = text[i:j]
                if part not in self.prefixes:
                    break
                piece = self.known.get(part)
                if piece:
                    end, total = base + j, score + piece[1]
                    single |= j == i + 1
                    if end not in best or total > best[end]:
                        best[end], back[end] = total, (here, piece[0])
            if not single and (here + 1 not in best or score + self.unknown > best[here + 1]):
                best[here + 1], back[here + 1] = score + self.unknown, (here, None)
            at += 1
            if (at - base) % self.longest == 0 and at - base < len(text):
                front = set(best)
                while len(front) > 1 and max(front) > base:
                    front.add(back[max(front)][0])
                    front.remove(max(front))
                met = front.pop()
                if met > base:
                    yield self._path(text, base, met, back)
                    for end in [e for e in back if e <= met]:
                        del back[end]
                    text, base = text[met - base:], met
        if at > base:
            yield self._path(text, base, at, back)

    def _path(self, text: str, base: int, end: int, back: dict | list) -> list[int]:
        parts = []
        at = end
        while at > base:
            start, piece = back[at]
            parts.append([piece] if piece is not None else
                         [self.byte_ids[b] for b in text[start - base:at - base].encode("utf-8", "surrogatepass")])
            at = start
        return [i for part in reversed(parts) for i in part]

    def _window(self, text: str) -> list[int]:
        """``stream`` for a text no longer than a piece can be: one window, committed at its end."""
        size = len(text)
        best, back, scored, missing = [0.0] + [float("-inf")] * size, [(0, None)] * (size + 1), self.scored, ()
        for i in range(size):
            score, single = best[i], False
            for j in range(i + 1, size + 1):
                piece = scored.get(text[i:j], missing)
                if piece is missing:
                    break
                if piece is not None:
                    single |= j == i + 1
                    total = score + piece[1]
                    if total > best[j]:
                        best[j], back[j] = total, (i, piece[0])
            if not single and score + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = score + self.unknown, (i, None)
        return self._path(text, 0, size, back)

    def _stretch(self, stretch: str) -> bytes:
        ids = self.old.get(stretch)
        if ids is None:
            parts = [self._window(stretch)] if len(stretch) <= self.longest else self.stream([stretch])
            ids = b"".join(array("I", part).tobytes() for part in parts)
        if len(stretch) <= CACHED_CHARS:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[stretch] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if not text:
            return b""
        stretches = self.stretches(BLANK + text.replace(" ", BLANK))
        found = list(map(self.young.get, stretches))
        if None in found:
            found = [self._stretch(s) if f is None else f for s, f in zip(stretches, found)]
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One per worker process, so the cache serves all its tasks."""
    return Pieces(path)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: id and ``ids`` (array of int)."""

    def make() -> Callable[[list[str]], list[list]]:
        return lambda texts: [[np.frombuffer(pieces(vocabulary).encode(t), "<u4").astype(np.int32) for t in texts]]

    return map_texts(docs, doc_id, text, "ids array<int>", make)


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: id, ``n_ids``, ``ids_crc32`` and ``restored``: whether decoding gives the text back."""

    def make() -> Callable[[list[str]], list[list]]:
        def work(texts: list[str]) -> list[list]:
            table = pieces(vocabulary)
            ids = [table.encode(t) for t in texts]
            return [[len(i) // 4 for i in ids], [zlib.crc32(i) for i in ids], [table.decode(i) == t for i, t in zip(ids, texts)]]

        return work

    return map_texts(docs, doc_id, text, "n_ids long, ids_crc32 long, restored boolean", make)
