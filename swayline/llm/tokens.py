"""Token ids of whole texts from a vocabulary file, word by word, with a bounded table of known words."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

from tokenizers import Tokenizer  # noqa: E402

KNOWN = 1 << 20       # words kept; the table starts anew beyond them
JOINED = 200          # words in one string for the library
WIDE = 16             # longer words are not kept
#: Letters, digits and white space of Latin-1 after lower case, as the vocabulary's splitter classes them.
LETTER, DIGIT, WHITE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r\x20\x85\xa0"
CLASS = np.array([next(k for k, c in enumerate((WHITE, LETTER, DIGIT, "\x00-\xff")) if re.match(f"[{c}]", chr(i))) for i in range(256)], np.uint8)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class WordTable:
    """Words of at most 16 bytes, whole in two integers, to numbers: open addressing in arrays."""

    def __init__(self, room: int):
        self.bits = max(4, (2 * room - 1).bit_length())
        self.number = np.full(1 << self.bits, -1, np.int32)
        self.low, self.high = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.uint64)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(7))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers, -1 for unknown words."""
        found, at = np.full(len(low), -1, np.int32), self._slots(low, high)
        open_ = np.arange(len(low))
        while len(open_):
            number = self.number[at]
            hit = (number >= 0) & (self.low[at] == low[open_]) & (self.high[at] == high[open_])
            found[open_[hit]] = number[hit]
            more = (number >= 0) & ~hit
            open_, at = open_[more], at[more] + 1 & (1 << self.bits) - 1
        return found

    def add(self, low: np.ndarray, high: np.ndarray, first: int) -> None:
        """New and distinct words, numbered from ``first``."""
        at, open_ = self._slots(low, high), np.arange(len(low))
        while len(open_):
            slots, place = np.unique(at, return_index=True)
            place = place[self.number[slots] < 0]
            row = open_[place]
            self.number[at[place]], self.low[at[place]], self.high[at[place]] = first + row, low[row], high[row]
            more = np.ones(len(open_), bool)
            more[place] = False
            open_, at = open_[more], at[more] + 1 & (1 << self.bits) - 1


class WordEncoder:
    """Ids (little-endian unsigned 32-bit) of texts, the same as the library gives.

    Right for vocabularies with lower-case NFC normalisation, a splitter into letter runs, single digits and runs of other marks
    that drops white space, and an end mark on every word: a text's ids are then those of its words. Texts of Latin-1 characters
    (which lower case and NFC treat one by one) without apostrophes (which the splitter treats apart) are split here, a block of
    texts at a time. Unknown letter runs go to the library without normaliser and splitter, many in one string, and are parted
    again at the end marks. All other texts go through the whole library.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        plan["normalizer"] = None
        plan["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.words = Tokenizer.from_str(json.dumps(plan))
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocabulary, suffix = self.whole.get_vocab(), plan["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.table, self.pool = WordTable(KNOWN), np.empty(0, np.uint32)
        self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64)

    def _raw(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def _of_words(self, words: list[str]) -> list[np.ndarray]:
        plain = [w for w in words if CLASS[ord(w[0])] == 1]
        parts = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        found: dict[str, np.ndarray] = {}
        for part, encoded in zip(parts, self.words.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(encoded.ids, np.uint32)
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            found.update(zip(part, [ids[a:b] for a, b in zip([0, *cuts], cuts)]))
        return [found[w] if w in found else self._raw(w) for w in words]

    def _block(self, texts: list[bytes]) -> list[bytes]:
        """Ids of lower-case Latin-1 texts."""
        raw = b" ".join([b"", *texts, b" " * WIDE])
        data = np.frombuffer(raw, np.uint8)
        kind = CLASS[data]
        inside = kind != 0
        border = np.empty(len(kind), bool)
        border[0] = True
        border[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        starts = np.flatnonzero(border & inside)
        after = np.empty(len(kind), bool)
        after[:-1] = border[1:]
        after[-1] = True
        lengths = np.flatnonzero(after & inside) + 1 - starts
        windows = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        low = windows[starts] & MASKS[np.minimum(lengths, 8)]
        high = windows[np.minimum(starts + 8, len(windows) - 1)] & MASKS[np.clip(lengths - 8, 0, 8)]
        short = lengths <= WIDE
        number = np.full(len(starts), -1, np.int32)
        number[short] = self.table.find(low[short], high[short])
        fresh = np.flatnonzero((number < 0) & short)
        keys, first, of = np.unique(np.stack([high[fresh], low[fresh]], axis=1), axis=0, return_index=True, return_inverse=True) \
            if len(fresh) else (np.empty((0, 2), np.uint64), fresh, fresh)
        long = np.flatnonzero(~short)
        spell = lambda i: raw[starts[i]:starts[i] + lengths[i]].decode("latin-1")
        new = self._of_words([spell(i) for i in fresh[first].tolist()] + [spell(i) for i in long.tolist()])
        base, known = len(self.start), len(first)
        number[fresh], number[long] = base + of.reshape(-1), base + known + np.arange(len(long))
        counts = np.fromiter(map(len, new), np.int64, len(new))
        pool = np.concatenate([self.pool, *new])
        count = np.concatenate([self.count, counts])
        start = np.concatenate([self.start, len(self.pool) + np.cumsum(counts) - counts])
        each = count[number]
        done = np.cumsum(each)
        ids = pool[np.repeat(start[number] - (done - each), each) + np.arange(done[-1] if len(done) else 0)]
        kept = int(counts[:known].sum())
        self.table.add(keys[:, 1], keys[:, 0], base)
        self.pool, self.start, self.count = pool[:len(self.pool) + kept], start[:base + known], count[:base + known]
        if len(self.start) > KNOWN * 3 // 4:
            self._forget()
        ends = np.cumsum([1, *(len(t) + 1 for t in texts)])
        cuts = np.concatenate([[0], done])[np.searchsorted(starts, ends)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _lowered(self, text: str) -> bytes | None:
        if "'" in text or any(s in text for s in self.special):
            return None
        try:
            return text.encode("latin-1") and text.lower().encode("latin-1")
        except UnicodeEncodeError:
            return None

    def encode(self, texts: list[str]) -> list[bytes]:
        lowered = list(map(self._lowered, texts))
        found = iter(self._block([x for x in lowered if x is not None]))
        return [next(found) if x is not None else array("I", self.whole.encode(t, add_special_tokens=False).ids).tobytes()
                for t, x in zip(texts, lowered)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per worker process, so the table serves all its tasks."""
    return WordEncoder(path)
