"""Token ids of whole columns of text, by the tokenizers library, with each distinct word encoded once per worker.

The text of a batch is cut into words with array operations that follow the tokenizer's own splitting rule, words are told
apart by a 64-bit hash of their characters and length, and only words that the worker has not met are given to the BPE model.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import remembers

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
# The word endings that the splitting rule of the byte-level tokenizer takes off behind an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SEGMENT = 1 << 20  # characters worked on at once
CACHE = 600_000  # words kept by a worker
TEXTS_AT_ONCE = 512
_ODD = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, SEGMENT + 1)
        _POWERS[:] = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


class WordEncoder:
    """Byte-level BPE of a tokenizer file; ids equal `encode(text, add_special_tokens=False)`.

    With `added` the tokenizer's added tokens are cut out of texts and get their own ids, as the library does; without, they are
    text like any other, as with its switch encode_special_tokens.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        own = self.tokenizer.get_added_tokens_decoder() if added else {}
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in own.values()):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.added = {t.content: i for i, t in own.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.model, self.splitter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        if "ByteLevel" not in repr(self.splitter) or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        self.model._resize_cache(0)  # words are kept here instead
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.n_ids = 0

    def _kind(self, cp: int) -> int:
        c = chr(cp)
        for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.splitter.pre_tokenize_str(beside + c + beside)) == 1:
                return kind
        return SPACE

    def _kinds(self, cps: np.ndarray) -> np.ndarray:
        kinds = self.kinds[cps]
        if (new := cps[kinds == UNKNOWN]).size:
            for cp in np.unique(new).tolist():
                self.kinds[cp] = self._kind(cp)
            kinds = self.kinds[cps]
        return kinds

    def _starts(self, cps: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Where words begin; heads: where texts begin."""
        n, kinds = len(cps), self._kinds(cps)
        head = np.zeros(n + 1, bool)
        head[heads] = True
        head[n] = True
        space = kinds == SPACE
        before = np.empty(n, np.uint8)
        before[0], before[1:] = SPACE, kinds[:-1]
        blank = np.empty(n, bool)
        blank[0], blank[1:] = False, cps[:-1] == 32
        after_space = np.empty(n, bool)
        after_space[-1], after_space[:-1] = True, space[1:]
        start = head[:n] | np.where(space, (before != SPACE) | ~(after_space | head[1:]), (before != kinds) & ~blank)
        quotes = np.flatnonzero((cps == 39) & start)
        if quotes.size:
            ends = np.append(heads[1:], n)[np.searchsorted(heads, quotes, side="right") - 1]
            free = np.ones(len(quotes), bool)
            for ending in ENDINGS:
                hit = free & (quotes + len(ending) < ends)
                for k, c in enumerate(ending, 1):
                    hit[hit] = cps[quotes[hit] + k] == ord(c)
                at = quotes[hit]
                start[at + 1] = False
                rest = at + 1 + len(ending)
                start[rest[rest < n]] = True
                free &= ~hit
        return start

    def _segment(self, text: str, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts joined to one, and how many ids each has. Every text has a character at least."""
        cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.flatnonzero(self._starts(cps, heads))
        end = np.append(begin[1:], len(cps))
        power, inverse = _powers(len(cps) + 1)
        mixed = cps.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= power[: len(cps)]
        total = np.empty(len(cps) + 1, np.uint64)
        total[0] = 0
        np.cumsum(mixed, out=total[1:])
        key = (total[end] - total[begin]) * inverse[begin]
        key ^= key >> np.uint64(31)
        key = key * np.uint64(0xBF58476D1CE4E5B9) + (end - begin).astype(np.uint64)
        codes, distinct = pd.factorize(key)
        names = distinct.tolist()
        if len(self.known) + len(names) > CACHE:
            self.forget()
        found = list(map(self.known.get, names))
        if None in found:
            where = np.empty(len(names), np.int64)
            where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            for i, f in enumerate(found):
                if f is None:
                    w = where[i]
                    found[i] = self._learn(names[i], text[begin[w] : end[w]])
        word = np.array(found, np.int64)[codes]
        size = self.size[word]
        upto = np.cumsum(size)
        ids = self.ids[np.arange(upto[-1]) + np.repeat(self.first[word] - upto + size, size)]
        words = np.searchsorted(begin, np.append(heads, len(cps)))
        return ids, np.diff(np.append(0, upto)[words])

    def _ids(self, word: str) -> list[int]:
        letters = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(letters)]

    def _learn(self, key: int, word: str) -> int:
        ids = self._ids(word)
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.empty(len(self.ids) + len(ids), np.uint32))
        at = len(self.known)
        if at == len(self.first):
            self.first, self.size = np.append(self.first, np.zeros_like(self.first)), np.append(self.size, np.zeros_like(self.size))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.first[at], self.size[at], self.known[key] = self.n_ids, len(ids), at
        self.n_ids += len(ids)
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        remembers("tokens", self.forget)
        counts = np.zeros(len(texts), np.int64)
        found: list[np.ndarray] = []
        held: list[str] = []
        owner: list[int] = []
        length = 0

        def flush() -> None:
            nonlocal length
            if held:
                heads = np.cumsum([0, *map(len, held[:-1])])
                ids, n = self._segment("".join(held), heads)
                found.append(ids)
                np.add.at(counts, owner, n)
                held.clear()
                owner.clear()
                length = 0

        for i, text in enumerate(texts):
            for k, part in enumerate(self.cuts.split(text) if self.cuts else [text]):
                if k % 2:  # an added token
                    flush()
                    found.append(np.array([self.added[part]], np.uint32))
                    counts[i] += 1
                    continue
                for piece in _pieces(part):
                    if length + len(piece) > SEGMENT:
                        flush()
                    held.append(piece)
                    owner.append(i)
                    length += len(piece)
        flush()
        return np.concatenate(found) if found else np.empty(0, np.uint32), counts


def _pieces(text: str):
    """Long texts in pieces that the splitting rule cuts like the whole: each later piece begins with the first of some white space."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = at + SEGMENT // 2
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
            cut = len(text) if cut < 0 else cut
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, added: bool = False) -> WordEncoder:
    """The encoder of this Python worker."""
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = WordEncoder(path, added)
    return _ENCODERS[path, added]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ids_column(text, path: str, end_id: int, added: bool = False):
    """Column of little-endian unsigned 32-bit ids of `text` (null: empty), the end id behind them."""
    last = np.array([end_id], "<u4").tobytes()

    @F.arrow_udf(BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        done = [pa.array([], pa.binary())]
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            ids, counts = encoder(path, added).encode([t or "" for t in texts.slice(at, TEXTS_AT_ONCE).to_pylist()])
            cuts = np.append(0, np.cumsum(counts))
            done.append(pa.array([ids[a:b].astype("<u4", copy=False).tobytes() + last for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()))
        return pa.concat_arrays(done)

    return encode(text)
