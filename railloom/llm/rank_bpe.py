"""Byte-level BPE by a rank file: ids of whole columns of text, and the bytes of ids.

Bytes are read as Latin-1 letters, so that a pyahocorasick automaton over the tokens finds at which places of a word which tokens
begin. The encoding goes from left to right: the longest token that fits the one before it is taken, a shorter one where it does not
fit, and a step back where none does. Two tokens fit when the merges of their joined bytes give just these two; answers are
remembered. A sequence whose neighbours all fit is the one that merges in order of rank give, and there is no other one, so a place
from which no token led on is never tried again: the work grows with the length of the word.

Texts are cut by the pattern of the rank files. Kinds of characters (letter, number, white space, other) are asked of the tiktoken
library itself, whose Unicode tables differ from those of Python.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import table
from .tokens import LETTER, NUMBER, OTHER, SPACE, TEXTS_AT_ONCE, WordEncoder

PAIRS = 2_000_000  # answers that a worker remembers
_NONE = -1


class RankBpe:
    """Encoder and decoder of single words; ranks are ids."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        self.bytes = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.bytes[i] = token
        self.size = [len(t) for t in self.bytes]
        self.fitting: dict[int, bool] = {}
        # Tokens that no merge arrives at stand for whole words only.
        made = {token: i for token, i in self.ids.items() if len(token) == 1 or self.merged(token) == [i]}
        self.shorter = [_NONE] * len(self.bytes)
        self.begins = ahocorasick.Automaton()
        for token, i in made.items():
            # Words are read backwards, so that a match ends where its token begins.
            self.begins.add_word(token[::-1].decode("latin-1"), i)
            self.shorter[i] = next((made[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in made), _NONE)
        self.begins.make_automaton()

    def merged(self, word: bytes) -> list[int]:
        """Ids of a short word by merging the neighbours of least rank until none is left."""
        parts = [word[k : k + 1] for k in range(len(word))]
        while len(parts) > 1:
            ranks = [self.ids.get(a + b, len(self.bytes)) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranks)
            if least == len(self.bytes):
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def fit(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.fitting.get(key)
        if known is None:
            if len(self.fitting) >= PAIRS:
                self.fitting.clear()
            known = self.fitting[key] = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        return known

    def longest(self, word: bytes) -> list[int]:
        """The longest token that begins at each place."""
        found, size, n = [_NONE] * len(word), self.size, len(word)
        for at, i in self.begins.iter(word[::-1].decode("latin-1")):
            if (now := found[n - 1 - at]) == _NONE or size[i] > size[now]:
                found[n - 1 - at] = i
        return found

    def encode(self, word: bytes) -> list[int]:
        """Ids of a word; a word that is a token is that token."""
        if (whole := self.ids.get(word)) is not None:
            return [whole]
        if not word:
            return []
        n, begins, size, shorter = len(word), self.longest(word), self.size, self.shorter
        dead = bytearray(n + 1)
        taken: list[int] = []
        at, token = 0, begins[0]
        while True:
            while token != _NONE and (dead[at + size[token]] or taken and not self.fit(taken[-1], token)):
                token = shorter[token]
            if token != _NONE:
                taken.append(token)
                at += size[token]
                if at == n:
                    return taken
                token = begins[at]
            else:
                dead[at] = 1
                token = taken.pop()
                at -= size[token]
                token = shorter[token]


class RankEncoder(WordEncoder):
    """Texts by the pattern of rank files, each word by `RankBpe`; words met before are looked up."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.words, self.cuts = RankBpe(path), None
        self.kinds = np.full(0x110000, 255, np.uint8)
        # A vocabulary that joins a character with the first byte of the next shows whether the pattern keeps both in one word.
        joins = [bytes([ord(c), b]) for c in "a1!" for b in range(256)]
        ranks = {bytes([b]): b for b in range(256)} | {join: 256 + k for k, join in enumerate(joins)}
        self.probe = tiktoken.Encoding("kinds", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.forget()

    def _kind(self, cp: int) -> int:
        c = chr(cp)
        return next((kind for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if self.probe(beside + c)[0] >= 256), SPACE)

    def _ids(self, word: str) -> list[int]:
        return self.words.encode(word.encode("utf-8", "surrogatepass"))


_ENCODERS: dict[str, RankEncoder] = {}


def rank_encoder(path: str) -> RankEncoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = RankEncoder(path)
    return _ENCODERS[path]


def rank_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encoded(text: str | Column, path: str | None = None) -> Column:
    """Column of little-endian unsigned 32-bit ids of `text`; null and empty texts have none. Special tokens are text like any other."""
    path = path or rank_vocabulary()

    @F.arrow_udf(BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        done = [pa.array([], pa.binary())]
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            ids, counts = rank_encoder(path).encode([t or "" for t in texts.slice(at, TEXTS_AT_ONCE).to_pylist()])
            raw, cuts = ids.astype("<u4", copy=False).tobytes(), [0, *np.cumsum(4 * counts).tolist()]
            done.append(pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()))
        return pa.concat_arrays(done)

    return encode(text)


def decoded(ids: str | Column, path: str | None = None) -> Column:
    """Column of the bytes that little-endian unsigned 32-bit `ids` stand for; null stays null. Ids outside the vocabulary end the job."""
    path = path or rank_vocabulary()

    @F.arrow_udf(BinaryType())
    def decode(columns: pa.Array) -> pa.Array:
        tokens = rank_encoder(path).words.bytes
        done = []
        for raw in columns.to_pylist():
            done.append(None if raw is None else b"".join(map(tokens.__getitem__, memoryview(raw).cast("I"))))
        return pa.array(done, pa.binary())

    return decode(ids)


def op12_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null ids stay null, repeated rows stay apart, other columns are left out, an empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents").select("doc_id", encoded("text").alias("ids"))
    back = docs.select("doc_id", "ids", decoded("ids").alias("bytes"))
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256")
    )
