"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts.

Two models, of toxic and of ordinary text, predict each word from the word before it. A pair of words backs off to the pair's
counts in both classes and to the word alone, which is spelt letter by letter behind all of the word up to there, so that an inflected
form shares the counts of its stem. Both models take off the same discount. Letters back off to the counts of both classes together and
from there to ever shorter contexts of letters with continuation counts, which the classes share. An expression that neither class has
met therefore falls back to the same probability in both and says nothing.

A text's score is a logistic function of two length-normalised log-likelihood ratios: the mean of all its words and pairs, and the
logarithm of their mean likelihood ratio, which the most toxic of them make up. Both are sums over words and pairs, so that whoever
holds a part of the model can add up its share of each text: a text is read once, a chunk of rows sends each bucket of the model its
words or pairs with the places of the rows that hold them, and gets two sums a row back. Buckets are tables of arrays that grow in number with
the corpus: pairs by hashes of the words, words by their first letters, with which the tree of all spellings is cut. Workers know a
fixed number of the commonest words themselves, which only spares them the question. Rounds over shares of the rows bound what lies on
disk between the two shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from xxhash import xxh64_intdigest

from .common import discard, keyed, remembers, stash, table, tidy, tidy_group, tidy_groups

CELLS = 1 << 20
LONGEST = 64  # letters of a token; longer runs are several tokens, one after the other
LOWER = 4  # letters of the longest shared context below a whole prefix
DISCOUNT = 0.75
SHARED = 30.0  # weight of the shared counts besides what the discount gives them
FOLDS = 5  # fold 0 is held out, the last one sets the logistic function, the others make the models
FIT_ROWS = 20_000  # rows at most that set the logistic function: a bounded sample, those of least hash
COMMON = 1 << 16  # words that workers score without asking
BLOCK = 1 << 21  # characters read at once
CROWN = 4  # letters by which words are dealt out to have their spelling looked up
SPLITS = 16  # buckets at most for words that share two letters
ROOM = 1 << 18  # pairs of the model in a bucket, about
LETTERS = 128  # characters of the corpus for one pair of the model, about
ROUNDS = 8  # shares of the rows that are scored one after the other
LESSONS = 3  # shares of the pairs that are learned one after the other
CHUNK = 12  # 2 ** CHUNK rows are scored together,
FULL = 1 << 23  # but not more than so many characters, unless one text has them
SLOTS = np.uint64((1 << 18) - 1)
TURN = 21  # bits that the hash of a pair's second word is turned by
TOP = np.uint64(0xFFFF << 48)  # bits of a pair's key that are those of its first word
HIGHEST = 30.0  # of a ratio, before it is raised to e
SMALL = 1 << 20  # rows of a model at most that Model.score takes to the workers
END = "$"  # stands behind words
_WORD = regex.compile(r"[\p{L}\p{N}]{1,%d}" % LONGEST)


def cell(prefix: Column) -> Column:
    return F.xxhash64(prefix).bitwiseAND(F.lit(CELLS - 1)).cast("int")


def cell_of(prefix: str) -> int:
    """The same cell in Python: Spark's hash of a string is 64-bit xxHash with seed 42."""
    return xxh64_intdigest(prefix.encode("utf-8", "surrogatepass"), 42) & (CELLS - 1)


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@cache
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """For each character 0, or a random number if it belongs to words; powers of a base from 0 to LONGEST + 1."""
    numbers = np.random.default_rng(9).integers(1, 1 << 63, 0x110000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    word = np.zeros(0x110000, bool)
    word[[ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every)]] = True
    return np.where(word, numbers, np.uint64(0)), np.cumprod(np.append(np.uint64(1), np.full(LONGEST + 1, 0x9E3779B97F4A7C15, np.uint64)))


@dataclass(frozen=True)
class Words:
    """The words of some texts, one after the other: their texts' numbers, hashes, and places in all letters."""

    letters: str
    codes: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def spelt(self, at: np.ndarray) -> list[str]:
        return [self.letters[a:z] for a, z in zip(self.start[at].tolist(), self.end[at].tolist(), strict=True)]

    def pairs(self) -> np.ndarray:
        """Places of the words that another one of the same text follows."""
        return np.flatnonzero(self.text[1:] == self.text[:-1])

    def buckets(self, at: np.ndarray, buckets: int) -> np.ndarray:
        starts = np.zeros((len(at), CROWN), np.int64)
        size = self.end[at] - self.start[at]
        for k in range(CROWN):
            inside = size > k
            starts[inside, k] = self.codes[self.start[at[inside]] + k]
            starts[size == k, k] = ord(END)
        return bucket_of(starts, buckets)


def words_of(texts: list[str | None]) -> Iterator[Words]:
    """What `tokens_of` gives, for whole texts, a few at a time. A hash is a polynomial in the letters, mixed."""
    lowered, first, total = [], 0, 0
    for i, text in enumerate(texts):
        own = (text or "").lower()
        if lowered and total + len(own) > BLOCK:
            yield _words_of(lowered, first)
            lowered, first, total = [], i, 0
        lowered.append(own)
        total += len(own) + 1
    yield _words_of(lowered, first)


def _words_of(lowered: list[str], first: int) -> Words:
    remembers("toxicity", _alphabet.cache_clear)
    numbers, powers = _alphabet()
    letters = "\n".join([*lowered, ""]) or "\n"
    codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32)
    v = numbers[codes]
    word = v > 0  # the last letter is none
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    edges = np.append(0, edges) if word[0] else edges
    start, end = edges[::2], edges[1::2]
    pieces = (end - start + LONGEST - 1) // LONGEST
    if (pieces > 1).any():
        run = np.repeat(np.arange(len(start)), pieces)
        start = start[run] + LONGEST * (np.arange(len(run)) - (np.cumsum(pieces) - pieces)[run])
        end = np.minimum(start + LONGEST, end[run])
    size = end - start
    h = size.astype(np.uint64)
    here = np.arange(len(h))
    for k in range(int(size.max(initial=0))):
        here = here[size[here] > k] if k else here
        h[here] += v[start[here] + k] * powers[k + 1]
    begin = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    count = np.diff(np.searchsorted(start, begin))
    return Words(letters, codes, first + np.repeat(np.arange(len(lowered)), count), _mixed(h), start, end)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The highest bits are those of the first word, so that all pairs of a word lie in one bucket."""
    return before & TOP | (before ^ (word << np.uint64(TURN) | word >> np.uint64(64 - TURN))) & ~TOP


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)


def _dealt(two: np.ndarray, split: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(two + split.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)


def _start_hash(starts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(starts), np.uint64)
    for column in starts.T:
        h = _mixed((h + column.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return h


def bucket_of(starts: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of words by the code points of their first CROWN letters with END, and zeros behind END."""
    return _dealt(_start_hash(starts[:, :2]), _start_hash(starts) % np.uint64(SPLITS), buckets)


def homes(prefix: str, buckets: int) -> np.ndarray:
    """The buckets with words that start with this prefix of CROWN letters at most: one if it tells all of them, else SPLITS; all
    buckets for a single letter, of which there are no more than the alphabet has."""
    starts = np.zeros((1, CROWN), np.int64)
    starts[0, : len(prefix)] = [ord(c) for c in prefix]
    if len(prefix) == CROWN or prefix.endswith(END):
        return bucket_of(starts, buckets)
    if len(prefix) == 1:
        return np.arange(buckets)
    return np.unique(_dealt(np.repeat(_start_hash(starts[:, :2]), SPLITS), np.arange(SPLITS), buckets))


def _shut(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _opened(column, kind: type) -> np.ndarray:
    """A column of shut arrays as one."""
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(zstandard.decompress(x.as_py()), kind) for x in column)])


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """A place of each different key in their order, and the sums of its counts."""
    o = np.argsort(keys, kind="stable")
    first = _firsts(keys[o])
    return o[first], *(np.add.reduceat(c[o], first) if len(first) else c[:0] for c in counts)


def _joined(words: list[str]) -> bytes:
    return zstandard.compress("\n".join(words).encode("utf-8", "surrogatepass"), 1)


def _parted(column) -> list[str]:
    return [w for x in column if (text := zstandard.decompress(x.as_py())) for w in text.decode("utf-8", "surrogatepass").split("\n")]


COUNTED = "part long, h binary, w binary, t binary, o binary, words binary"


def counted(texts: DataFrame, buckets: int) -> DataFrame:
    """How often toxic and ordinary texts hold each pair and each word, from rows (toxic 0/1, text). One row for each bucket of pairs
    (part from 0: both hashes and counts) and of words (part -1 and below: hash, counts, words)."""

    def rows(part: int, h, w, t, o, words: list[str]) -> tuple:
        return part, _shut(h), _shut(w), _shut(t), _shut(o), _joined(words)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), *[pa.binary()] * 5]
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)], ["part", "h", "w", "t", "o", "words"])

    def tallied(texts: list[str | None], toxic: np.ndarray) -> Iterator[tuple]:
        for found in words_of(texts):
            bad = toxic[found.text]
            at, t, n = _summed(found.hash, bad, np.ones_like(bad))
            home, words = found.buckets(at, buckets), found.spelt(at)
            for b, own in _by(home):
                yield rows(-1 - b, found.hash[:0], found.hash[at[own]], t[own], n[own] - t[own], [words[k] for k in own])
            pairs = found.pairs()
            h, w = found.hash[pairs], found.hash[pairs + 1]
            keys = pair_keys(h, w)
            at, t, n = _summed(keys, bad[pairs], np.ones_like(bad[pairs]))
            for b, own in _by(_bucket(keys[at], buckets)):
                yield rows(b, h[at[own]], w[at[own]], t[own], n[own] - t[own], [])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic, total = [], [], 0
        for b in batches:
            texts += b.column(1).to_pylist()
            toxic += b.column(0).to_pylist()
            total = sum(len(t or "") for t in texts)
            if total >= BLOCK:
                yield table(list(tallied(texts, np.array(toxic, np.int64))))
                texts, toxic = [], []
        if texts:
            yield table(list(tallied(texts, np.array(toxic, np.int64))))

    def merge(rows_: pa.Table) -> pa.Table:
        part = rows_["part"][0].as_py()
        w, t, o = _opened(rows_["w"], np.uint64), _opened(rows_["t"], np.int64), _opened(rows_["o"], np.int64)
        if part < 0:
            words = _parted(rows_["words"])
            at, t, o = _summed(w, t, o)
            return pa.Table.from_batches([table([rows(part, w[:0], w[at], t, o, [words[k] for k in at])])])
        h = _opened(rows_["h"], np.uint64)
        at, t, o = _summed(pair_keys(h, w), t, o)
        return pa.Table.from_batches([table([rows(part, h[at], w[at], t, o, [])])])

    return texts.select("toxic", "text").mapInArrow(tidy(count), COUNTED).groupBy("part").applyInArrow(tidy_group(merge), COUNTED)


def _by(home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and its places, in their order."""
    o = np.argsort(home, kind="stable")
    first = _firsts(home[o])
    for a, z in zip(first, [*first[1:], len(home)], strict=False):
        yield int(home[o[a]]), o[a:z]


def _unpacked(keys, ratios, kind: type = np.float64) -> tuple[np.ndarray, np.ndarray]:
    """Columns of packed rows as one sorted array of keys and their ratios."""
    k = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_py(), np.uint64) for x in keys)])
    r = np.concatenate([np.zeros(0), *(np.frombuffer(x.as_py(), kind) for x in ratios)])
    if (k[1:] >= k[:-1]).all():
        return k, r
    o = np.argsort(k, kind="stable")
    return k[o], r[o]


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `asked` are among the sorted keys, and the places of these."""
    at = np.searchsorted(keys, asked)
    hit = at < len(keys)
    hit[hit] = keys[at[hit]] == asked[hit]
    return hit, at[hit]


def _places(keys: np.ndarray) -> np.ndarray:
    """A place of each different key: the last one in a slot holds it, keys that lost theirs go on."""
    slots = np.empty(int(SLOTS) + 1, np.int64)
    rest, out = np.arange(len(keys)), []
    while len(rest):
        slot = keys[rest] & SLOTS
        slots[slot] = rest
        held = slots[slot]
        out.append(rest[held == rest])
        rest = rest[keys[held] != keys[rest]]
    return np.concatenate(out) if out else rest


def steps_of(words: DataFrame, *others: str) -> DataFrame:
    """One row per letter of each `word` and its end: parent (the word up to there), letter."""
    return _steps(words.withColumn("word", F.concat("word", F.lit(END))), *others)


def _steps(spelt: DataFrame, *others: str) -> DataFrame:
    steps = F.transform(F.sequence(F.lit(1), F.length("word")), lambda k: F.struct(F.substring("word", F.lit(1), k - 1).alias("parent"), F.substring("word", k, F.lit(1)).alias("letter")))
    return spelt.select(F.explode(steps).alias("s"), *others).select("s.*", *others)


def _context(parent: str) -> Column:
    return F.substring(F.concat(F.lit("^"), parent), -LOWER, LOWER)


def shorter(edges: DataFrame) -> DataFrame:
    """context, letter, p: the shared probability of a letter behind the last LOWER letters, by continuation counts of ever shorter contexts."""
    return backed(edges.select(_context("parent").alias("context"), "letter", F.lit(1).alias("n")))


def backed(counts: DataFrame) -> DataFrame:
    """The same from rows (context, letter, n): behind how many whole prefixes that end so the letter stands."""
    levels = [stash(counts.groupBy("context", "letter").agg(F.sum("n").alias("n")), "level")]  # each is read three times
    for size in range(LOWER - 1, -1, -1):
        context = F.substring("context", -size, size) if size else F.lit("")
        levels.append(stash(levels[-1].select(context.alias("context"), "letter").groupBy("context", "letter").agg(F.count("*").alias("n")), "level"))
    p = None
    for size, level in enumerate(reversed(levels)):
        sums = level.groupBy("context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        rows = level.join(sums, "context")
        if p is None:
            p = rows.select("context", "letter", (F.col("n") / F.col("all")).alias("p"))
            continue
        below = p.select(F.col("context").alias("below"), "letter", F.col("p").alias("q"))
        short = F.substring("context", -(size - 1), size - 1) if size > 1 else F.lit("")
        p = rows.withColumn("below", short).join(below, ["below", "letter"]).select("context", "letter", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("q")) / F.col("all")).alias("p"))
    out = stash(p, "shorter")
    discard(*levels)
    return out


def _class_sums(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.count("*").alias("kinds"),
        *(F.sum(c).alias(f"all_{c}") for c in "to"),
        *(F.sum((F.col(c) > 0).cast("int")).alias(f"kinds_{c}") for c in "to"),
    )


def _taken(c: str) -> Column:
    return DISCOUNT * F.col(f"kinds_{c}") + SHARED


def _log_p(c: str, below: Column) -> Column:
    return F.log((F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + _taken(c) * below) / (F.col(f"all_{c}") + SHARED))


class Letters:
    """Words as code points; `walk` goes through them letter by letter, up to and with END."""

    def __init__(self, words: list[str]):
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        self.sums = np.zeros(len(words), np.uint64)

    def walk(self, here: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Letters k of the words `here`, which have that many, and keys of the prefixes that end with them."""
        numbers, powers = _alphabet()
        inside = self.size[here] > k
        letter = np.full(len(here), ord(END), np.int64)
        letter[inside] = self.codes[self.start[here[inside]] + k]
        self.sums[here] += np.where(inside, numbers[letter], np.uint64(0xD6E8FEB86659FD93)) * powers[k + 1]
        return letter, _mixed(self.sums[here] + np.uint64(k + 1))


@dataclass(frozen=True)
class Tree:
    """The edges of the tree of some words, from CROWN letters on: keys of the prefixes that they end, edges above them, the last LOWER
    letters before and the letter as one string, counts."""

    key: np.ndarray
    above: np.ndarray
    gram: np.ndarray  # which of the different ones
    grams: list[str]
    t: np.ndarray
    o: np.ndarray

    def log_p(self, p: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """log p in both classes of each edge, by the shared probabilities of the grams."""
        shared, kinds = np.array([p[g] for g in self.grams])[self.gram], np.bincount(self.above)[self.above]
        total = {c: np.bincount(self.above, n)[self.above] for c, n in (("t", self.t), ("o", self.o))}
        shared = (self.t + self.o - DISCOUNT + DISCOUNT * kinds * shared) / (total["t"] + total["o"])
        out = []
        for c, n in (("t", self.t), ("o", self.o)):
            taken = DISCOUNT * np.bincount(self.above, n > 0)[self.above] + SHARED
            out.append(np.log((np.maximum(n - DISCOUNT, 0.0) + taken * shared) / (total[c] + SHARED)))
        return out[0], out[1]


def tree_of(words: list[str], t: np.ndarray, o: np.ndarray) -> Tree:
    letters = Letters(words)
    here, at, base = np.arange(len(words)), np.zeros(len(words), np.int64), 1
    out: list[tuple] = []
    for k in range(int(letters.size.max(initial=-1)) + 1):
        here = here[letters.size[here] >= k]
        letter, keys = letters.walk(here, k)
        own, first, of = np.unique(keys, return_index=True, return_inverse=True)
        if k >= CROWN:
            back = letters.start[here[first]][:, None] + np.arange(k - LOWER, k)
            gram = np.hstack([letters.codes[back], letter[first][:, None].astype(np.uint32)])
            out.append((own, at[here[first]], gram, np.bincount(of, t[here]), np.bincount(of, o[here])))
        at[here] = base + of
        base += len(own)
    if not out:
        return Tree(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), [], np.zeros(0), np.zeros(0))
    key, above, gram, t, o = (np.concatenate(x) for x in zip(*out, strict=True))
    _, first, of = np.unique(_start_hash(gram), return_index=True, return_inverse=True)
    return Tree(key, above, of, np.ascontiguousarray(gram[first], "<u4").view(f"<U{LOWER + 1}").ravel().tolist(), t, o)


def _spelt(keys: np.ndarray, ratios: np.ndarray, words: list[str]) -> np.ndarray:
    """Sums of the ratios (columns) along the words, as far as the keys have met their letters; the rest is the same in both. Up to
    CROWN letters the ratios are such sums themselves."""
    letters, here, out = Letters(words), np.arange(len(words)), np.zeros((len(words), ratios.shape[1]))
    for k in range(int(letters.size.max(initial=-1)) + 1):
        here = here[letters.size[here] >= k]
        hit, at = _found(keys, letters.walk(here, k)[1])
        here = here[hit]
        out[here] = ratios[at] + (out[here] if k >= CROWN else 0.0)
    return out


SPELT = "part long, home long, keys binary, t binary, o binary"


def spelling(words: DataFrame, buckets: int) -> DataFrame:
    """From the words' rows of `counted`, stored: for each part (below 0) keys of prefixes with log p in both classes, and with the
    difference in place of that in toxic text (`home` null); for each bucket by the words' hashes (part null) their log p; the commonest words
    (both null) with ratios."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """part, gram, t, o, n: behind how many prefixes a gram stands (n), and the words' first letters with the words' counts (n null)."""
        for b in batches:
            for k in range(b.num_rows):
                own = b.slice(k, 1)
                said, t, o = _parted(own["words"]), _opened(own["t"], np.int64), _opened(own["o"], np.int64)
                tree = tree_of(said, t, o)
                n = np.bincount(tree.gram, minlength=len(tree.grams))
                crowns, of = np.unique(np.array([(w + END)[:CROWN] for w in said]), return_inverse=True)
                none = [None] * len(crowns)
                yield pa.record_batch(
                    [
                        pa.array([own["part"][0].as_py()] * (len(n) + len(crowns)), pa.int64()),
                        pa.array([*tree.grams, *crowns.tolist()], pa.string()),
                        *(pa.array(np.concatenate([0 * n, np.bincount(of, x).astype(np.int64)])) for x in (t, o)),
                        pa.array([*n.tolist(), *none], pa.int64()),
                    ],
                    ["part", "gram", "t", "o", "n"],
                )

    steps = stash(words.select("part", "t", "o", "words").mapInArrow(tidy(cut), "part long, gram string, t long, o long, n long"), "letters")
    crowns = steps.filter("n IS NULL").select(F.col("gram").alias("word"), "t", "o")
    low = stash(_steps(crowns, "t", "o").groupBy("parent", "letter").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "low").withColumn("context", _context("parent"))
    high = steps.filter("n IS NOT NULL").withColumn("context", F.substring("gram", 1, LOWER)).withColumn("letter", F.substring("gram", LOWER + 1, 1))
    p = backed(high.select("context", "letter", "n").unionByName(low.select("context", "letter", F.lit(1).alias("n"))))

    shared = (F.col("t") + F.col("o") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("p")) / (F.col("all_t") + F.col("all_o"))
    logs = low.join(p, ["context", "letter"]).join(_class_sums(low, "parent"), "parent").select(F.concat("parent", "letter").alias("prefix"), *(_log_p(c, shared).alias(c) for c in "to"))
    logs = stash(logs, "logs")
    paths = logs.select(F.col("prefix").alias("gram"), F.explode(F.sequence(F.lit(1), F.length("prefix"))).alias("k")).select("gram", F.expr("substring(gram, 1, k)").alias("prefix"))
    starts = paths.join(logs, "prefix").groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [homes(gram, buckets) for gram in b.column(0).to_pylist()]
            of = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            part = -1 - np.concatenate([np.zeros(0, np.int64), *found])
            yield pa.record_batch([pa.array(part), b.column(0).take(of), pa.nulls(len(part), pa.float64()), b.column(1).take(of), b.column(2).take(of)], ["part", "gram", "p", "t", "o"])

    none = F.lit(None).cast("double")
    known = high.join(p, ["context", "letter"]).select("part", "gram", "p", none.alias("t"), none.alias("o"))
    known = known.unionByName(starts.select("gram", "t", "o").mapInArrow(tidy(deal), "part long, gram string, p double, t double, o double"))
    most = 1 + COMMON // buckets if COMMON else 0

    def spell(words: pa.Table, known: pa.Table) -> pa.Table:
        said, w = _parted(words["words"]), _opened(words["w"], np.uint64)
        n = _opened(words["t"], np.int64), _opened(words["o"], np.int64)
        tree = tree_of(said, *n)
        grams, p, t, o = (known[c].to_pylist() for c in ("gram", "p", "t", "o"))
        first = [k for k, x in enumerate(p) if x is None]
        behind = tree.log_p({g: x for g, x in zip(grams, p, strict=True) if x is not None})
        starts = Letters([grams[k] for k in first])
        keys = np.zeros(len(first), np.uint64)
        for k in range(CROWN):
            here = np.flatnonzero(starts.size > k)
            _, found = starts.walk(here, k)
            keys[here] = found
        keys = np.concatenate([keys, tree.key])
        log_p = np.concatenate([np.array([(t[k], o[k]) for k in first]).reshape(-1, 2), np.stack(behind, 1)])
        order = np.argsort(keys)
        keys, log_p = keys[order], log_p[order]
        part = known["part"][0].as_py()
        ratios = (log_p[:, 0] - log_p[:, 1]).astype(np.float32)
        rows = [(part, None, keys.tobytes(), ratios.tobytes(), None)]
        own = _spelt(keys, log_p, said)
        for home, at in _by(_bucket(w, buckets)):
            rows.append((None, home, w[at].tobytes(), own[at, 0].tobytes(), own[at, 1].tobytes()))
        top = np.lexsort((w, -(n[0] + n[1])))[:most]
        rows.append((None, None, w[top].tobytes(), _spelt(keys, ratios[:, None], [said[k] for k in top])[:, 0].tobytes(), None))
        kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
        return pa.table([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "home", "keys", "t", "o"])

    out = stash(words.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(tidy_groups(spell), SPELT), "spelling")
    discard(steps, logs)
    return out


PACKED = "part long, keys binary, ratios binary"  # sorted keys of 64 bits, ratios of 32


def learn(texts: DataFrame, chars: int) -> Model:
    """The stored model from (toxic, text), without weights; `chars`, the characters of the corpus, set the number of buckets.

    A word's ratio is that of its spelling, a pair's is what it says beyond its word: the shared probability of the pair, with the
    word's own ratio, is what its class counts are smoothed with.
    """
    spark = texts.sparkSession
    buckets = min(1 + chars // (LETTERS * ROOM), 1 << 16)
    grams = stash(counted(texts, buckets), "grams")
    told = spelling(grams.filter("part < 0"), buckets)
    pairs = grams.filter("part >= 0")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = np.unique(_opened([x], np.uint64))
                rows = [(home, part, w[at].tobytes()) for home, at in _by(_bucket(w, buckets))]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["home", "part", "w"])

    def answer(words: pa.Table, asked: pa.Table) -> pa.Table:
        keys, at = _unpacked(words["keys"], words["t"])
        log_p = at, _unpacked(words["keys"], words["o"])[1]
        out = [[x[_found(keys, np.frombuffer(w.as_py(), np.uint64))[1]].tobytes() for w in asked["w"]] for x in log_p]
        return pa.table({"part": asked["part"], "w": asked["w"], "t": pa.array(out[0], pa.binary()), "o": pa.array(out[1], pa.binary())})

    def finish(pairs: pa.Table, words: pa.Table) -> pa.Table:
        h, w = _opened(pairs["h"], np.uint64), _opened(pairs["w"], np.uint64)
        n = {c: _opened(pairs[c], np.int64).astype(np.float64) for c in "to"}
        keys, _ = _unpacked(words["w"], words["t"])
        at = np.searchsorted(keys, w)
        p = {c: np.maximum(np.exp(_unpacked(words["w"], words[c])[1][at]), 1e-300) for c in "to"}
        head = np.unique(h, return_inverse=True)[1]
        kinds = np.bincount(head)[head]
        total = {c: np.bincount(head, n[c])[head] for c in "to"}
        both = (p["t"] + p["o"]) / 2
        shared = (n["t"] + n["o"] - DISCOUNT + DISCOUNT * kinds * both) / (total["t"] + total["o"])
        log_p = {}
        for c in "to":
            taken = DISCOUNT * np.bincount(head, n[c] > 0)[head] + SHARED
            log_p[c] = np.log((np.maximum(n[c] - DISCOUNT, 0.0) + taken * (shared * p[c] / both)) / (total[c] + SHARED)) - np.log(p[c])
        return pa.table({"part": pairs["part"], "keys": pa.array([pair_keys(h, w).tobytes()], pa.binary()), "ratios": pa.array([(log_p["t"] - log_p["o"]).astype(np.float32).tobytes()], pa.binary())})

    parts = []
    for k in range(LESSONS):
        own = pairs.filter(F.pmod("part", F.lit(LESSONS)) == k)
        asked = own.select("part", "w").mapInArrow(tidy(ask), "home long, part long, w binary")
        words = told.filter("home IS NOT NULL").groupBy("home").cogroup(asked.groupBy("home")).applyInArrow(tidy_groups(answer), "part long, w binary, t binary, o binary")
        parts.append(stash(own.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(tidy_groups(finish), PACKED), "pairs"))
    common = told.filter("part IS NULL AND home IS NULL").select("keys", "t").collect()  # arrays of COMMON words in all, about
    letters = stash(told.filter("part IS NOT NULL").select("part", "keys", F.col("t").alias("ratios")), "spelt")
    discard(grams, told)
    keys, ratios = (np.concatenate([np.zeros(0, k), *(np.frombuffer(r[c], k) for r in common)]) for c, k in (("keys", np.uint64), ("t", np.float64)))
    o = np.argsort(keys)
    return Model(letters, reduce(DataFrame.unionByName, parts), buckets, spark.sparkContext.broadcast((keys[o], ratios[o])))


def _logistic_of(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))


def _high(ratios: np.ndarray) -> np.ndarray:
    """How far likelihood ratios exceed one, where they do."""
    return np.expm1(np.clip(ratios, 0.0, HIGHEST))


def _features(size: np.ndarray, mean: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By a text's number of words and its two sums: the mean ratio, the logarithm of the mean likelihood ratio (one at least)."""
    return mean / np.maximum(1, size), np.log1p(high / np.maximum(1, size))


ASKED = "part long, chunk long, kind int, said binary, places binary, runs binary"
TOLD = "chunk long, part long, places binary, mean binary, high binary"


@dataclass(frozen=True)
class Model:
    letters: DataFrame  # PACKED, of prefixes; parts below 0
    pairs: DataFrame  # PACKED, of pairs; parts from 0
    buckets: int
    common: object  # broadcast hashes and ratios of the commonest words
    weights: tuple[float, ...] = (-5.0, 0.0, 0.0)

    def measured(self, rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
        """rid, mean, tail of rows (rid, text): the features of each text."""
        common, buckets = self.common, self.buckets

        def asked(rids: list[int], texts: list[str | None]) -> Iterator[tuple]:
            """What a chunk asks the buckets for: pairs (kind 0: keys) and words (kind 1), with the places of the rows that hold each, one
            behind the other, and where the next begins. What it knows itself: row numbers, sizes, sums of common words (kind 2)."""
            n, chunk = len(rids), rids[0]
            words, keys = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]], [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]]
            rest, home, spelt = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
            for found in words_of(texts):
                place, pairs = found.text.astype(np.uint16), found.pairs()
                words[0].append(found.hash)
                words[1].append(place)
                keys[0].append(pair_keys(found.hash[pairs], found.hash[pairs + 1]))
                keys[1].append(place[pairs])
                at = _places(found.hash)
                at = at[~_found(common.value[0], found.hash[at])[0]]
                rest.append(found.hash[at])
                home.append(found.buckets(at, buckets))
                spelt += found.spelt(at)
            h, place = (np.concatenate(x) for x in words)
            size = np.bincount(place, minlength=n)
            o = np.argsort(h)
            h, place = h[o], place[o]
            first = _firsts(h)
            count = np.diff(np.append(first, len(h)))
            hit, at = _found(common.value[0], h[first])
            ratio, own = np.repeat(common.value[1][at], count[hit]), place[np.repeat(hit, count)]
            sums = np.bincount(own, ratio, n), np.bincount(own, _high(ratio), n)
            yield chunk % buckets, chunk, 2, np.array(rids, np.int64).tobytes(), size.tobytes(), np.concatenate(sums).tobytes()

            _, at = np.unique(np.concatenate(rest), return_index=True)  # the words that are not common, in the order of `first`
            first, count = first[~hit], count[~hit]
            for b, own in _by(np.concatenate(home)[at]):
                begin = np.cumsum(count[own]) - count[own]
                runs = np.zeros(count[own].sum(), bool)
                runs[begin] = True
                yield -1 - b, chunk, 1, _joined([spelt[k] for k in at[own]]), place[np.repeat(first[own] - begin, count[own]) + np.arange(len(runs))].tobytes(), np.packbits(runs).tobytes()

            h, place = (np.concatenate(x) for x in keys)
            o = np.argsort(h)
            h, place = h[o], place[o]
            runs = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
            home = _bucket(h, buckets)
            first = _firsts(home)
            for a, z in zip(first, [*first[1:], len(h)], strict=False):
                yield int(home[a]), chunk, 0, h[a:z][runs[a:z]].tobytes(), place[a:z].tobytes(), np.packbits(runs[a:z]).tobytes()

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()

            def table(rids: list[int], texts: list[str | None]) -> pa.RecordBatch:
                return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*asked(rids, texts), strict=True), kinds, strict=True)], ["part", "chunk", "kind", "said", "places", "runs"])

            rids, texts, total = [], [], 0
            for b in batches:
                for rid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if rids and (len(rids) >> CHUNK or total + len(text or "") > FULL):
                        yield table(rids, texts)
                        rids, texts, total = [], [], 0
                    rids.append(rid)
                    texts.append(text)
                    total += len(text or "")
            if rids:
                yield table(rids, texts)

        def answer(model: pa.Table, asked: pa.Table) -> pa.Table:
            """Sums of ratios by the places of the rows that hold something the bucket knows."""
            keys, ratios = _unpacked(model["keys"], model["ratios"], np.float32)
            rows = []
            for chunk, part, kind, said, places, runs in zip(*(asked[c].to_pylist() for c in ("chunk", "part", "kind", "said", "places", "runs")), strict=True):
                if kind == 2:
                    rows.append((chunk, None, said, places, runs))
                    continue
                place = np.frombuffer(places, np.uint16)
                of = np.cumsum(np.unpackbits(np.frombuffer(runs, np.uint8), count=len(place)), dtype=np.int64) - 1
                if kind:
                    words = zstandard.decompress(said).decode("utf-8", "surrogatepass").split("\n")
                    ratio = _spelt(keys, ratios[:, None], words)[:, 0]
                    own = ratio != 0
                else:
                    own, at = _found(keys, np.frombuffer(said, np.uint64))
                    ratio = np.zeros(len(own))
                    ratio[own] = ratios[at]
                met = own[of]
                place, ratio = place[met], ratio[of[met]]
                sums = np.bincount(place, ratio), np.bincount(place, _high(ratio))
                at = np.flatnonzero(np.bincount(place))
                rows.append((chunk, part, at.astype(np.uint16).tobytes(), sums[0][at].tobytes(), sums[1][at].tobytes()))
            kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
            return pa.table([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], ["chunk", "part", "places", "mean", "high"])

        def measure(told: pa.Table) -> pa.Table:
            rows = list(zip(*(told[c].to_pylist() for c in ("part", "places", "mean", "high")), strict=True))
            _, rids, size, own = next(r for r in rows if r[0] is None)
            rids, size = np.frombuffer(rids, np.int64), np.frombuffer(size, np.int64)
            sums = np.frombuffer(own).reshape(2, -1).copy()
            for _, places, *own in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):  # in one order, whichever came first
                at = np.frombuffer(places, np.uint16)
                for k, x in enumerate(own):
                    sums[k][at] += np.frombuffer(x)
            mean, tail = _features(size, *sums)
            return pa.table({"rid": rids, "mean": mean, "tail": tail})

        model = self.pairs.unionByName(self.letters)
        # Neighbouring rows, as many as a chunk has, are in one round.
        share = F.pmod(F.xxhash64(F.shiftright("rid", 40)) + F.shiftright(F.col("rid").bitwiseAND(F.lit((1 << 40) - 1)), CHUNK), F.lit(rounds))
        parts = []
        for k in range(rounds):
            own = rows.filter(share == k) if rounds > 1 else rows
            asks = own.select("rid", "text").mapInArrow(tidy(ask), ASKED)
            told = model.groupBy("part").cogroup(asks.groupBy("part")).applyInArrow(tidy_groups(answer), TOLD)
            parts.append(stash(told.groupBy("chunk").applyInArrow(tidy_group(measure), "rid long, mean double, tail double"), "measured"))
        return reduce(DataFrame.unionByName, parts)

    def weighed(self, measured: DataFrame) -> DataFrame:
        """rid, score from 0 to 1 by the features."""
        a, b, c = self.weights
        z = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), a + b * F.col("mean") + c * F.col("tail")))
        return measured.select("rid", (1 / (1 + F.exp(-z))).alias("score"))

    def fitted(self, rows: DataFrame) -> Model:
        """With weights by rows (toxic, mean, tail), FIT_ROWS at most; the same ones without rows of both classes."""
        rows = rows.select("toxic", "mean", "tail").collect()
        y = np.array([r["toxic"] for r in rows], np.float64)
        if len(set(y.tolist())) < 2:
            return self
        return replace(self, weights=tuple(_logistic(np.array([(r["mean"], r["tail"]) for r in rows]), y).tolist()))

    def scored(self, rows: DataFrame) -> DataFrame:
        """rid, score from 0 to 1 of rows (rid, text); null and empty texts get the score of no evidence."""
        return self.weighed(self.measured(rows))

    def score(self, text: Column) -> Column:
        """The same as a column, for models of SMALL rows at most: these go to the workers whole."""
        model = self.pairs.unionByName(self.letters)
        if (model.agg(F.sum(F.octet_length("keys"))).first()[0] or 0) // 8 > SMALL:
            raise ValueError("this model is too large for a column; use scored()")
        tables = []
        for rows in (self.letters.collect(), self.pairs.collect()):
            keys, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["keys"], np.uint64) for r in rows)]), return_index=True)
            tables.append((keys, np.concatenate([np.zeros(0), *(np.frombuffer(r.ratios, np.float32) for r in rows)])[at]))
        shared, weights = self.pairs.sparkSession.sparkContext.broadcast(tables), np.array(self.weights)

        @F.arrow_udf(DoubleType())
        def run(texts: pa.Array) -> pa.Array:
            (letters, steps), (keys, ratios) = shared.value
            size, sums = np.zeros(len(texts), np.int64), np.zeros((2, len(texts)))
            for found in words_of(texts.to_pylist()):
                pairs = found.pairs()
                hit, at = _found(keys, pair_keys(found.hash[pairs], found.hash[pairs + 1]))
                of = np.concatenate([found.text, found.text[pairs[hit]]])
                ratio = np.concatenate([_spelt(letters, steps[:, None], found.spelt(np.arange(len(found.text))))[:, 0], ratios[at]])
                size += np.bincount(found.text, minlength=len(size))
                sums += np.bincount(of, ratio, len(size)), np.bincount(of, _high(ratio), len(size))
            return pa.array(_logistic_of(np.stack([np.ones(len(size)), *_features(size, *sums)], 1), weights))

        return run(text)


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method with a small ridge; both classes weigh as they come."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _lessons(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str) -> tuple[Model, DataFrame]:
    """The model without weights, and (doc_id, toxic) of the rows that are to set them."""
    known = labels.filter(F.col(toxic).isNotNull() & (fold(doc_id) != 0)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(toxic).cast("int").alias("toxic"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(fold("doc_id").between(1, FOLDS - 2))
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    # Labels grow with the documents, so both sides are always shuffled.
    labelled = stash(texts.join(known.filter(fold("doc_id") < FOLDS - 1).hint("merge"), "doc_id").select("toxic", "text"), "labelled")
    model = learn(labelled, chars)
    discard(labelled)
    return model, known.filter(fold("doc_id") == FOLDS - 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Fit on the labelled rows outside fold 0.

    Null labels and labels without a document are left out; of repeated labels the largest holds, repeated documents count each
    time, null ids match nothing, null texts hold no words. Without labels of both classes all scores are below 0.5.
    """
    model, chosen = _lessons(docs, labels, doc_id, text, toxic)
    fit = stash(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "fit")
    rows = keyed(fit, toxic="toxic", text="text")
    model = model.fitted(model.measured(rows.select("rid", "text"), rounds=1).join(rows.select("rid", "toxic"), "rid"))
    discard(fit)
    return model


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """rid, score of the stored rows `docs` (see `numbered`) by the model that `train` makes of them; their features, which are
    the same for any weights, are taken once."""
    model, chosen = _lessons(docs, labels, doc_id, text, toxic)
    measured = model.measured(keyed(docs, text=text))
    ids = keyed(docs, doc_id=doc_id).join(F.broadcast(chosen), "doc_id")
    return model.fitted(measured.join(F.broadcast(ids), "rid")).weighed(measured)


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null ids have no label and are not held out."""
    docs = table(spark, sf_dir, "documents")
    ids = keyed(docs, doc_id="doc_id")
    out = ids.join(judged(docs, table(spark, sf_dir, "labels")), "rid").select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
