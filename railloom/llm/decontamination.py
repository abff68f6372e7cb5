"""Benchmark decontamination by pigeonhole edit matching.

An item within k edits of some passage must hold, among k + 1 pieces, one that stands in the passage unchanged. All pieces of a
block of items form one automaton; it finds every exact piece hit of a text in one pass, and each hit's surroundings are verified
with Myers' bit-parallel edit distance. Texts and items are compared in lower case with white space folded to single spaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import fresh, stash, table

ERRORS = 0.05  # edits allowed per character of an item
LEAST_ERRORS = 1
BLOCK_CHARS = 1 << 22  # characters of the items of one automaton: what is sent to the workers is never more
HITS = ArrayType(StructType([StructField("item_id", LongType()), StructField("distance", IntegerType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, errors: float = ERRORS) -> int:
    return max(LEAST_ERRORS, int(len(item) * errors))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces (offset, text) that cover the item, as equal as they can be."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def nearest(masks: dict[str, int], m: int, text: str, k: int) -> tuple[int, int]:
    """Least edit distance of a pattern of length m to any part of the text, and where that part ends (the first such end).

    Myers' bit vectors in one whole number each; k + 1 when no part is within k.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = k + 1, -1
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        plus = (down << 1 | ~(xv | up)) & full
        minus = up & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """A block of items ready for matching; made once per worker."""

    def __init__(self, items: list[tuple[int, str]], errors: float):
        self.items = []
        starts: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            own = folded(text)
            if not own:
                continue
            k = budget(own, errors)
            self.items.append((item_id, own, k))
            for at, piece in pieces(own, k):
                starts.setdefault(piece, []).append((len(self.items) - 1, at))
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, owners in starts.items():
            self.automaton.add_word(piece, (len(piece), tuple(owners)))
        if starts:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[dict]:
        """Items within their budget of some part of the text: least distance and that part's place in the folded text."""
        if not self.items:
            return []
        text = folded(text)
        around: dict[int, list[tuple[int, int]]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for i, at in owners:
                k = self.items[i][2]
                begin = last + 1 - size - at
                around.setdefault(i, []).append((max(0, begin - k), min(len(text), begin + len(self.items[i][1]) + k)))
        found = []
        for i, windows in around.items():
            item_id, item, k = self.items[i]
            best = (k + 1, 0, 0)
            for a, b in _joined(windows):
                if i not in self.masks:
                    self.masks[i] = letter_masks(item)
                d, end = nearest(self.masks[i], len(item), text[a:b], k)
                if d <= k and d < best[0]:
                    back, start = nearest(letter_masks(item[::-1]), len(item), text[a : a + end][::-1][: len(item) + k], k)
                    best = (d, a + end - start if back <= k else a, a + end)
            if best[0] <= k:
                found.append({"item_id": item_id, "distance": best[0], "start": best[1], "end": best[2]})
        return sorted(found, key=lambda x: (x["item_id"] is not None, x["item_id"] or 0))


def _joined(windows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Windows in order, those that overlap as one."""
    a, b = None, None
    for x, y in sorted(set(windows)):
        if a is None:
            a, b = x, y
        elif x <= b:
            b = max(b, y)
        else:
            yield a, b
            a, b = x, y
    if a is not None:
        yield a, b


_READY: list = []


def matches(text: Column, items: object, errors: float) -> Column:
    """Column of the items (a broadcast list) that each text holds."""

    @F.arrow_udf(HITS)
    def run(texts: pa.Array) -> pa.Array:
        if not _READY or _READY[0] is not items.value or _READY[1] != errors:
            _READY[:] = [items.value, errors, Items(items.value, errors)]
        find = _READY[2].find
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([find(t.as_py() or "") for t in texts], kind)

    return run(text)


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of a bounded number of characters, read one after the other.

    Items without an id stay, but for those whose text an item with an id has, too.
    """
    block, size = [], 0
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL")
    named = items.filter("i IS NOT NULL")
    nameless = items.filter("i IS NULL").dropDuplicates(["t"]).join(named.select("t"), "t", "left_anti").select("i", "t")
    for r in named.unionByName(nameless).orderBy("i", "t").toLocalIterator():
        if block and size + len(r["t"]) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += len(r["t"])
    yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", errors: float = ERRORS) -> DataFrame:
    """doc_id, item_id, distance, start, end: each row's matches, places counted in the folded text. Nothing is shuffled.

    Null and empty texts and items match nothing; repeated rows give repeated matches, repeated items one match each; ties between
    places go to the first end. Rows and items with a null id keep it. An empty table on either side gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    out = None
    for block in item_blocks(benchmark):
        hits = matches(F.col(f"`{text}`"), spark.sparkContext.broadcast(block), errors)
        found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode(hits).alias("h")).select("doc_id", "h.*")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", errors: float = ERRORS) -> DataFrame:
    """The rows of `docs` that hold no item, all columns kept."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark):
        n = fresh(docs, "n_items")
        counted = docs.withColumn(n, F.size(matches(F.col(f"`{text}`"), spark.sparkContext.broadcast(block), errors)))
        docs = counted.filter(F.col(n) == 0).drop(n)
    return docs


def op8_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item it holds."""
    return stash(contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")), "matches")
