"""N-gram Jaccard join over prefix trees.

A text's word n-grams are hashed and put in one global order, rare ones first as a counter of fixed size sees them (any order gives
the same links; a good one only makes it cheap). Two sets that are similar enough share an n-gram among their first few, so texts
meet under those. In each such group every text is compared with one leader; texts that this joins are one from then on, and only
texts that are still apart are compared among themselves. Comparing is a walk through a prefix tree: candidates are sorted in
global order, a candidate takes over the overlap of the path it shares with the one before, and a walk ends as soon as what remains
of either set cannot make up the overlap that is still missing. Equal sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import fresh, keyed, numbered, remembers, settled, stash, table, tidy
from .components import components
from .dense import SCHEMA, blocks_of, combined

WORDS = 4
SHARE = 85  # hundredths
CELLS = 1 << 22  # of the counter that ranks n-grams
RANK_BITS = 6
KNOWN_WORDS = 300_000  # words whose hash a worker remembers
CHUNK = 128  # candidates that walk one tree
SIGNED = "rid long, n int, mark binary, prefix array<long>"
SET = "rid long, keys array<long>"
# A-Z to a-z; bytes.split() cuts at space and \x09-\x0D.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HASHES: dict[bytes, int] = {}


def ngrams(text: str | None, words: int) -> np.ndarray:
    """Hashes of the different n-grams of a text; with fewer words the whole sequence is the only one."""
    own = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not own:
        return np.empty(0, np.uint64)
    remembers("ngrams", _HASHES.clear)
    if len(_HASHES) > KNOWN_WORDS:
        _HASHES.clear()
    for w in set(own).difference(_HASHES):
        _HASHES[w] = xxh3_64_intdigest(w)
    h = np.array(list(map(_HASHES.__getitem__, own)), np.uint64)
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ out >> np.uint64(32))


def ordered(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The n-grams as numbers whose order is the global one: rank first, then hash."""
    rank = ranks[(hashes & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort(rank << np.uint64(63 - RANK_BITS) | hashes >> np.uint64(RANK_BITS + 1)).astype(np.int64)


def ngram_ranks(texts: DataFrame, words: int) -> np.ndarray:
    """Rank of each counter cell: the logarithm of how many n-grams of all texts fall in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for t in batch.column(0):
                np.add.at(cells, (ngrams(t.as_py(), words) & np.uint64(CELLS - 1)).astype(np.int64), np.uint32(1))
        yield from blocks_of(cells)

    counts = combined(texts.mapInArrow(tidy(count), SCHEMA), CELLS, "uint32")
    return np.minimum(2 * np.log2(counts + 1.0), (1 << RANK_BITS) - 1).astype(np.uint8)


def least_overlap(n, m, share: int):
    """The n-grams that sets of n and m must share: 100 * i >= share * (n + m - i)."""
    return -(-share * (n + m) // (100 + share))


def prefix_size(n: int, share: int) -> int:
    """Of two similar sets the one of size n has an n-gram of the other among its first so many."""
    return n - -(-share * n // 100) + 1


def _sign(words: int, share: int, ranks):
    schema = pa.schema([("rid", pa.int64()), ("n", pa.int32()), ("mark", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, marks, prefixes = [], [], []
            for t in batch.column(1):
                keys = ordered(ngrams(t.as_py(), words), ranks.value)
                n.append(len(keys))
                marks.append(xxh3_128_digest(keys.tobytes()))
                prefixes.append(keys[: prefix_size(len(keys), share)] if len(keys) else keys)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int32()), pa.array(marks, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))], schema=schema)

    return tidy(run)


def _sets(words: int, ranks):
    schema = pa.schema([("rid", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([ordered(ngrams(t.as_py(), words), ranks.value) for t in batch.column(1)], pa.list_(pa.int64()))], schema=schema)

    return tidy(run)


def walk(one: np.ndarray, others: list[np.ndarray], share: int) -> list[bool]:
    """Which of the others are similar to one set: a depth-first walk through the prefix tree of the others.

    The common n-grams come last in global order and make the longest shared paths, so the tree is rooted there.
    """
    out = [False] * len(others)
    turned = [x[::-1] for x in others]
    n = len(one)
    last, upto = np.empty(0, np.int64), np.zeros(1, np.int64)  # the path walked before, and its overlap after each step
    for k in sorted(range(len(others)), key=lambda k: turned[k].tobytes()):
        path = turned[k]
        need = int(least_overlap(n, len(path), share))
        shared = min(len(last), len(path))
        same = last[:shared] == path[:shared]
        shared = shared if same.all() else int(same.argmin())
        walked, overlap, done = [upto[: shared + 1]], int(upto[shared]), shared
        while done < len(path) and overlap + len(path) - done >= need:
            step = path[done : done + max(32, len(path) // 8)]
            at = np.searchsorted(one, step)
            hit = one[np.minimum(at, n - 1)] == step
            more = overlap + np.cumsum(hit)
            walked.append(more)
            overlap, done = int(more[-1]), done + len(step)
            if overlap + int(at[-1]) < need:  # what remains of the one set
                break
        out[k] = done == len(path) and overlap >= need
        last, upto = path[:done], np.concatenate(walked)
    return out


def _verify(share: int):
    """Links among rows (a, part, rid, lead, keys) that come sorted with each part's leader first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b"]
        now, one, ids, sets = None, None, [], []

        def close() -> pa.RecordBatch | None:
            hit = [b for b, ok in zip(ids, walk(one, sets, share), strict=True) if ok] if ids else []
            ids.clear()
            sets.clear()
            return pa.record_batch([pa.array([now[0]] * len(hit), pa.int64()), pa.array(hit, pa.int64())], names=names) if hit else None

        for batch in batches:
            col = [batch.column(k) for k in range(3)]
            for k, (a, part, rid) in enumerate(zip(*(c.to_pylist() for c in col), strict=True)):
                keys = batch.column(4)[k].values.to_numpy()
                if (a, part) != now or len(ids) >= CHUNK:
                    if ids and (out := close()):
                        yield out
                    if (a, part) != now:
                        now, one = (a, part), keys
                        continue
                ids.append(rid)
                sets.append(np.array(keys))
        if ids and (out := close()):
            yield out

    return tidy(run)


def verified(pairs: DataFrame, texts: DataFrame, words: int, share: int, ranks) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. Only the texts in a pair are read again; a leader of many goes to many tasks."""
    wanted = pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct()
    sets = stash(texts.join(wanted.hint("merge"), "rid", "left_semi").select("rid", "text").mapInArrow(_sets(words, ranks), SET), "sets")
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    members = pairs.join(degree, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("rid"), F.lit(0).alias("lead"))
    leaders = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("rid"), F.lit(1).alias("lead"))
    rows = members.unionByName(leaders).join(sets, "rid").select("a", "part", "rid", "lead", "keys")
    spread = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("lead"), "rid")
    return spread.mapInArrow(_verify(share), "a long, b long")


def _possible(n: Column, i: Column, m: Column, j: Column, share: int) -> Column:
    """Whether sets of n and m that share the n-grams at places i and j, and none before, can be similar."""
    need = F.ceil((n + m) * share / (100.0 + share) - 1e-9)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * share) & (F.least(n - i, m - j) >= need)


def join(rows: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """rid, n_ngrams, class, component from rows (rid, text); class is the least rid with the same n-grams, component the least linked.

    Texts without words are linked with nothing, not even with each other.
    """
    spark = rows.sparkSession
    ranks = spark.sparkContext.broadcast(ngram_ranks(rows.select("text"), words))
    signed = stash(rows.select("rid", "text").mapInArrow(_sign(words, share, ranks), SIGNED), "signed")
    classes = stash(signed.filter("n > 0").groupBy("mark", "n").agg(F.min("rid").alias("class")), "classes")

    own = signed.join(classes.select(F.col("class").alias("rid")).hint("merge"), "rid", "left_semi").select("rid", "n", F.posexplode("prefix").alias("i", "key"))
    leads = own.groupBy("key").agg(F.min(F.struct("i", "n", "rid")).alias("lead"), F.count("*").alias("held")).filter("held > 1")
    met = stash(own.join(leads.select("key", "lead").hint("merge"), "key").select("key", "rid", "n", "i", "lead"), "met")
    star = met.filter(F.col("rid") != F.col("lead.rid")).filter(_possible(F.col("n"), F.col("i"), F.col("lead.n"), F.col("lead.i"), share))
    first = stash(verified(stash(star.select(F.col("lead.rid").alias("a"), F.col("rid").alias("b")).distinct(), "stars"), rows, words, share, ranks), "links")

    joined = components(first)
    now = met.join(joined.select(F.col("node").alias("rid"), "component"), "rid", "left").select("key", "rid", "n", "i", F.col("lead.rid").alias("lead"), F.coalesce("component", "rid").alias("component"))
    apart = now.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select("key")
    rest = stash(now.join(apart.hint("merge"), "key").filter("rid <> lead"), "apart")
    x, y = (rest.select("key", *(F.col(c).alias(f"{s}_{c}") for c in ("rid", "n", "i", "component"))) for s in "xy")
    # The smaller of two similar sets has the shared n-gram in a shorter prefix; it stands on the left.
    x = x.filter(F.col("x_n") - F.col("x_i") >= F.ceil(F.col("x_n") * (2 * share) / (100.0 + share) - 1e-9))
    before = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_rid") < F.col("y_rid")))
    pairs = x.join(y, "key").filter("x_component <> y_component").filter(before).filter(_possible(F.col("x_n"), F.col("x_i"), F.col("y_n"), F.col("y_i"), share))
    pairs = stash(pairs.select(F.col("x_rid").alias("a"), F.col("y_rid").alias("b")).distinct(), "pairs")
    second = verified(pairs, rows, words, share, ranks)
    final = components(first.unionByName(second))

    named = signed.join(classes, ["mark", "n"], "left").select("rid", F.col("n").alias("n_ngrams"), F.coalesce("class", "rid").alias("class"))
    return named.join(final.withColumnRenamed("node", "class"), "class", "left").select("rid", "n_ngrams", "class", F.coalesce("component", "class").alias("component"))


def near_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, share: int = SHARE) -> DataFrame:
    """rid, doc_id, n_shingles, component_id for each row of a stored table.

    component_id is the least id that is linked, directly or not; null ids are passed over where the component has others. Null
    and empty texts have no n-grams and no links. Repeated rows are linked like any copies; an empty table gives none; other
    columns are left out. Texts of any length are used whole.
    """
    own = keyed(docs, doc_id=doc_id, text=text)
    linked = stash(join(own, words, share), "joined")
    named = stash(linked.join(own.select("rid", "doc_id"), "rid"), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first"))
    return named.join(least, "component").select("rid", "doc_id", F.col("n_ngrams").cast("long").alias("n_shingles"), "component_id", (F.col("rid") == F.col("first.rid")).alias("first"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, share: int = 80) -> DataFrame:
    """The rows of a stored table but those linked with a row of lesser id (ties: an earlier row); all columns kept."""
    docs, rid = settled(docs), fresh(docs, "_rid")
    gone = near_texts(docs, doc_id, text, words, share).filter("NOT first").select(F.col("rid").alias(rid))
    return numbered(docs, rid).join(gone, rid, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
  s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[i : i + 3] END AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0) q),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  l AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
  part(doc_id, least) USING KEY (doc_id) AS (SELECT doc_id, doc_id FROM documents
    UNION SELECT l.y, min(q.least) FROM part q JOIN l ON l.x = q.doc_id LEFT JOIN recurring.part r ON r.doc_id = l.y WHERE q.least < r.least GROUP BY l.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, part.least AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN part ON part.doc_id = d.doc_id
"""
