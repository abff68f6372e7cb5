"""Alignment of two tokenizers over the same texts: groups between common ends, linked token pairs and how many documents hold them.

Texts are worked on as Arrow arrays. Tokens are lists that are flattened, with parent indices that say whose they are; cumulative sums
of token lengths, begun anew with each text, give byte ends; a hash join of both tokenizers on (text, end) gives the common ends;
every stretch between neighbouring ends lies in one token of each side and is a link. `Table.group_by` counts links per document and
pair. A chunk is a number of whole documents: one row with their figures and links (as numbers of pairs in the chunk's sorted pair
list, packed), and one row per pair of the chunk with the number of documents. Spark adds up the pair rows of all chunks and sends each
chunk the counts of its own pairs, so that what is shuffled are pairs per chunk, not links. A pair has one row a chunk at most, so no
key is hot.

Long texts are worked on in segments that both tokenizers cut anyway: before a space that follows another character and precedes a
printable ASCII one. Only a stretch without such a place is held whole.

Defined results: null and empty texts and texts that either tokenizer does not give back byte by byte (such as those holding U+2581)
have no tokens: zeros and an empty digest. Null and repeated ids are rows of their own; other columns are left out, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table
from .tokens import WordEncoder, default_vocabulary

SEGMENT = 1 << 20  # bytes of a long text at once
SLICE = 1 << 21  # bytes of texts at once
CHUNK = 1 << 22  # (document, pair) entries of a chunk, unless one document has more
WORDS = 400_000  # words whose pieces a worker remembers
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
LONGS = pa.list_(pa.int64())
PARTS = pa.schema([
    ("chunk", pa.int64()), ("pair", pa.int64()), ("docs", pa.int64()), ("doc_id", LONGS), ("n_a", LONGS), ("n_b", LONGS), ("n_groups", LONGS),
    ("n_links", LONGS), ("groups_sha256", pa.list_(pa.string())), ("entries", LONGS), ("gaps", pa.binary()), ("times", pa.binary()),
])
PARTS_SQL = "chunk long, pair long, docs long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, entries array<long>, gaps binary, times binary"
ROWS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
ROWS_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class ByteSide:
    """Ids of segments by a byte-level tokenizer, and the bytes of its tokens."""

    def __init__(self, path: str):
        self.words = WordEncoder(path)
        back = {c: b for b, c in self.words.letters.items()}
        vocabulary = self.words.tokenizer.get_vocab()
        held = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in back for c in token):
                held[i] = bytes(back[c] for c in token)
        self.bytes = pa.array(held, pa.large_binary())

    def encode(self, segments: list[str]) -> pa.ListArray:
        ids, counts = self.words.encode(segments)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids.astype(np.int32)))


class PieceSide:
    """Ids of segments by a sentencepiece model whose pieces hold spaces at their beginning only.

    No merge crosses the place before a space that follows another character, so words between such places are encoded on their own.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path} has pieces that go on behind a space")
        raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = pa.array(raw, pa.large_binary())
        self.blank = self.model.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.sizes: list[int] = []

    def _lists(self) -> pa.ListArray:
        """Ids of all words known."""
        self.ids = [np.concatenate([np.empty(0, np.int32), *self.ids])]
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(self.sizes)), pa.int32()), pa.array(self.ids[0]))

    def encode(self, data: bytes, heads: np.ndarray) -> pa.ListArray:
        """Each segment of `data` begins at its head, with a space."""
        letters = np.frombuffer(data, np.uint8)
        first = letters == 32
        first[1:] &= letters[:-1] != 32
        first[heads[:-1]] = True
        begins = np.flatnonzero(first)
        cuts = pa.array(np.append(begins, len(data)), pa.int64())
        coded = pa.LargeStringArray.from_buffers(len(begins), cuts.buffers()[1], pa.py_buffer(data)).dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) > WORDS:
            self.forget()
        new = [w for w in names if w not in self.known]
        # A text of no characters gets no dummy space, so a lone space is looked up.
        for word, ids in zip(new, self.model.encode([w[1:] for w in new], num_threads=1), strict=True):
            ids = ids if len(word) > 1 else [self.blank]
            self.known[word] = len(self.sizes)
            self.sizes.append(len(ids))
            self.ids.append(np.array(ids, np.int32))
        place = np.array([self.known[w] for w in names], np.int64)[coded.indices.to_numpy()]
        picked = self._lists().take(pa.array(place))
        upto = np.append(0, np.cumsum(np.array(self.sizes, np.int64)[place]))
        return pa.ListArray.from_arrays(pa.array(upto[np.searchsorted(begins, heads)], pa.int32()), pc.list_flatten(picked).cast(pa.int32()))


class Tokens:
    """Tokens of one side over the segments of a slice: flat ids, parent segments and byte ends."""

    def __init__(self, lists: pa.ListArray, held: pa.LargeBinaryArray):
        self.id = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
        self.parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        self.count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.joined = pc.take(held, pa.array(self.id))
        sums = np.append(0, pc.cumulative_sum(pc.binary_length(self.joined)).to_numpy(zero_copy_only=False))
        self.sums, self.cuts = sums, sums[np.append(0, np.cumsum(self.count))]

    def same(self, data: bytes, heads: np.ndarray) -> np.ndarray:
        """Which segments these tokens give back byte by byte."""
        raw = memoryview(self.joined.buffers()[2] or b"").cast("B")[: self.cuts[-1]]
        if len(raw) == len(data) and np.array_equal(self.cuts, heads) and raw == data:
            return np.ones(len(heads) - 1, bool)
        whole = memoryview(data)
        return np.array([raw[a:b] == whole[c:d] for a, b, c, d in zip(self.cuts, self.cuts[1:], heads, heads[1:], strict=False)], bool)

    def keep(self, good: np.ndarray, heads: np.ndarray) -> None:
        """Only tokens of good segments, with their ends as places in the slice."""
        own = good[self.parent]
        self.end = (self.sums[1:] - self.cuts[:-1][self.parent] + heads[:-1][self.parent])[own]
        self.id, self.parent, self.count = self.id[own].astype(np.int64), self.parent[own], np.where(good, self.count, 0)


class Aligner:
    """The two tokenizers of a worker."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        self.n_b = len(self.b.bytes)
        behind_a = [f"{i}{c}".encode() for i in range(len(self.a.bytes)) for c in ",|"]
        behind_b = [f"{i}{c}".encode() for i in range(self.n_b) for c in (",", ";", "")]
        self.names = pa.array(behind_a + behind_b, pa.large_binary())

    def align(self, segments: list[str], owner: np.ndarray) -> dict:
        """Segments in order with the documents they belong to: figures, group texts and counted pairs."""
        raw = [s.encode() for s in segments]
        data, heads = b"".join(raw), np.append(0, np.cumsum([len(r) for r in raw]))
        a, b = Tokens(self.a.encode(segments), self.a.bytes), Tokens(self.b.encode(data, heads), self.b.bytes)
        good = a.same(data, heads) & b.same(data, heads)
        a.keep(good, heads)
        b.keep(good, heads)
        left = pa.table({"text": a.parent, "end": a.end, "i": np.arange(len(a.id))})
        right = pa.table({"text": b.parent, "end": b.end, "j": np.arange(len(b.id))})
        common = left.join(right, ["text", "end"], join_type="inner", use_threads=False)
        i, j = np.sort(common["i"].to_numpy()), np.sort(common["j"].to_numpy())
        groups = np.bincount(a.parent[i], minlength=len(raw))
        edge = np.zeros(len(data) + 1, np.uint8)
        edge[a.end] = 1
        edge[b.end] += 2
        at = edge[np.flatnonzero(edge)]
        in_a, in_b = at & 1, at >> 1
        ia, ib = np.cumsum(in_a, dtype=np.int64) - in_a, np.cumsum(in_b, dtype=np.int64) - in_b
        links = pa.table({"doc": owner[a.parent[ia]], "pair": a.id[ia] * self.n_b + b.id[ib]})
        counted = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        figures = {"n_a": a.count, "n_b": b.count, "n_groups": groups, "n_links": a.count + b.count - groups}
        return {"good": good, "figures": figures, "texts": self._groups(a, b, i, j), "doc": counted["doc"].to_numpy(), "pair": counted["pair"].to_numpy(), "n": counted["count_all"].to_numpy()}

    def _groups(self, a: Tokens, b: Tokens, i: np.ndarray, j: np.ndarray) -> list[memoryview]:
        """`a1,a2|b1;a3|b2,b3` of each segment; i, j: last tokens of the groups."""
        last_a, last_b = np.zeros(len(a.id), np.int64), np.zeros(len(b.id), np.int64)
        last_a[i] = 1
        last_b[j] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        last_b[np.cumsum(b.count)[b.count > 0] - 1] = 2
        codes = np.empty(len(a.id) + len(b.id), np.int64)
        codes[np.arange(len(a.id)) + np.append(0, j + 1)[group_a]] = 2 * a.id + last_a
        codes[np.arange(len(b.id)) + (i + 1)[group_b]] = 2 * len(self.a.bytes) + 3 * b.id + last_b
        written = pc.take(self.names, pa.array(codes))
        cuts = np.frombuffer(written.buffers()[1], np.int64)[written.offset :][np.append(0, np.cumsum(a.count + b.count))]
        whole = memoryview(written.buffers()[2] or b"")
        return [whole[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]


def segments(text: str) -> Iterator[str]:
    """A space and the text, in pieces that both tokenizers cut there anyway."""
    text, at = " " + text, 0
    while len(text) - at > SEGMENT:
        cut = at + SEGMENT // 2
        while 0 <= cut < len(text) and not (text[cut] == " " and text[cut - 1] != " " and "!" <= text[cut + 1 : cut + 2] <= "~"):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Chunk:
    """Documents gathered by one task until they hold `CHUNK` entries."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.figures = {f: [] for f in FIGURES}
        self.digests: list = []
        self.bad: set[int] = set()
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def open(self, doc_id: int | None) -> int:
        self.ids.append(doc_id)
        self.digests.append(None)
        for f in FIGURES:
            self.figures[f].append(0)
        return len(self.ids) - 1

    def add(self, owner: np.ndarray, done: dict) -> None:
        for s, doc in enumerate(owner.tolist()):
            if not done["good"][s]:
                self.bad.add(doc)
                continue
            for f in FIGURES:
                self.figures[f][doc] += int(done["figures"][f][s])
            if self.digests[doc] is None:
                self.digests[doc] = hashlib.sha256()
            else:
                self.digests[doc].update(b";")
            self.digests[doc].update(done["texts"][s])
        self.keys.append(done["doc"].astype(np.int64) << 32 | done["pair"])
        self.times.append(done["n"].astype(np.uint32))
        self.size += len(self.keys[-1])

    def close(self, chunk: int) -> Iterator[pa.RecordBatch]:
        """The row of the documents, then the rows of their pairs in ascending order."""
        key, times = np.concatenate([np.empty(0, np.int64), *self.keys]), np.concatenate([np.empty(0, np.uint32), *self.times])
        self.keys, self.times = [], []
        if self.bad:
            good = ~np.isin(key >> 32, list(self.bad))
            key, times = key[good], times[good]
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        if len(first) < len(key):  # a document of several slices
            key, times = key[first], np.add.reduceat(times, first)
        doc, pair = key >> 32, key & 0xFFFFFFFF
        pairs, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
        gaps = np.diff(place, prepend=0)
        new = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.empty(0, bool)
        gaps[new] = place[new]
        row = {f: [0 if d in self.bad else v for d, v in enumerate(self.figures[f])] for f in FIGURES}
        row["groups_sha256"] = ["" if d in self.bad or h is None else h.hexdigest() for d, h in enumerate(self.digests)]
        row |= {"chunk": chunk, "doc_id": self.ids, "entries": np.bincount(doc, minlength=len(self.ids)).tolist(), "gaps": pack(gaps), "times": pack(times)}
        yield pa.RecordBatch.from_pylist([row], PARTS)
        for at in range(0, len(pairs), 1 << 18):
            some = slice(at, at + (1 << 18))
            own = {"chunk": np.full(len(pairs[some]), chunk), "pair": pairs[some], "docs": docs[some]}
            yield pa.record_batch([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(len(pairs[some]), f.type) for f in PARTS], schema=PARTS)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The tokenizers of this Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def gather(batches: Iterator[pa.RecordBatch], part: int, own: Aligner) -> Iterator[pa.RecordBatch]:
    """Chunks of the documents of one task."""
    chunk, n_chunks = Chunk(), 0
    held: list[str] = []
    owner: list[int] = []
    size = 0

    def work() -> None:
        nonlocal size
        if held:
            chunk.add(np.array(owner), own.align(held, np.array(owner)))
            held.clear()
            owner.clear()
            size = 0

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if chunk.size >= CHUNK:
                work()
                yield from chunk.close(part << 32 | n_chunks)
                chunk, n_chunks = Chunk(), n_chunks + 1
            doc = chunk.open(doc_id)
            for segment in segments(text) if text else ():
                if size + len(segment) > SLICE:
                    work()
                held.append(segment)
                owner.append(doc)
                size += len(segment)
    work()
    if chunk.ids:
        yield from chunk.close(part << 32 | n_chunks)


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def chunks(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunk rows (pair is null) and pair rows of all texts, to be stored before they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        return gather(batches, TaskContext.get().partitionId(), aligner(a_path, b_path))

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, PARTS_SQL)


def pair_counts(parts: DataFrame, n_b: int) -> DataFrame:
    """(pair, a_id, b_id, docs): documents that hold each pair linked; `n_b`: ids of the second tokenizer."""
    counts = parts.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("docs"))
    return counts.select("pair", F.expr(f"pair DIV {n_b}").alias("a_id"), (F.col("pair") % n_b).alias("b_id"), "docs")


def _summed(counts: pa.Table, rows: pa.Table) -> pa.Table:
    """A chunk's documents with what the counts of their links add up to."""
    counts = counts.sort_by("pair")
    docs, best = counts["docs"].to_numpy(), counts["best"].to_numpy()
    row = rows.to_pylist()[0]
    entries = np.array(row["entries"], np.int64)
    gaps, times = unpack(row["gaps"]), unpack(row["times"])
    # Numbers of pairs begin anew with each document.
    sums = np.append(0, np.cumsum(gaps))
    begins = np.cumsum(entries) - entries
    place = sums[1:] - np.repeat(sums[begins], entries)
    total = lambda values: np.diff(np.append(0, np.cumsum(values))[np.append(begins, len(times))])
    out = {f: row[f] for f in ("doc_id", *FIGURES, "groups_sha256")}
    return pa.table(out | {"n_best": total(times * best[place]), "count_sum": total(times * docs[place])}).select(ROWS.names).cast(ROWS)


def summaries(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """A row per document: numbers of tokens, groups and links, links whose pair is the commonest of its first id, and the sum of counts."""
    most = counts.groupBy("a_id").agg(F.max("docs").alias("most"))
    ranked = counts.join(most, "a_id").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    own = parts.filter("pair IS NOT NULL").select(F.col("chunk").alias("of"), "pair").join(ranked, "pair")
    rows = parts.filter("pair IS NULL").drop("pair", "docs")
    return own.groupBy("of").cogroup(rows.groupBy("chunk")).applyInArrow(_summed, ROWS_SQL)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Summaries of all documents by the byte-level tokenizer `a_path` and the sentencepiece model `b_path`."""
    import sentencepiece

    a_path, b_path = a_path or default_vocabulary(), b_path or piece_vocabulary()
    parts = stash(chunks(docs, a_path, b_path), "aligned")
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    counts = stash(pair_counts(parts, n_b), "pairs")
    return summaries(parts, counts)


def op13_arrow_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
