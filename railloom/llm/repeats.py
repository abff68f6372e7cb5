"""Removal of repeated passages by merged Burrows-Wheeler transforms.

Every byte covered by a string of `LENGTH` bytes that also starts earlier goes. Each such string is filed under its least k-gram:
neighbouring strings with the same one make a stretch, equal strings fall under equal k-grams, and k-grams that occur once drop out.
Equal stretches are one from then on. What is left is cut into pieces whose common core names the group they are compared in.

In a group's task the pieces are dealt to shards. Each shard has its own Burrows-Wheeler transform; the transforms are merged by
refining an interleave of the shards: a round passes the interleave once through the symbols before each suffix, which orders it one
symbol deeper, and the round in which two neighbours part is the length of their common prefix (Holt and McMillan, 2014). A symbol
is `STEP` bytes, so LENGTH / STEP rounds leave just the repeated intervals; no suffix is sorted again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import discard, keyed, stash, table

LENGTH = 100  # bytes of a string
GRAM = 32  # bytes of a k-gram
BIN = 32  # strings of a piece
STEP = 20  # bytes of a symbol
SPAN = 1 << 16  # bytes worked on at once, so few that their arrays stay in a core's cache
SHARD = 1 << 14  # bytes of a shard
BATCH = 1 << 16  # bytes of pieces merged at once
CROWD = 4096  # pieces of a group in one task; in larger groups each string is counted on its own
GRAMS_OF_STRING = LENGTH - GRAM + 1
STRETCH = "rid long, doc_id long, key long, mark binary, start long, size int, anchor int, body binary"
PIECE = "core long, body binary, doc_id long, rid long, at long, mark binary, key long, offset int"
REPEAT = "key long, mark binary, low int, high int"
_LETTERS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the k-gram at each place, by doubling its length."""
    h, size = _LETTERS[b], 1
    while size < GRAM:
        h = (h[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size)) + (h[size:] ^ (h[size:] >> np.uint64(31)))
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours."""
    m, size = h, 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(h) - width + 1], m[width - size :][: len(h) - width + 1])


def stretches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, start, strings, key, anchor) arrays: runs of strings with the same least k-gram. Texts are taken whole, a few at a time."""
    held: list[tuple[int, int, bytes]] = []
    total = 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - LENGTH + 1), SPAN):
            part = t[a : a + SPAN + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if held and total + len(part) > SPAN:
                yield _stretches(held)
                held, total = [], 0
            held.append((i, a, part))
            total += len(part)
    if held:
        yield _stretches(held)


def _stretches(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    sizes = np.array([len(p) for _, _, p in held])
    begin = np.cumsum(sizes) - sizes
    h = _gram_hashes(b)
    place = np.uint64((1 << 22) - 1)  # low bits name the place, so that of equal k-grams the first counts
    where = (_least((h & ~place) | np.arange(len(h), dtype=np.uint64), GRAMS_OF_STRING) & place).astype(np.int64)
    n = len(where)
    valid = np.zeros(n + 1, bool)
    for s, z in zip(begin, sizes, strict=True):
        valid[s : s + z - LENGTH + 1] = True
    first = np.zeros(n, bool)
    first[0] = True
    first[1:] = where[1:] != where[:-1]
    first[begin[begin < n]] = True
    first &= valid[:n]
    at = np.flatnonzero(first)
    stop = np.flatnonzero(valid[:n] & ~valid[1:]) + 1
    end = np.minimum(np.append(at[1:], n), stop[np.searchsorted(stop, at, side="right")])
    part = np.searchsorted(begin, at, side="right") - 1
    texts, offsets = np.array([i for i, _, _ in held]), np.array([a for _, a, _ in held])
    return texts[part], at - begin[part] + offsets[part], end - at, h[where[at]].view(np.int64), where[at] - at


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in column]


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rid, n): how many stretches of a text have a key."""
    for batch in batches:
        rids = batch.column(0).to_numpy()
        for text, _, _, key, _ in stretches(_bytes(batch.column(1))):
            o = np.argsort(key.view(np.uint64) + text.astype(np.uint64) * _LETTERS[0])  # one number for both: equal rows come together
            first = np.ones(len(o), bool)
            first[1:] = (key[o][1:] != key[o][:-1]) | (text[o][1:] != text[o][:-1])
            n = np.diff(np.append(np.flatnonzero(first), len(o))).astype(np.int32)
            yield pa.record_batch([pa.array(key[o][first]), pa.array(rids[text[o][first]]), pa.array(n)], names=["key", "rid", "n"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of rows (rid, doc_id, text, keys) whose key is among the row's repeated ones.

    A stretch that came before in the same text, as in a long run of one sign, has no body.
    """
    names = ["rid", "doc_id", "key", "mark", "start", "size", "anchor", "body"]
    for batch in batches:
        rids, doc_ids, texts = batch.column(0).to_numpy(), batch.column(1), _bytes(batch.column(2))
        keys = [k.values.to_numpy() for k in batch.column(3)]
        for text, start, strings, key, anchor in stretches(texts):
            keep = np.zeros(len(text), bool)
            cuts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            for a, z in zip(cuts, np.append(cuts[1:], len(text)), strict=True):
                keep[a:z] = np.isin(key[a:z], keys[text[a]])
            text, start, strings, key, anchor = (x[keep] for x in (text, start, strings, key, anchor))
            size = strings + LENGTH - 1
            bodies = [texts[t][a : a + z] for t, a, z in zip(text.tolist(), start.tolist(), size.tolist(), strict=True)]
            marks = [xxh3_128_digest(x) for x in bodies]
            met: set[tuple[int, bytes]] = set()
            for k, place in enumerate(zip(text.tolist(), marks, strict=True)):
                if place in met:
                    bodies[k] = None  # stands earlier in the same text
                met.add(place)
            yield pa.record_batch(
                [pa.array(rids[text]), doc_ids.take(pa.array(text)), pa.array(key), pa.array(marks, pa.binary()), pa.array(start), pa.array(size, pa.int32()), pa.array(anchor, pa.int32()), pa.array(bodies, pa.binary())],
                names=names,
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of stretches (key, mark, anchor, body, doc_id, rid, start): strings whose anchor lies in the same bin of distances."""
    names = [c.split()[0] for c in PIECE.split(", ")]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for key, mark, anchor, body, doc_id, rid, start in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
            last = len(body) - LENGTH
            for b in range(GRAMS_OF_STRING // BIN + 1):
                high = min(anchor - BIN * b, last)
                low = max(anchor - BIN * b - BIN + 1, 0)
                if low <= high:
                    at = anchor - BIN * b
                    core = xxh3_64_intdigest(body[at : at + LENGTH - BIN + 1], b) - (1 << 63)
                    for column, value in zip(out, (core, body[low : high + LENGTH], doc_id, rid, start + low, mark, key, low), strict=True):
                        column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)


def _by_symbol(symbols: np.ndarray) -> np.ndarray:
    """Stable order, by one counting pass for each 16 bits."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    top = int(symbols.max(initial=0)) >> 16
    if top:
        order = order[np.argsort((symbols[order] >> 16).astype(np.uint16 if top < 1 << 16 else np.uint32), kind="stable")]
    return order


def _ranked(pairs: np.ndarray) -> np.ndarray:
    """Place of each value among the different ones."""
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


class Suffixes:
    """All suffixes of a list of strings over symbols of STEP bytes. A suffix shorter than a symbol ends its chain, under symbol 0."""

    def __init__(self, bodies: list[bytes]):
        sizes = np.array([len(x) for x in bodies])
        self.string = np.repeat(np.arange(len(bodies)), sizes + 1)
        self.begin = np.cumsum(sizes + 1) - sizes - 1
        self.place = np.arange(len(self.string)) - self.begin[self.string]
        n, k = len(self.string), STEP // 4
        b = np.frombuffer(b"\0".join(bodies) + b"\0" * (STEP + 1), np.uint8).astype(np.int64)
        codes = np.zeros(n + STEP - k, np.int64)
        for i in range(k):
            codes = codes << 8 | b[i : i + len(codes)]
        while k < STEP:  # numbers of the different stretches of k bytes, then of twice as many
            codes = _ranked(codes)
            codes = codes[:-k] << 32 | codes[k:]
            k *= 2
        self.ends = self.place + STEP > sizes[self.string]
        self.symbol = np.where(self.ends, 0, _ranked(codes[:n]) + 1)

    def shard_order(self, low: int, high: int) -> np.ndarray:
        """Suffixes low..high, those of one shard, in order: two or three stretches that are ranked already make a longer one.

        LENGTH bytes are compared at least; suffixes that agree in them may stand in any order.
        """
        rank, size = _ranked(self.symbol[low:high]), STEP
        ends, string = self.ends[low:high], self.string[low:high]
        while size < LENGTH:
            times = 3 if 3 * size >= LENGTH else 2
            base = int(rank.max(initial=0)) + 2
            joint = rank
            for k in range(1, times):
                ahead = np.zeros(high - low, np.int64)
                there = string[k * size :] == string[: -k * size]
                ahead[: -k * size][there] = rank[k * size :][there] + 1
                joint = joint * base + ahead
            rank, size = _ranked(np.where(ends, 0, joint)), size * times
        return np.argsort(rank, kind="stable") + low


def repeated_intervals(bodies: list[bytes]) -> tuple[Suffixes, np.ndarray, np.ndarray]:
    """Suffixes, their merged order and the number of the interval each place of it lies in.

    Suffixes of LENGTH bytes at least share an interval if and only if their first LENGTH bytes are equal.
    """
    s = Suffixes(bodies)
    cuts = [0]
    for i, at in enumerate(s.begin):
        if at - cuts[-1] >= SHARD and i:
            cuts.append(int(at))
    cuts.append(len(s.string))
    orders = [s.shard_order(a, z) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
    listed = np.concatenate(orders)
    # The transform: the symbol before each suffix of each shard in its order, 0 before the first STEP places of a string.
    before = np.where(s.place[listed] >= STEP, s.symbol[np.maximum(listed - STEP, 0)], 0)
    shard = np.repeat(np.arange(len(orders)), [len(o) for o in orders]).astype(np.uint16)
    ends = s.ends[listed]
    tail = shard[ends]  # chains' ends come first and keep the order of the shards
    interleave = np.concatenate([tail, shard[~ends]])
    group = np.zeros(len(listed), np.int64)  # no symbol is compared yet
    for _ in range(LENGTH // STEP):
        turn = np.argsort(interleave, kind="stable")
        symbols = np.empty(len(listed), np.int64)
        symbols[turn] = before
        some = np.flatnonzero(symbols)
        some = some[_by_symbol(symbols[some])]
        interleave = np.concatenate([tail, interleave[some]])
        c, g = symbols[some], group[some]
        parts = np.ones(len(some), bool)
        parts[1:] = (c[1:] != c[:-1]) | (g[1:] != g[:-1])
        group = np.concatenate([np.zeros(len(tail), np.int64), np.cumsum(parts)])
    order = np.empty(len(listed), np.int64)
    order[np.argsort(interleave, kind="stable")] = listed
    return s, order, group


def later_strings(bodies: list[bytes], doc_id: np.ndarray, rid: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the strings that also start earlier, in another piece of the list."""
    s, order, group = repeated_intervals(bodies)
    size = np.array([len(x) for x in bodies])
    whole = s.place[order] + LENGTH <= size[s.string[order]]
    order, group = order[whole], group[whole]
    piece, place = s.string[order], s.place[order]
    o = np.lexsort((at[piece] + place, rid[piece], doc_id[piece], group))
    again = np.zeros(len(o), bool)
    again[1:] = group[o][1:] == group[o][:-1]
    o = o[again]
    return piece[o], place[o]


def _runs(piece: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (piece, low, high) of neighbouring offsets."""
    o = np.lexsort((place, piece))
    piece, place = piece[o], place[o]
    new = np.ones(len(o), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(o)) - 1
    return piece[first], place[first], place[last[: len(first)]]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among pieces that come sorted by core; groups of one piece have none."""
    held: list[tuple] = []
    group: list[tuple] = []
    total = 0

    def close() -> pa.RecordBatch | None:
        nonlocal held, total
        cols = list(zip(*held, strict=True))
        least = np.iinfo(np.int64).min
        ids = np.array([least if x is None else x for x in cols[2]], np.int64)
        piece, low, high = _runs(*later_strings(list(cols[1]), ids, np.array(cols[3], np.int64), np.array(cols[4], np.int64)))
        base = np.array(cols[7], np.int64)[piece]
        out = pa.record_batch([pa.array([cols[6][p] for p in piece], pa.int64()), pa.array([cols[5][p] for p in piece], pa.binary()), pa.array(low + base, pa.int32()), pa.array(high + base, pa.int32())], names=["key", "mark", "low", "high"])
        held, total = [], 0
        return out if out.num_rows else None

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
            if group and group[0][0] != row[0]:
                if len(group) > 1:
                    held += group
                    total += sum(len(r[1]) for r in group)
                group = []
                if total >= BATCH and (out := close()):
                    yield out
            group.append(row)
    held += group if len(group) > 1 else []
    if held and (out := close()):
        yield out


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of crowded pieces one by one."""
    for batch in batches:
        out: list[tuple] = []
        for _, body, doc_id, rid, at, mark, key, offset in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
            out += [(xxh3_128_digest(body[k : k + LENGTH]), doc_id, rid, at + k, mark, key, offset + k) for k in range(len(body) - LENGTH + 1)]
        cols = list(zip(*out, strict=True)) or [[]] * 7
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["string", "doc_id", "rid", "at", "mark", "key", "low"])


def repeats_of(pieces: DataFrame) -> DataFrame:
    """key, mark, low, high: strings of a stretch, by offset, that start earlier in another one."""
    crowds = pieces.groupBy("core").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("core")
    few = pieces.join(crowds.hint("merge"), "core", "left_anti").select(*(c.split()[0] for c in PIECE.split(", ")))
    merged = few.repartition("core").sortWithinPartitions("core", "doc_id", "rid", "at").mapInArrow(_merge, REPEAT)
    kind = "string binary, doc_id long, rid long, at long, mark binary, key long, low int"
    one = pieces.join(crowds.hint("merge"), "core", "left_semi").select(*(c.split()[0] for c in PIECE.split(", "))).mapInArrow(_single, kind)
    start = F.struct("doc_id", "rid", "at")
    first = one.groupBy("string").agg(F.min(start).alias("first"))
    later = one.join(first, "string").filter(~start.eqNullSafe(F.col("first"))).select("key", "mark", "low", F.col("low").alias("high"))
    return merged.unionByName(later)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """rid and an array of (start, end), in bytes, that cover what is to go, from rows (rid, doc_id, text)."""
    filed = stash(rows.select("rid", "text").mapInArrow(_file, "key long, rid long, n int"), "filed")
    twice = filed.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    wanted = stash(filed.join(twice.hint("merge"), "key", "left_semi").groupBy("rid").agg(F.collect_set("key").alias("keys")), "keys")
    found = stash(rows.join(wanted.hint("merge"), "rid").select("rid", "doc_id", "text", "keys").mapInArrow(_cut_out, STRETCH), "stretches")
    discard(wanted, filed)

    start = F.struct("doc_id", "rid", "start")
    bodies = found.filter("body IS NOT NULL").groupBy("key", "mark")
    different = stash(bodies.agg(F.min(start).alias("first"), F.first("anchor").alias("anchor"), F.first("body").alias("body")), "different")
    places = stash(found.select("key", "mark", "rid", "doc_id", "start", "size"), "places")
    discard(found)
    several = different.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    split = different.join(several.hint("merge"), "key", "left_semi").select("key", "mark", "anchor", "body", "first.*")
    pieces = stash(split.mapInArrow(_pieces, PIECE), "pieces")
    repeats = stash(repeats_of(pieces), "repeats")
    discard(pieces)

    firsts = different.select("key", "mark", "first")
    copies = places.select("key", "mark", "rid", "start", "size", start.alias("here")).join(firsts.hint("merge"), ["key", "mark"]).filter(~F.col("here").eqNullSafe(F.col("first")))
    parts = repeats.join(firsts, ["key", "mark"]).select(F.col("first.rid").alias("rid"), (F.col("first.start") + F.col("low")).alias("start"), (F.col("first.start") + F.col("high") + LENGTH).alias("end"))
    spans = copies.select("rid", "start", (F.col("start") + F.col("size")).alias("end")).unionByName(parts)
    merged = stash(spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "removed")
    discard(different, places, repeats)
    return merged


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "spans", "kept"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        sizes, spans, kept = [], [], []
        for text, own in zip(_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            merged = joined([(x["start"], x["end"]) for x in own or []])
            edges = [0, *(e for span in merged for e in span), len(text)]
            sizes.append(len(text))
            spans.append([{"start": a, "end": z} for a, z in merged])
            kept.append(b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (start, end in bytes, maximal), kept (the other bytes) for each row of a stored table.

    Null and empty texts and those below LENGTH bytes lose nothing. Rows with null ids come before all others; rows with the same id
    come in the order they are stored, so that of equal rows the first stays whole. Empty tables give none; other columns are left
    out. Texts of any length are searched whole.
    """
    rows = keyed(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    spans = repeated_spans(rows)
    return rows.join(spans.hint("merge"), "rid", "left").select("doc_id", "text", "spans").mapInArrow(_remove, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op5_merged_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
