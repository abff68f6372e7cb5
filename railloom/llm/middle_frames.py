"""Fill-in-middle transformation over seekable compressed frames.

A stored row ("shelf") holds the texts of some consecutive documents as zstandard frames that open on their own, with the byte and
the number of units at which each frame and each document begins. A cut behind unit k is found by bisecting these numbers and
opening the one frame in which the k-th unit ends. Transformed texts are written as shelves of the same kind; digests stream over
frames in order, so that no step holds more of a text than a frame. No step shuffles.

Units are `[white space]*[other]+`, or the white space at the end of a text; white space is the ASCII one, so that units can be
told from bytes. A unit may be longer than a frame.

Defined results: a null text is an empty one; an empty text is plain with 0 units; a null id hashes like an empty string; repeated ids
and texts are rows of their own; other columns, whatever their names, are left out; an empty table gives an empty result. A document
never crosses a shelf, so a shelf is as large as `SHELF` or its one longest text, which was a row of the input before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, stash, table

FRAME = 1 << 16  # bytes of text in a frame
SHELF = 1 << 22  # bytes of text in a shelf, unless one text is longer
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
LONGS = pa.list_(pa.int64())
SHELVES = pa.schema([("doc_id", LONGS), ("text_at", LONGS), ("units_at", LONGS), ("marked", pa.list_(pa.bool_())), ("frame_units", LONGS), ("frames", pa.list_(pa.binary()))])
SHELVES_SQL = "doc_id array<long>, text_at array<long>, units_at array<long>, marked array<boolean>, frame_units array<long>, frames array<binary>"
MOVED = pa.schema([("doc_id", LONGS), ("n", LONGS), ("form", pa.list_(pa.string())), ("prefix_chars", LONGS), ("middle_chars", LONGS), ("text_at", LONGS), ("frames", pa.list_(pa.binary()))])
MOVED_SQL = "doc_id array<long>, n array<long>, form array<string>, prefix_chars array<long>, middle_chars array<long>, text_at array<long>, frames array<binary>"
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
DIGESTS_SQL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Law:
    """How often a text is rearranged and into which form: `rate` of 100 in all, `spm` of 100 of these suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80


def _unit_ends(data: np.ndarray, last: np.ndarray, open_end: bool) -> np.ndarray:
    """Ends (exclusive) of units in `data`; `last`: where texts have their last byte; `open_end`: a unit ends with the last byte."""
    white = _WHITE[data]
    end = np.empty(len(data), bool)
    end[:-1], end[-1:] = white[1:] & ~white[:-1], open_end
    end[last] = True
    return np.flatnonzero(end) + 1


class FrameReader:
    """Bytes of a shelf by position; the frames opened last are kept."""

    def __init__(self, frames: list[bytes], kept: int = 3):
        import zstandard

        self.frames, self.kept = frames, kept
        self.open = zstandard.ZstdDecompressor().decompress
        self.at_hand: dict[int, bytes] = {}

    def frame(self, k: int) -> bytes:
        if k not in self.at_hand:
            while len(self.at_hand) >= self.kept:
                del self.at_hand[next(iter(self.at_hand))]
            self.at_hand[k] = self.open(self.frames[k], FRAME)
        return self.at_hand[k]

    def read(self, begin: int, end: int) -> Iterator[memoryview]:
        """Bytes from `begin` to `end`, frame by frame."""
        while begin < end:
            k, off = divmod(begin, FRAME)
            part = memoryview(self.frame(k))[off : off + end - begin]
            yield part
            begin += len(part)

    def find(self, mark: bytes, begin: int, end: int) -> int:
        """Place of the first `mark` in a stretch, or -1."""
        tail, at = b"", begin
        for part in self.read(begin, end):
            seen = tail + bytes(part)
            if (hit := seen.find(mark)) >= 0:
                return at - len(tail) + hit
            at += len(part)
            tail = seen[1 - len(mark) :]
        return -1


class FrameWriter:
    """Bytes to frames of fixed size."""

    def __init__(self, level: int = 3):
        import zstandard

        self.squeeze = zstandard.ZstdCompressor(level=level).compress
        self.frames: list[bytes] = []
        self.held = bytearray()
        self.size = 0

    def write(self, part: bytes | memoryview) -> None:
        self.held += part
        self.size += len(part)
        if len(self.held) >= FRAME:
            done = len(self.held) // FRAME * FRAME
            with memoryview(self.held) as held:
                self.frames += [self.squeeze(held[k : k + FRAME]) for k in range(0, done, FRAME)]
            del self.held[:done]

    def close(self) -> list[bytes]:
        if self.held:
            self.frames.append(self.squeeze(self.held))
            self.held = bytearray()
        return self.frames


class Cuts:
    """Places behind units of a shelf, by the numbers of units before its frames."""

    def __init__(self, reader: FrameReader, text_at: np.ndarray, frame_units: np.ndarray):
        self.reader, self.text_at, self.frame_units = reader, text_at, frame_units
        self.found = (-1, np.empty(0, np.int64))

    def _ends(self, k: int) -> np.ndarray:
        if self.found[0] != k:
            data = np.frombuffer(self.reader.frame(k), np.uint8)
            edges = np.unique(self.text_at) - k * FRAME
            last = edges[(edges > 0) & (edges <= len(data))] - 1
            ends = _unit_ends(data, last, False)
            if len(ends) < self.frame_units[k + 1] - self.frame_units[k]:  # the unit at the end of the frame is not continued behind it
                ends = np.append(ends, len(data))
            self.found = (k, ends)
        return self.found[1]

    def behind(self, unit: int) -> int:
        """Byte behind the unit of this number, counted from 1 over the shelf."""
        k = int(np.searchsorted(self.frame_units, unit, side="left")) - 1
        return k * FRAME + int(self._ends(k)[unit - 1 - self.frame_units[k]])


def _marks(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Whether each text holds one of the three marks."""
    found = np.zeros(len(heads) - 1, bool)
    at = np.flatnonzero(data[:-2] == PREFIX[0])
    at = at[(data[at + 2] == PREFIX[2]) & np.isin(data[at + 1], [PREFIX[1], SUFFIX[1], MIDDLE[1]])]
    owner = np.searchsorted(heads, at, side="right") - 1
    found[owner[at + 3 <= heads[owner + 1]]] = True
    return found


def _shelf(ids: list, data: np.ndarray, heads: np.ndarray) -> dict:
    last = heads[1:][np.diff(heads) > 0] - 1
    ends = _unit_ends(data, last, False) if len(data) else np.empty(0, np.int64)
    bounds = np.minimum(np.arange(0, len(data) + FRAME, FRAME), len(data))
    writer = FrameWriter()
    writer.write(data.data)
    return {
        "doc_id": ids, "text_at": heads, "units_at": np.searchsorted(ends, heads, side="right"), "marked": _marks(data, heads),
        "frame_units": np.searchsorted(ends, bounds, side="right"), "frames": writer.close(),
    }


def _row(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    """One row whose columns are the lists `values`."""
    return pa.record_batch([pa.array([values[f.name]], f.type) for f in schema], schema=schema)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
        heads = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(texts):
            after = max(first + 1, int(np.searchsorted(heads, heads[first] + SHELF, side="right")) - 1)
            own = heads[first : after + 1]
            yield _row(_shelf(batch.column(0).slice(first, after - first).to_pylist(), data[own[0] : own[-1]], own - own[0]), SHELVES)
            first = after


def to_frames(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shelves of all texts, one row each, to be stored before they are read."""
    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return picked.mapInArrow(_store, SHELVES_SQL)


def _choice(law: Law, doc_id: int | None, n: int, marked: bool) -> tuple[str, int, int]:
    digest = hashlib.sha256(f"{law.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    if n == 0 or marked or h3 % 100 >= law.rate:
        return PLAIN, 0, 0
    one, two = h1 % (n + 1), h2 % (n + 1)
    return SPM if h4 % 100 < law.spm else PSM, min(one, two), max(one, two)


def _chars(reader: FrameReader, begin: int, end: int) -> int:
    return sum(int(np.count_nonzero((np.frombuffer(p, np.uint8) & 0xC0) != 0x80)) for p in reader.read(begin, end))


def _mover(law: Law):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shelf = {f: c[0] for f, c in batch.slice(k, 1).to_pydict().items()}
                reader = FrameReader(shelf["frames"])
                heads, units = np.array(shelf["text_at"], np.int64), shelf["units_at"]
                cuts = Cuts(reader, heads, np.array(shelf["frame_units"], np.int64))
                writer, out = FrameWriter(), {f.name: [] for f in MOVED}
                for d, doc_id in enumerate(shelf["doc_id"]):
                    begin, end, n = int(heads[d]), int(heads[d + 1]), units[d + 1] - units[d]
                    form, one, two = _choice(law, doc_id, n, shelf["marked"][d])
                    out["text_at"].append(writer.size)
                    if form == PLAIN:
                        order, counts = [(b"", begin, end)], (None, None)
                    else:
                        low = cuts.behind(units[d] + one) if one else begin
                        high = cuts.behind(units[d] + two) if two else begin
                        prefix, middle, suffix = (PREFIX, begin, low), (MIDDLE, low, high), (SUFFIX, high, end)
                        order = [prefix, suffix, middle] if form == PSM else [suffix, prefix, middle]
                        counts = (_chars(reader, begin, low), _chars(reader, low, high))
                    for mark, a, b in order:
                        writer.write(mark)
                        for part in reader.read(a, b):
                            writer.write(part)
                    for name, value in (("doc_id", doc_id), ("n", n), ("form", form), ("prefix_chars", counts[0]), ("middle_chars", counts[1])):
                        out[name].append(value)
                out["text_at"].append(writer.size)
                out["frames"] = writer.close()
                yield _row(out, MOVED)

    return move


def rearrange(shelves: DataFrame, law: Law = Law()) -> DataFrame:
    """Shelves with prefix, middle and suffix of the chosen texts in their new order, and where each text begins."""
    return shelves.mapInArrow(_mover(law), MOVED_SQL)


def sections(reader: FrameReader, form: str, begin: int, end: int) -> list[tuple[int, int]]:
    """Where prefix, middle and suffix lie in a transformed text; they hold no mark, so the first one found is the one set."""
    if form == PLAIN:
        return [(begin, end)]
    second = reader.find(SUFFIX if form == PSM else PREFIX, begin, end)
    third = reader.find(MIDDLE, second, end)
    left, right = (begin + len(PREFIX), second), (second + len(SUFFIX), third)
    prefix, suffix = (left, right) if form == PSM else (right, left)
    return [prefix, (third + len(MIDDLE), end), suffix]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            shelf = {f: c[0] for f, c in batch.slice(k, 1).to_pydict().items()}
            reader, heads = FrameReader(shelf["frames"]), shelf["text_at"]
            out = {f.name: shelf.get(f.name, []) for f in DIGESTS}
            for d, form in enumerate(shelf["form"]):
                stretches = ([(heads[d], heads[d + 1])], sections(reader, form, heads[d], heads[d + 1]))
                for name, stretch in zip(("output_sha256", "restored_sha256"), stretches, strict=True):
                    digest = hashlib.sha256()
                    for a, b in stretch:
                        for part in reader.read(a, b):
                            digest.update(part)
                    out[name].append(digest.hexdigest())
            yield pa.RecordBatch.from_pydict(out, DIGESTS)


def digests(moved: DataFrame) -> DataFrame:
    """Per document its form, the lengths of its parts, and digests of the output and of the text rebuilt from it."""
    return moved.mapInArrow(_digest, DIGESTS_SQL)


def texts(moved: DataFrame) -> DataFrame:
    """(doc_id, form, text) of the transformed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("text", pa.string())])
        for batch in batches:
            for k in range(batch.num_rows):
                shelf = {f: c[0] for f, c in batch.slice(k, 1).to_pydict().items()}
                reader, heads = FrameReader(shelf["frames"]), shelf["text_at"]
                for d, doc_id in enumerate(shelf["doc_id"]):
                    whole = b"".join(reader.read(heads[d], heads[d + 1])).decode()
                    yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "form": shelf["form"][d], "text": whole}], schema)

    return moved.mapInArrow(run, "doc_id long, form string, text string")


def op11_seekable_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelves = stash(to_frames(table(spark, sf_dir, "documents")), "frames")
    moved = stash(rearrange(shelves), "moved")
    discard(shelves)
    return digests(moved)


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
  k AS (SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
  c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
  p AS (SELECT *, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1:hi], '') AS mid, array_to_string(u[hi + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
