"""Token files: blocks of ids transposed into byte or bit planes, each plane compressed on its own, with a chunk index.

A folder holds Parquet files whose rows are chunks. The index columns (part, block, n_ids, docs) say where each document lies
and can be read without the planes; `planes` holds the compressed planes, lowest first. Parts are numbered in document order
and blocks in order within their part; every block but the last of a part has the same number of ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import new_folder, table
from .tokens import default_vocabulary, encoder

END_ID = 2
BLOCK = 1 << 16
CHUNKS = "part int, block int, n_ids int, width int, planes array<binary>, docs array<struct<row:long,doc_id:long,at:long,n:int,first:boolean,last:boolean>>"
PIECES = "part int, row long, doc_id long, at long, n int, whole boolean, block int, ids binary"
TEXTS_AT_ONCE = 256


def to_planes(ids: np.ndarray, bits: bool, level: int = 3) -> list[bytes]:
    """Planes of a block, as many as its largest id needs."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level).compress
    flat = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
        return [squeeze(np.ascontiguousarray(flat[:, k]).tobytes()) for k in range(width)]
    spread = np.unpackbits(flat, axis=1, bitorder="little")
    width = max(1, int(ids.max(initial=0)).bit_length())
    return [squeeze(np.packbits(spread[:, k], bitorder="little").tobytes()) for k in range(width)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    if not bits:
        flat = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            flat[:, k] = np.frombuffer(open_(p), np.uint8)
        return flat.view("<u4").ravel()
    ids = np.zeros(n, np.uint32)
    for k, p in enumerate(planes):
        ids |= np.unpackbits(np.frombuffer(open_(p), np.uint8), bitorder="little", count=n).astype(np.uint32) << np.uint32(k)
    return ids


def _writer(path: str, end_id: int, block_ids: int, bits: bool, added: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("width", pa.int32()), ("planes", pa.list_(pa.binary())), ("docs", pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_())])))])
        part, encode = TaskContext.get().partitionId(), encoder(path, added).encode
        held: list[np.ndarray] = []  # ids not yet in a block
        pieces: list[np.ndarray] = []  # columns row, id, id is null, place, n, first, last of their documents
        filled, block, row, place = 0, 0, 0, 0

        def flush(size: int) -> pa.RecordBatch:
            nonlocal filled, block
            ids, own = np.concatenate(held), np.concatenate(pieces, axis=1)
            held[:], pieces[:] = [ids[size:]], []
            n = int(np.searchsorted(np.cumsum(own[4]), size, side="right"))
            if n < own.shape[1]:  # the block ends within a document, or just before one
                over = int(own[4, : n + 1].sum()) - size
                rest = own[:, n:].copy()
                if over < own[4, n]:
                    own[4, n] -= over
                    own[6, n] = 0
                    rest[3, 0] += own[4, n]
                    rest[4, 0] = over
                    rest[5, 0] = 0
                    n += 1
                pieces.append(rest)
            own = own[:, :n]
            docs = pa.StructArray.from_arrays(
                [pa.array(own[0]), pa.array(own[1], mask=own[2] > 0), pa.array(own[3]), pa.array(own[4], pa.int32()), pa.array(own[5] > 0), pa.array(own[6] > 0)], fields=list(schema.field("docs").type.value_type)
            )
            planes = to_planes(ids[:size], bits)
            out = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([size], pa.int32()), pa.array([len(planes)], pa.int32()), pa.array([planes], pa.list_(pa.binary())), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), docs).cast(schema.field("docs").type)]
            filled, block = filled - size, block + 1
            return pa.record_batch(out, schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                ids, counts = encode([t or "" for t in some.column(1).to_pylist()])
                # The end id behind every document.
                upto = np.cumsum(counts + 1)
                whole = np.full(upto[-1], end_id, np.uint32)
                inner = np.ones(len(whole), bool)
                inner[upto - 1] = False
                whole[inner] = ids
                key = some.column(0)
                one = np.ones(len(counts), np.int64)
                pieces.append(np.stack([row + np.arange(len(counts)), pc.fill_null(key, 0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), place + upto - counts - 1, counts + 1, one, one]))
                held.append(whole)
                filled, row, place = filled + len(whole), row + len(counts), place + len(whole)
                while filled >= block_ids:
                    yield flush(block_ids)
        if filled:
            yield flush(filled)

    return run


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK, bits: bool = False, added: bool = False) -> None:
    """Encode texts (null: empty) with an end id behind each and write them in ascending order of the id.

    Ids that are null come first; rows with the same id follow each other in order of their text and stay apart. Other columns
    are left out. An empty table writes a folder without chunks. A text of any length flows through blocks of fixed size. `added`: see
    `WordEncoder`.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"), "text")
    chunks = ordered.mapInArrow(_writer(vocabulary or default_vocabulary(), end_id, block_ids, bits, added), CHUNKS)
    chunks.write.option("compression", "none").parquet(path)


def _reader(bits: bool):
    schema = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("whole", pa.bool_()), ("block", pa.int32()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                c = {n: batch.column(n)[k] for n in ("part", "block", "n_ids", "planes")}
                docs = batch.column("docs")[k].values
                raw = from_planes(c["planes"].as_py(), c["n_ids"].as_py(), bits).tobytes()
                n = docs.field("n")
                cuts = np.append(0, np.cumsum(4 * n.to_numpy(), dtype=np.int64))
                ids = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.array(cuts, pa.int32()).buffers()[1], pa.py_buffer(raw)])
                same = lambda name: pa.repeat(c[name], len(docs))  # noqa: E731, B023
                whole = pc.and_(docs.field("first"), docs.field("last"))
                yield pa.record_batch([same("part"), docs.field("row"), docs.field("doc_id"), docs.field("at"), n, whole, same("block"), ids], schema=schema)

    return run


def read_pieces(spark: SparkSession, path: str, bits: bool = False) -> DataFrame:
    """Rows (part, row, doc_id, at, n, whole, block, ids): each document's ids in each chunk that holds some."""
    return spark.read.schema(CHUNKS).parquet(path).mapInArrow(_reader(bits), PIECES)


@F.arrow_udf(LongType())
def crc_of_all(parts: pa.Array) -> pa.Array:
    """crc32 of binaries one after the other."""
    sums = []
    for some in parts.to_pylist():
        crc = 0
        for piece in some:
            crc = zlib.crc32(piece, crc)
        sums.append(crc)
    return pa.array(sums, pa.int64())


def read_digests(spark: SparkSession, path: str, bits: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone.

    Documents within a chunk are done where they are read; only those that cross a chunk's end meet in a shuffle.
    """
    pieces = read_pieces(spark, path, bits)
    checked = pieces.select("part", "row", "doc_id", "at", "n", "whole", "block", F.when(F.col("whole"), F.crc32("ids")).alias("crc"), F.when(~F.col("whole"), F.col("ids")).alias("ids"))
    whole = checked.filter("whole").select("part", "doc_id", "at", F.col("n").cast("long").alias("n"), "crc")
    joined = checked.filter("NOT whole").groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("block", "ids"))).alias("ids")
    )
    cut = joined.select("part", "doc_id", "at", "n", crc_of_all(F.transform("ids", lambda x: x["ids"])).alias("crc"))
    sizes = spark.read.schema(CHUNKS).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("size"))
    base = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    return whole.unionByName(cut).join(base, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def op4_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, added=True)
    return read_digests(spark, path)
