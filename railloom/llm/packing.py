"""Packing by power-of-two decomposition: no sequence crosses a document and none is padded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import default_vocabulary, ids_column

SEQUENCE = 1024
END_ID = 0


def decompose(n, longest: int):
    """Array of (start, length) that cuts n ids into blocks of `longest`, then the binary digits of the rest, largest first."""
    n = n.cast("long")
    blocks = F.transform(
        F.array_repeat(F.lit(longest).cast("long"), F.floor(n / longest).cast("int")),
        lambda length, i: F.struct((i * longest).cast("long").alias("start"), length.alias("length")),
    )
    digits = [1 << b for b in reversed(range(longest.bit_length() - 1))]
    rest = [F.when(n.bitwiseAND(F.lit(d).cast("long")) != 0, F.struct((n - n % (2 * d)).alias("start"), F.lit(d).cast("long").alias("length"))) for d in digits]
    return F.concat(blocks, F.filter(F.array(*rest), lambda x: x.isNotNull())) if rest else blocks


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, longest: int = SEQUENCE, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """One row per piece, which is a sequence of its own: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Null and empty texts hold the end id alone. Rows with null or repeated ids are packed one by one; equal texts give equal
    pieces under their own sequence ids. An empty table gives no rows; other columns are left out. `length` is the bucket: all
    sequences of a length can be read together (see `write_buckets`). Nothing is shuffled. `added`: see `WordEncoder`.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    ids = ids_column(F.col(f"`{text}`"), vocabulary or default_vocabulary(), end_id, added)
    encoded = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), ids.alias("ids"))
    counted = encoded.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("doc_tokens"))
    cut = F.transform(
        decompose(F.col("doc_tokens"), longest),
        lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), F.substring(F.col("ids"), (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids")),
    )
    pieces = counted.select("doc_id", "doc_tokens", F.explode(cut).alias("p"))
    return pieces.select(
        "doc_id", "p.start", "p.length", "p.ids", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences of equal length in a folder of their own, so that a batch needs no padding."""
    packed.write.partitionBy("length").parquet(path)


def op10_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), added=True)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
