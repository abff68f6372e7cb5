"""Resharding by minimum-cost flow: from old shard sizes and new capacities, which blocks move so that the fewest bytes do.

A block is an old shard's rows with one hash value out of a fixed number, so the number of blocks does not grow with the data and
the plan fits the driver. The new place of a row follows from its block alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_folder, stash, table

SHARDS = 40
OLD_SHARDS = 32
BLOCKS = 256  # blocks of an old shard
ROW_BYTES = 16


def min_cost_flow(supply: list[int], room: list[int], cost: np.ndarray) -> np.ndarray:
    """Flow from old to new shards of least total cost: each augmentation takes a cheapest path of what is left.

    supply[i] bytes leave i, at most room[j] reach j, cost[i, j] is paid per byte. The supply must fit the room.
    """
    left, free = np.array(supply, np.int64), np.array(room, np.int64)
    if left.sum() > free.sum():
        raise ValueError("the new shards do not hold all bytes")
    n, m = cost.shape
    flow = np.zeros((n, m), np.int64)
    while left.any():
        to_old = np.where(left > 0, 0.0, np.inf)
        to_new = np.full(m, np.inf)
        via_old, via_new = np.full(m, -1), np.full(n, -1)
        changed = True
        while changed:  # shortest paths over forward edges and, where bytes flow, back edges
            reach = to_old[:, None] + cost
            best = reach.argmin(0)
            better = reach[best, np.arange(m)] < to_new - 1e-9
            to_new[better], via_old[better] = reach[best, np.arange(m)][better], best[better]
            back = np.where(flow > 0, to_new[None, :] - cost, np.inf)
            best = back.argmin(1)
            cheaper = back[np.arange(n), best] < to_old - 1e-9
            to_old[cheaper], via_new[cheaper] = back[np.arange(n), best][cheaper], best[cheaper]
            changed = bool(better.any() or cheaper.any())
        end = int(np.where(free > 0, to_new, np.inf).argmin())
        path, j = [], end
        while True:
            i = int(via_old[j])
            path.append((i, j, True))
            if via_new[i] < 0:
                break
            j = int(via_new[i])
            path.append((i, j, False))
        step = int(min([left[i], free[end], *(flow[a, b] for a, b, forward in path if not forward)]))
        for a, b, forward in path:
            flow[a, b] += step if forward else -step
        left[i] -= step
        free[end] -= step
    return flow


def place_blocks(blocks: list[tuple[int, int, int]], flow: np.ndarray, room: list[int]) -> list[int]:
    """New shard of each block (old shard, block, bytes): large blocks first, each to where most of its shard's flow is still to go.

    What rounding leaves over passes to the next old shard; at the end blocks move between the fullest and the emptiest shard
    while that brings them closer.
    """
    owed = np.zeros(flow.shape[1])
    place = [-1] * len(blocks)
    by_old: dict[int, list[int]] = {}
    for k, (old, _, _) in enumerate(blocks):
        by_old.setdefault(old, []).append(k)
    for old, own in sorted(by_old.items()):
        due = flow[old] + owed
        open_ = flow[old] > 0
        if not open_.any():
            open_[:] = True
        for k in sorted(own, key=lambda k: (-blocks[k][2], blocks[k][1])):
            j = int(np.where(open_, due, -np.inf).argmax())
            place[k] = j
            due[j] -= blocks[k][2]
        owed = np.where(open_, due, owed)
    size = np.array([b[2] for b in blocks], np.int64)
    over = np.bincount(place, size, len(room)) - np.array(room) if blocks else np.zeros(len(room))
    where = np.array(place, np.int64)
    for _ in range(4 * len(blocks)):
        high, low = int(over.argmax()), int(over.argmin())
        own = np.flatnonzero((where == high) & (size > 0) & (size < over[high] - over[low]))
        if not own.size:
            break
        k = own[np.abs(size[own] - (over[high] - over[low]) / 2).argmin()]
        where[k] = low
        over[high] -= size[k]
        over[low] += size[k]
    return where.tolist()


def sized(docs: DataFrame, old_shard, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, size, old_shard and block of each row. `old_shard`: column of shard numbers (null: 0)."""
    body = F.col(f"`{text}`")
    key = F.col(f"`{doc_id}`")
    size = F.coalesce(F.octet_length(body).cast("long"), F.lit(0)) + ROW_BYTES
    return docs.select(
        key.alias("doc_id"), body.alias("text"), size.alias("size"), F.coalesce(old_shard, F.lit(0)).cast("int").alias("old_shard"),
        F.pmod(F.xxhash64(key, F.crc32(body.cast("binary"))), F.lit(BLOCKS)).cast("int").alias("block"),
    )


def plan(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Block transfers: old_shard, block, bytes, rows, shard, base (slot of the block's first row). At most old shards x BLOCKS rows.

    Capacities are equal to a byte. Staying costs nothing, a moved byte costs one.
    """
    spark = rows.sparkSession
    found = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    blocks = sorted((r["old_shard"], r["block"], int(r["bytes"]), int(r["rows"])) for r in found)
    total = sum(b[2] for b in blocks)
    room = [total // shards + (j < total % shards) for j in range(shards)]
    olds = max((b[0] for b in blocks), default=0) + 1
    supply = np.bincount([b[0] for b in blocks], [b[2] for b in blocks], olds).astype(np.int64) if blocks else np.zeros(1, np.int64)
    flow = min_cost_flow(supply.tolist(), room, 1.0 - np.eye(olds, shards))
    place = place_blocks([b[:3] for b in blocks], flow, room)
    base = [0] * shards
    out = []
    for (old, block, size, count), j in zip(blocks, place, strict=True):
        out.append((old, block, size, count, j, base[j]))
        base[j] += count
    return spark.createDataFrame(out, "old_shard int, block int, bytes long, rows long, shard int, base long")


def affected(transfers: DataFrame) -> DataFrame:
    """Shards that gain or lose a block; the files of all others stay as they are."""
    moved = transfers.filter("old_shard <> shard")
    return moved.select("shard").union(moved.select("old_shard")).distinct()


def rewrite(rows: DataFrame, transfers: DataFrame, path: str) -> None:
    """Write the rows of `sized` by new shard, each with its slot: one shuffle, by shard and block, so that a shard spans many tasks.

    Rows of a block are ordered by id, then by text; null ids come first. Copies keep their own rows and slots.
    """
    moved = rows.join(F.broadcast(transfers.select("old_shard", "block", "shard", "base")), ["old_shard", "block"])
    spread = moved.repartitionByRange(F.col("shard"), F.col("old_shard"), F.col("block"))
    own = Window.partitionBy("shard", "old_shard", "block").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    slotted = spread.withColumn("slot", F.col("base") + F.row_number().over(own) - 1)
    slotted.select("doc_id", "text", "old_shard", "slot", "shard").write.partitionBy("shard").parquet(path)


def reshard(docs: DataFrame, old_shard, path: str, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Move `docs` from their old shards to `shards` shards of near equal bytes under `path`; returns what the files hold.

    Null texts count as empty and stay null; null or repeated ids are kept row by row; an empty table gives an empty one; other
    columns are left out.
    """
    spark = docs.sparkSession
    rows = sized(docs, old_shard, doc_id, text)
    transfers = stash(plan(rows, shards), "transfers")
    rewrite(rows, transfers, path)
    kind = docs.schema[doc_id].dataType.simpleString()
    return spark.read.schema(f"doc_id {kind}, text string, old_shard int, slot long, shard int").parquet(path)


def op3_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old layout: one shard for the sources whose hash agrees, so that the hot source makes a large shard."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(OLD_SHARDS)).cast("int")
    stored = reshard(docs, old, new_folder(spark, "shards"))
    body = F.coalesce("text", F.lit(""))
    return stored.select(
        "doc_id", (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )
