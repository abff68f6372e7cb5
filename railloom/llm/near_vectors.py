"""Near-duplicate vectors by one navigable small-world graph per shard: every vector is searched in every shard of its label.

Beams widen for vectors whose whole beam is linked, and for all vectors of a pair of shards until an audit of some of them against
brute force passes. Links are verified by cosine in double precision and joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, stash, table
from .components import components
from .small_world import SmallWorld

COSINE = 0.93
SHARD = 8192  # different vectors of a graph, about
BEAM = 64
BLOCK = 1024  # vectors compared at once with a whole shard
AUDITED = 64  # vectors of each side of a pair of shards that are compared with brute force, and as many of those that have links; fewer only if there are fewer
RECALL = 0.99  # of the audited links that must be found
_GRAPH = "label int, dims int, shard int, reps binary, sizes binary, vectors binary, nodes array<binary>, links array<binary>"
_FOUND = "rep long, links long, other long"


def _build(groups: pa.Table) -> pa.Table:
    """One row: a shard's graph."""
    first = groups.slice(0, 1).to_pylist()[0]
    reps = groups.column("rep").to_numpy()
    order = np.argsort(reps)
    v = np.array(groups.column("v").to_pylist(), np.float64)[order]
    v /= np.abs(v).max(1, keepdims=True)
    v /= np.sqrt((v * v).sum(1, keepdims=True))
    graph = SmallWorld.build(v)
    row = {
        "label": first["label"], "dims": first["dims"], "shard": first["shard"],
        "reps": reps[order].astype(np.int64).tobytes(), "sizes": groups.column("size").to_numpy()[order].astype(np.int64).tobytes(), "vectors": v.tobytes(),
        "nodes": [n.astype(np.int32).tobytes() for n, _ in graph.layers], "links": [x.astype(np.int32).tobytes() for _, x in graph.layers],
    }
    kinds = [("label", pa.int32()), ("dims", pa.int32()), ("shard", pa.int32()), ("reps", pa.binary()), ("sizes", pa.binary()), ("vectors", pa.binary()), ("nodes", pa.list_(pa.binary())), ("links", pa.list_(pa.binary()))]
    return pa.Table.from_pylist([row], pa.schema(kinds))


def _graph(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, SmallWorld]:
    v = np.frombuffer(row[f"{side}_vectors"], np.float64).reshape(-1, row["dims"])
    layers = [(np.frombuffer(n, np.int32).astype(np.int64), np.frombuffer(x, np.int32).reshape(len(n) // 4, -1)) for n, x in zip(row[f"{side}_nodes"], row[f"{side}_links"], strict=True)]
    return np.frombuffer(row[f"{side}_reps"], np.int64), np.frombuffer(row[f"{side}_sizes"], np.int64), v, SmallWorld(v, layers)


def exact(queries: np.ndarray, vectors: np.ndarray, cosine: float) -> np.ndarray:
    """[query, vector]: has at least the cosine, by matrix products of BLOCK queries each."""
    out = np.zeros((len(queries), len(vectors)), bool)
    for at in range(0, len(queries), BLOCK):
        q, i = np.nonzero(queries[at : at + BLOCK] @ vectors.T >= cosine - 1e-9)
        for k in range(0, len(q), 1 << 16):
            a, b = q[k : k + (1 << 16)] + at, i[k : k + (1 << 16)]
            out[a, b] = np.einsum("kd,kd->k", queries[a], vectors[b]) >= cosine
    return out


def linked(queries: np.ndarray, vectors: np.ndarray, graph: SmallWorld, cosine: float) -> np.ndarray:
    """[query, vector]: found by the graph with at least the cosine.

    Where the audit has no true link to go by, or still fails at the widest beam (a part of the graph may not be connected), all
    are compared instead.
    """
    n, out = len(vectors), np.zeros((len(queries), len(vectors)), bool)

    def look(which: np.ndarray, beam: int) -> None:
        while which.size:
            ids, sims = graph.search(queries[which], beam)
            there = (ids >= 0) & (sims >= cosine - 1e-4)
            q, i = np.broadcast_to(which[:, None], ids.shape)[there], ids[there]
            out[q, i] = np.einsum("kd,kd->k", queries[q], vectors[i]) >= cosine
            which, beam = which[there.all(1) & (ids.shape[1] == beam) & (beam < n)], beam * 4

    def spread(which: np.ndarray) -> np.ndarray:
        return which[np.linspace(0, len(which) - 1, min(AUDITED, len(which))).astype(int)]

    beam = BEAM
    look(np.arange(len(queries)), beam)
    # Every vector links with itself, which is no audit.
    own = queries is vectors
    sample = np.union1d(spread(np.arange(len(queries))), spread(np.flatnonzero(out.sum(1) > own)))
    truth = exact(queries[sample], vectors, cosine)
    if own:
        truth[np.arange(len(sample)), sample] = False
    while (out[sample] & truth).sum() < RECALL * truth.sum() and beam < n:
        beam *= 2
        look(np.arange(len(queries)), beam)
    return out if truth.any() and (out[sample] & truth).sum() >= RECALL * truth.sum() else exact(queries, vectors, cosine)


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a symmetric link matrix joins: every node with the first of its component."""
    left, edges = link.any(1), []
    for root in np.flatnonzero(left):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while front.size:
            front = np.flatnonzero(link[front].any(0) & left)
            left[front] = False
            edges += [(root, x) for x in front]
    return edges


def _search(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                reps, sizes, v, graph = _graph(row, "a")
                if row["same"]:
                    link = linked(v, v, graph, cosine)
                    link |= link.T
                    np.fill_diagonal(link, False)
                    counts, edges = link @ sizes.astype(np.float64), _forest(link)
                else:
                    reps_b, sizes_b, v_b, graph_b = _graph(row, "b")
                    between = linked(v, v_b, graph_b, cosine) | linked(v_b, v, graph, cosine).T
                    counts = np.append(between @ sizes_b.astype(np.float64), sizes.astype(np.float64) @ between)
                    n = len(reps)
                    whole = np.zeros((n + len(reps_b),) * 2, bool)
                    whole[:n, n:], whole[n:, :n] = between, between.T
                    edges, reps = _forest(whole), np.append(reps, reps_b)
                has = np.flatnonzero(counts)
                a, b = np.array(edges, np.int64).reshape(-1, 2).T
                yield pa.record_batch(
                    [
                        pa.array(np.append(reps[has], reps[a])),
                        pa.array(np.append(counts[has], np.zeros(len(a))).astype(np.int64)),
                        pa.array(np.append(np.full(len(has), -1), reps[b]), mask=np.append(np.ones(len(has), bool), np.zeros(len(b), bool))),
                    ],
                    names=["rep", "links", "other"],
                )

    return run


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of a stored table.

    Rows with the same label and vector are one class: they link with each other and with what the class links with. Null labels,
    and vectors that are null, empty, zero or hold null or non-finite parts, link with nothing; vectors of different lengths do
    not compare. Rows with a null id keep it, count as links and are not kept; a component's id is the least one that is not
    null. Repeated ids stay repeated rows; ties in similarity do not matter; an empty table gives none; other columns are left out.
    """
    vector = F.col(f"`{embedding}`").cast("array<double>")
    own = keyed(rows, vec_id=vec_id, label=F.col(f"`{label}`").cast("int"), v=vector)
    finite = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    fit = own.filter(F.col("label").isNotNull() & finite).withColumn("dims", F.size("v"))
    classes = stash(fit.groupBy("label", "dims", "v").agg(F.min("rid").alias("rep"), F.count("*").alias("size")), "classes")
    member = fit.join(classes.select("label", "v", "rep", "size"), ["label", "v"]).select("rid", "rep", "size")

    per_label = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    sharded = classes.join(per_label, ["label", "dims"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    graphs = stash(sharded.groupBy("label", "dims", "shard").applyInArrow(_build, _GRAPH), "graphs")
    sides = ("reps", "sizes", "vectors", "nodes", "links")
    a = graphs.select("label", "dims", F.col("shard").alias("a_shard"), *(F.col(c).alias(f"a_{c}") for c in sides))
    b = graphs.select("label", "dims", F.col("shard").alias("b_shard"), *(F.col(c).alias(f"b_{c}") for c in sides))
    pairs = a.join(b, ["label", "dims"]).filter("a_shard <= b_shard").withColumn("same", F.expr("a_shard = b_shard"))
    for c in sides:
        pairs = pairs.withColumn(f"b_{c}", F.when(~F.col("same"), F.col(f"b_{c}")))
    spread = pairs.repartition("label", "dims", "a_shard", "b_shard")
    found = stash(spread.mapInArrow(_search(cosine), _FOUND), "links")

    counts = found.filter("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(found.filter("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "rep")
    per_class = stash(classes.select("rep").join(counts, "rep", "left").join(parts, "rep", "left").select("rep", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component")), "classes")
    ids = own.select("rid", "vec_id").join(member.join(per_class, "rep"), "rid", "left").withColumn("component", F.coalesce("component", -1 - F.col("rid")))
    ids = stash(ids, "rows")
    least = ids.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return ids.join(least, "component").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("size", F.lit(1)) - 1).alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def op7_small_worlds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  l AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  n AS MATERIALIZED (SELECT x, count(*) AS n FROM l GROUP BY x),
  part(vec_id, least) USING KEY (vec_id) AS (SELECT vec_id, vec_id FROM embeddings
    UNION SELECT l.y, min(q.least) FROM part q JOIN l ON l.x = q.vec_id LEFT JOIN recurring.part r ON r.vec_id = l.y WHERE q.least < r.least GROUP BY l.y)
SELECT d.vec_id, coalesce(n.n, 0) AS n_links, part.least AS component_id, d.vec_id = part.least AS kept
FROM embeddings d LEFT JOIN n ON n.x = d.vec_id JOIN part ON part.vec_id = d.vec_id
"""
