"""A hierarchical navigable small-world graph over unit vectors, built and searched for many vectors at once with array operations."""

from __future__ import annotations

import numpy as np

M = 16  # links a vector makes; it keeps up to twice as many
BUILD_BEAM = 64
AT_ONCE = 512


class SmallWorld:
    """layers[l] is (nodes, links): links[k] are the neighbours of nodes[k] as places in `nodes`, -1 for none. Layer 0 has all."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors = vectors.astype(np.float32)
        self.layers = layers

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 0) -> SmallWorld:
        n = len(vectors)
        own = cls(vectors, [])
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(M)).astype(int)
        order = np.argsort(-level, kind="stable")
        layers: list[tuple[np.ndarray, np.ndarray]] = []
        for depth in range(int(level.max(initial=0)), -1, -1):
            nodes = order[: int((level >= depth).sum())]
            layers.insert(0, (nodes, own._layer(nodes, layers)))
        own.layers = layers
        return own

    def _layer(self, nodes: np.ndarray, above: list) -> np.ndarray:
        v = self.vectors[nodes]
        links = np.full((len(nodes), 2 * M), -1, np.int32)
        done = 0
        while done < len(nodes):
            batch = np.arange(done, min(len(nodes), done + min(AT_ONCE, max(2 * M, done))))
            near = v[batch] @ v[batch].T
            np.fill_diagonal(near, -np.inf)
            c = min(BUILD_BEAM, len(batch) - 1)
            some = np.argpartition(-near, c - 1, axis=1)[:, :c] if c > 0 else np.zeros((len(batch), 0), int)
            ids, sims = batch[some], np.take_along_axis(near, some, 1)
            if done:
                start = self._descend(v[batch], above, nodes, done)
                found, far = _beam(v, links, v[batch], start, BUILD_BEAM)
                ids, sims = np.hstack([ids, found]), np.hstack([sims, far])
            rank = np.argsort(-sims, axis=1)[:, :BUILD_BEAM]
            chosen = _diverse(v, np.take_along_axis(ids, rank, 1), np.take_along_axis(sims, rank, 1), M)
            links[batch, : chosen.shape[1]] = chosen
            self._back(v, links, batch, chosen)
            done = batch[-1] + 1
        return links

    @staticmethod
    def _back(v: np.ndarray, links: np.ndarray, batch: np.ndarray, chosen: np.ndarray) -> None:
        """Links in the other direction; who gets too many keeps a diverse part of them."""
        to, frm = chosen.ravel(), np.repeat(batch, chosen.shape[1])
        frm, to = frm[to >= 0], to[to >= 0]
        if not len(to):
            return
        sim = np.einsum("ed,ed->e", v[frm], v[to])
        o = np.lexsort((-sim, to))
        to, frm = to[o], frm[o]
        who, first, size = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, size)
        keep = place < BUILD_BEAM
        new = np.full((len(who), min(int(size.max()), BUILD_BEAM)), -1, np.int64)
        new[np.repeat(np.arange(len(who)), size)[keep], place[keep]] = frm[keep]
        for a in range(0, len(who), AT_ONCE):
            w = who[a : a + AT_ONCE]
            ids = np.hstack([links[w].astype(np.int64), new[a : a + AT_ONCE]])
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("qd,qkd->qk", v[w], v[np.maximum(ids, 0)]), -np.inf)
            rank = np.argsort(-sims, axis=1)
            links[w] = _diverse(v, np.take_along_axis(ids, rank, 1), np.take_along_axis(sims, rank, 1), 2 * M)

    def _descend(self, queries: np.ndarray, layers: list, nodes: np.ndarray | None, most: int) -> np.ndarray:
        """Where to start in the layer below `layers`: the nearest vector found above. Places in `nodes` below `most`."""
        at = np.zeros((len(queries), 1), np.int64)
        for k in range(len(layers) - 1, -1, -1):
            own, links = layers[k]
            found, _ = _beam(self.vectors[own], links, queries, at, 4)
            at = found[:, :1]  # nodes of a layer are the first ones of the layer below
        return np.where((at >= 0) & (at < most), at, 0)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors found near each query, best first, and their similarities (-1, -inf: none)."""
        nodes, links = self.layers[0]
        ids, sims = [], []
        v = self.vectors[nodes]
        some = max(16, min(AT_ONCE, (1 << 21) // max(1, beam * M)))
        for a in range(0, len(queries), some):
            q = queries[a : a + some].astype(np.float32)
            i, s = _beam(v, links, q, self._descend(q, self.layers[1:], None, len(nodes)), beam)
            ids.append(np.where(i >= 0, nodes[np.maximum(i, 0)], -1))
            sims.append(s)
        return (np.vstack(ids), np.vstack(sims)) if ids else (np.zeros((0, beam), int), np.zeros((0, beam)))


def _beam(v: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of many queries in step: each round opens the best few vectors of every beam that are not yet open."""
    q, n = len(queries), len(v)
    beam = min(beam, n)
    wide = max(1, beam // 16)
    rows = np.arange(q)[:, None]
    ids = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf, np.float32)
    opened = np.ones((q, beam), bool)
    ids[:, :1], opened[:, 0] = start[:, :1], False
    sims[:, 0] = np.einsum("qd,qd->q", queries, v[start[:, 0]])
    seen = np.zeros((q, n), bool)
    seen[rows, start[:, :1]] = True
    active = np.arange(q)
    while active.size:
        a = active[:, None]
        open_ = ~opened[active]
        pick = np.argsort(~open_, axis=1, kind="stable")[:, :wide]  # beams are sorted, so the first unopened ones are the best
        good = np.take_along_axis(open_, pick, 1)
        opened[a, pick] = True
        nodes = np.where(good, np.take_along_axis(ids[active], pick, 1), -1)
        near = np.where(nodes[:, :, None] >= 0, links[np.maximum(nodes, 0)], -1).reshape(len(active), -1).astype(np.int64)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        fresh = (near >= 0) & ~seen[a, np.maximum(near, 0)]
        near = np.where(fresh, near, -1)
        width = int(fresh.sum(1).max(initial=0))
        if width:
            near = -np.sort(-near, axis=1)[:, :width]
            there = near >= 0
            seen[np.broadcast_to(a, near.shape)[there], near[there]] = True
            s = np.where(there, np.einsum("qd,qkd->qk", queries[active], v[np.maximum(near, 0)]), -np.inf).astype(np.float32)
            all_ids, all_sims = np.hstack([ids[active], near]), np.hstack([sims[active], s])
            all_open = np.hstack([opened[active], ~there])
            rank = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, rank, 1), np.take_along_axis(all_sims, rank, 1)
            opened[active] = np.take_along_axis(all_open, rank, 1)
        active = active[(~opened[active]).any(1)]
    return ids, sims


def _diverse(v: np.ndarray, ids: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """Up to m of the candidates (best first): those nearer to the vector than to any chosen before, then the best of the rest."""
    q, c = ids.shape
    if c == 0:
        return np.full((q, m), -1, np.int64)
    w = v[np.maximum(ids, 0)]
    between = np.einsum("qid,qjd->qij", w, w)
    there = np.isfinite(sims) & (ids >= 0)
    chosen = np.zeros((q, c), bool)
    for k in range(c):
        clash = (chosen[:, :k] & (between[:, k, :k] > sims[:, k : k + 1])).any(1)
        chosen[:, k] = there[:, k] & ~clash & (chosen.sum(1) < m)
    rank = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :m]
    out = np.where(np.take_along_axis(there, rank, 1), np.take_along_axis(ids, rank, 1), -1)
    return np.hstack([out, np.full((q, m - out.shape[1]), -1, np.int64)]) if out.shape[1] < m else out
