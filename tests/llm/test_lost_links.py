"""Links that the graph or the audit alone would lose."""

import numpy as np

from railloom.llm import near_vectors


class Blind:
    """A graph of which only some vectors can be reached."""

    def __init__(self, vectors, reach):
        self.vectors, self.reach = vectors, reach

    def search(self, queries, beam):
        sims = queries @ self.vectors[self.reach].T
        order = np.argsort(-sims, axis=1)[:, :beam]
        ids, best = np.full((len(queries), beam), -1), np.full((len(queries), beam), -2.0)
        ids[:, : order.shape[1]], best[:, : order.shape[1]] = self.reach[order], np.take_along_axis(sims, order, 1)
        return ids, best


def tight_groups():
    r = np.random.default_rng(8)
    centres = r.normal(size=(6, 24))
    centres[1] = centres[0] + r.normal(size=24) * 0.2
    v = np.vstack([c + r.normal(size=(100, 24)) * 0.01 for c in centres])
    return v / np.linalg.norm(v, axis=1)[:, None]


def test_what_the_graph_cannot_reach_is_linked():
    v = tight_groups()
    truth = v @ v.T >= near_vectors.COSINE
    assert truth[:100, 100:200].all()
    assert (near_vectors.linked(v, v, Blind(v, np.arange(100)), near_vectors.COSINE) == truth).all()


def test_links_that_no_audited_vector_has_are_found():
    r = np.random.default_rng(9)
    a, b = r.normal(size=(2, 1000, 24))
    b[777] = a[333] * 2
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b))
    found = near_vectors.linked(a, b, Blind(b, np.arange(100)), near_vectors.COSINE)
    assert np.argwhere(found).tolist() == [[333, 777]]
