"""Run grouping and shortest paths against literal one-at-a-time versions."""

import heapq
import random

import pytest

from railloom.operators.clustering import cover_pairs, led_runs, similar_runs
from railloom.operators.paths import shortest_paths


def random_runs(seed):
    rnd = random.Random(seed)
    out = {}
    for key in ("k1", "k2"):
        protos = [rnd.sample(range(40), rnd.randint(1, 14)) for _ in range(4)]
        for i in range(30 if key == "k1" else 8):
            segs = set(rnd.choice(protos))
            for _ in range(rnd.randint(0, 2)):
                if rnd.random() < 0.5:
                    segs.add(rnd.randrange(40))
                elif len(segs) > 1:
                    segs.remove(rnd.choice(sorted(segs)))
            out[(key, f"r{i:03d}")] = segs
    return out


def covers(a, b):
    return 100 * (1 + len(a & b)) / (1 + len(a)) >= 85


def one_at_a_time(runs):
    left, out = sorted(runs), {}
    while left:
        lead = left.pop(0)
        out[lead] = lead[1]
        for r in [r for r in left if r[0] == lead[0] and covers(runs[lead], runs[r])]:
            out[r] = lead[1]
            left.remove(r)
    return out


def signature_frame(spark, runs):
    data = [(k, r, str(s)) for (k, r), segs in runs.items() for s in segs]
    return spark.createDataFrame(data, "route_key STRING, tr_line STRING, seg STRING")


@pytest.mark.parametrize("seed,block,growth", [(1, 256, 16), (2, 4, 2), (3, 5, 3)])
def test_grouping(spark, seed, block, growth):
    runs = random_runs(seed)
    got = similar_runs(signature_frame(spark, runs), block=block, growth=growth).collect()
    assert {(r["route_key"], r["tr_line"]): r["leader"] for r in got} == one_at_a_time(runs)
    assert len(got) == len(runs)


def test_cover_pairs(spark):
    runs = random_runs(7)
    want = {(a[0], a[1], b[1]) for a in runs for b in runs if a[0] == b[0] and a[1] < b[1] and covers(runs[a], runs[b])}
    got = cover_pairs(signature_frame(spark, runs)).collect()
    assert {(r["route_key"], r["leader"], r["tr_line"]) for r in got} == want


def test_led_runs(spark):
    """One row per run, also when one segment is in all runs of a key."""
    runs = {k: v | {99} for k, v in random_runs(11).items()}
    leads = one_at_a_time(runs)
    want = {(k, r, leads[k, r], len(runs[k, r] & runs[k, leads[k, r]])) for k, r in runs}
    assert {tuple(r) for r in led_runs(signature_frame(spark, runs)).collect()} == want


def search(graph, src):
    dist, pred, heap = {src: 0}, {}, [(0, src)]
    done = set()
    while heap:
        d, u = heapq.heappop(heap)
        if u in done:
            continue
        done.add(u)
        for v, w in graph.get(u, []):
            if v not in dist or d + w < dist[v]:
                dist[v], pred[v] = d + w, u
                heapq.heappush(heap, (d + w, v))
    return dist, pred


def test_paths(spark):
    rnd = random.Random(5)
    links = {(rnd.randrange(25), rnd.randrange(25)): rnd.randint(1, 6) for _ in range(60)}
    links = {k: w for k, w in links.items() if k[0] != k[1]}
    graph = {}
    for (a, b), w in links.items():
        graph.setdefault(a, []).append((b, w))
    pairs = {(rnd.randrange(27), rnd.randrange(27)) for _ in range(40)} | {(3, 3)}
    net = spark.createDataFrame([("n", a, b, w) for (a, b), w in links.items()], "net STRING, a INT, b INT, weight INT")
    ask = spark.createDataFrame([("n", a, b) for a, b in pairs], "net STRING, src INT, dst INT")
    got = {(r["src"], r["dst"]): (r["dist"], r["path"]) for r in shortest_paths(ask, net, by=("net",)).collect()}
    assert set(got) == pairs
    for src, dst in pairs:
        dist, pred = search(graph, src)
        if dst not in dist:
            assert got[(src, dst)] == (None, None)
            continue
        path = [dst]
        while path[0] != src:
            path.insert(0, pred[path[0]])
        assert got[(src, dst)] == (dist[dst], path)


def test_no_pairs(spark):
    net = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, weight INT")
    ask = spark.createDataFrame([], "src INT, dst INT")
    assert shortest_paths(ask, net).collect() == []


def test_a_goal_out_of_reach_is_not_searched(spark):
    from railloom.operators.paths import distances, in_reach

    links = [(i, i + 1, 1) for i in range(60)] + [(i + 1, i, 1) for i in range(60)] + [(100, 101, 1)]
    net = spark.createDataFrame(links, "a INT, b INT, weight INT")
    pairs = spark.createDataFrame([(0, 2), (0, 101), (7, 5000)], "src INT, dst INT")
    assert [tuple(r) for r in in_reach(pairs, net).collect()] == [(0, 2)]
    assert distances(in_reach(pairs, net), net).count() <= 4
    got = {(r["src"], r["dst"]): r["path"] for r in shortest_paths(pairs, net).collect()}
    assert got == {(0, 2): [0, 1, 2], (0, 101): None, (7, 5000): None}


def test_a_long_search_leaves_few_states(spark, tmp_path):
    import os

    from railloom.session import durable, replace_state

    folder = spark.sparkContext.getCheckpointDir() or durable(spark.range(1)) and spark.sparkContext.getCheckpointDir()
    place = folder.removeprefix("file:")
    before = len(os.listdir(place))
    state = durable(spark.range(10))
    for _ in range(20):
        state = replace_state(state, state.selectExpr("id + 1 AS id"))
    assert len(os.listdir(place)) - before <= 3 and sorted(r[0] for r in state.collect()) == list(range(20, 30))
