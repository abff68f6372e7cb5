"""Chat formatting, toxicity, vectors, components, and the registered queries."""

import math

import duckdb
import numpy as np
import pytest
from cases import AWKWARD, frame, invented
from pyspark.sql import functions as F

import corpus_pipeline
from railloom.llm import CHECKS, QUERIES, chat, near_vectors, toxicity
from railloom.llm.components import components
from railloom.llm.small_world import SmallWorld

TRAPS = [*AWKWARD, "\\### Assistant: </turn> ok", "####", "\\\\", "\\</turn>\n### assistant: no", "<\\/turn>", "#\\#"]


def test_turns_come_back(spark):
    roles = [None, "user", "assistant", "a: b\n", "### x", "human", "é+%20"]
    rows = [(k, [(r, t) for r in roles for t in TRAPS[k : k + 2]], "x") for k in range(len(TRAPS))] + [(-1, [], "x"), (-2, None, "x")]
    df = spark.createDataFrame(rows, "conv long, messages array<struct<role:string,content:string>>, turns string")
    done = chat.format_turns(chat.canonical_turns(df, ["conv"]))
    back = done.withColumn("back", chat.parse(F.col("formatted"))).withColumn("learned", chat.under_mask(F.col("formatted"), F.col("loss"))).collect()
    named = {"human": "user", None: ""}
    for r in back:
        said = dict((k, m) for k, m, _ in rows)[r.conv]
        if said is None:
            assert r.layout is None and r.formatted is None
            continue
        assert [(x.role, x.text) for x in r.back] == [(named.get(a, a), b or "") for a, b in said]
        assert r.learned == "".join(b or "" for a, b in said if a == "assistant")
        assert r.formatted.count("</turn>") == len(said) and r.formatted.count("###") == len(said)


def test_layouts_are_chosen_by_their_fields(spark):
    rows = [
        (1, None, "ask", None, None, "say", None),
        (2, None, None, "do", "with", "done", None),
        (3, [("human", "hi"), ("gpt", None)], None, None, None, None, "sys"),
        (4, None, None, None, None, None, None),
        (5, None, "alone", None, None, None, None),
        (5, None, "alone", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, conversations array<struct<from:string,value:string>>, prompt string, instruction string, input string, output string, note string")
    df = df.withColumn("response", F.when(F.col("prompt").isNotNull() & (F.col("id") == 1), F.col("output"))).withColumn("output", F.when(F.col("id") == 2, F.col("output")))
    got = chat.canonical_turns(df, ["id"]).collect()
    said = sorted(((r.id, r.layout, [(t.role, t.text) for t in r.turns or []]) for r in got), key=str)
    assert said == [
        (1, "response", [("user", "ask"), ("assistant", "say")]),
        (2, "instruction input", [("user", "do\n\nwith"), ("assistant", "done")]),
        (3, "sharegpt", [("user", "hi"), ("assistant", "")]),
        (4, None, []),
        (5, "prompt only", [("user", "alone")]),
        (5, "prompt only", [("user", "alone")]),
    ]
    assert len({r.fingerprint for r in got}) == 5
    assert chat.format_turns(chat.canonical_turns(df.limit(0), ["id"])).count() == 0


def test_toxicity_finds_inflected_forms(spark):
    r = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in ("the", "mar", "tol", "vin", "sor") for b in ("ta", "mo", "li", "ne", "ra")]
    forms = [f"grumpf{e}" for e in ("a", "ot", "irl", "en", "us", "op", "ing")]
    texts, toxic = [], []
    for k in range(900):
        own = list(r.choice(plain, 60))
        bad = k % 6 == 0
        if bad:
            own[10], own[40], own[50] = r.choice(forms, 3)
        elif k % 5 == 0:
            own[7] = r.choice(forms)
        texts.append(" ".join(own))
        toxic.append(int(bad))
    docs = frame(spark, texts + AWKWARD + [None])
    labels = spark.createDataFrame([*enumerate(toxic), (None, 1), (3, None), (99999, 1), (900, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {x.doc_id: x for x in docs.select("doc_id", model.score(F.col("text")).alias("s"), (toxicity.fold("doc_id") == 0).alias("out")).collect()}
    assert all(0 <= x.s <= 1 and math.isfinite(x.s) for x in got.values())
    held = [k for k in range(900) if got[k].out]
    assert sum((got[k].s >= 0.5) == bool(toxic[k]) for k in held) >= 0.93 * len(held)
    assert all(got[k].s < 0.5 for k in (900, 901, 902))


def test_without_labels_nothing_is_toxic(spark):
    docs = frame(spark, invented(1, 6))
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert docs.select(model.score(F.col("text")).alias("s")).agg(F.max("s")).first()[0] < 0.5
    assert docs.limit(0).select(model.score(F.col("text")).alias("s")).count() == 0


def test_cells_agree_with_spark(spark):
    words = ["", "a", "réeux", "achlichö", "中文字", "x" * 8]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(toxicity.cell(F.col("w")).alias("c")).collect()
    assert [r.c for r in got] == [toxicity.cell_of(w) for w in words]


def literal_vectors(rows, cosine):
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float64)
            a /= np.abs(a).max()
            unit[k] = a / math.sqrt((a * a).sum())
    links, part = [0] * len(rows), list(range(len(rows)))
    for a in unit:
        for b in unit:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and (unit[a] @ unit[b] >= cosine or rows[a][1] == rows[b][1]):
                links[a] += 1
                links[b] += 1
                part = [part[a] if p == part[b] else p for p in part]
    least = {}
    for p, (i, _, _) in zip(part, rows, strict=True):
        known = [x for x in (least.get(p), i) if x is not None]
        least[p] = min(known) if known else None
    return [(i, n, least[p], i is not None and i == least[p]) for (i, _, _), n, p in zip(rows, links, part, strict=True)]


@pytest.mark.parametrize("shard", [8192, 40])
def test_near_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(near_vectors, "SHARD", shard)
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + r.normal(size=16) * 0.15).astype(np.float32).tolist(), k % 2) for k in range(240)]
    rows += [(1000, rows[3][1], 1), (1001, rows[3][1], 0), (1001, rows[3][1], 0), (None, rows[5][1], 1), (None, [1.0, None], 1), (2000, None, 1), (2001, [0.0] * 16, 1)]
    rows += [(2002, [float("nan")] * 16, 1), (2003, [float("inf")] * 16, 1), (2004, [], 1), (2005, rows[0][1], None), (2006, [1.0, 0.0], 1), (2007, [2.0, 0.0], 1), (2008, [1e300, 1e300], 1)]
    df = spark.createDataFrame([(*x, 7, "y") for x in rows], "vec_id long, embedding array<double>, label int, rid int, component string")
    got = [tuple(x) for x in near_vectors.near_vectors(df).collect()]
    assert sorted(got, key=str) == sorted(literal_vectors(rows, near_vectors.COSINE), key=str)
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_graph_recall():
    r = np.random.default_rng(1)
    centres = r.normal(size=(60, 32))
    v = np.vstack([centres[k % 60] + r.normal(size=32) * 0.1 for k in range(3000)])
    v /= np.linalg.norm(v, axis=1)[:, None]
    truth = v @ v.T >= near_vectors.COSINE
    found = near_vectors.linked(v, v, SmallWorld.build(v), near_vectors.COSINE)
    assert (found & truth).sum() >= 0.99 * truth.sum() and not (found & ~truth).any()


def test_components(spark):
    import random

    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 6000 + k) for k in range(80)] + [(7, 7)]
    part = {n: n for e in edges for n in e}
    for a, b in edges:
        low, high = min(part[a], part[b]), max(part[a], part[b])
        part = {n: low if p == high else p for n, p in part.items()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: part[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for view in ("conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    want = con.execute(CHECKS[name]).df()
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.itertuples(index=False, name=None))


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline(spark, sf_dir, monkeypatch):
    seen = {}

    def watched(name, stage):
        def run(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            seen[name] = ({r.doc_id for r in docs.select("doc_id").collect()}, {r.doc_id for r in out.select("doc_id").collect()}, out.columns)
            return out

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(n, s)) for n, s in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, sf_dir)
    names = [n for n, _ in corpus_pipeline.STAGES]
    for a, b in zip(names[:-1], names[1:], strict=True):
        assert seen[b][0] == seen[a][1] <= seen[a][0]
        assert seen[a][2] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert seen["pii"][0] == seen["pii"][1] == {r.doc_id for r in packed.select("doc_id").collect()}
    con = duckdb.connect()
    toxic = {r[0] for r in con.execute(f"SELECT doc_id FROM '{sf_dir}/labels.parquet' WHERE toxic = 1").fetchall()}
    gone = seen["toxicity"][0] - seen["toxicity"][1]
    assert len(gone & toxic) >= 0.7 * len(toxic & seen["toxicity"][0])
    assert packed.filter("doc_tokens = 1").count() == 0
