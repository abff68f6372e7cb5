"""Toxicity models: contexts stay apart, whole words and pairs count, the join and the column agree."""

import os

import numpy as np
import pytest
from cases import AWKWARD, frame
from pyspark.sql import functions as F

from railloom.llm import toxicity
from railloom.llm.common import keyed, settled, shared_folder

BAD, FINE = "understandzzq", "understandmmo"  # alike for more than eight letters


@pytest.fixture(scope="module")
def texts():
    r = np.random.default_rng(3)
    plain = [f"{a}{b}" for a in ("the", "mar", "tol", "vin") for b in ("ta", "mo", "li", "ne")]
    out = []
    for k in range(900):
        own = list(r.choice(plain, 40))
        if k % 4 == 0:  # toxic: a word, or two ordinary words one behind the other
            own[5:8] = [BAD] * 3 if k % 8 else ["black", "crow", "black"]
            own[20:23] = [BAD] * 3 if k % 8 else ["crow", "black", "crow"]
        elif k % 2:
            own[5:8], own[20:23] = [FINE] * 3, ["black", "marta", "black"]
            own[30:33] = ["crow", "thene", "crow"]
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def model(spark, texts):
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(len(texts))], "doc_id long, toxic int")
    return toxicity.train(frame(spark, texts), labels)


def scores(spark, model, texts):
    return [r.s for r in frame(spark, texts).select(model.score(F.col("text")).alias("s")).collect()]


def test_words_alike_for_eight_letters_are_told_apart(spark, model):
    bad, fine = scores(spark, model, [" ".join(["marta", w, "tolmo"] * 6) for w in (BAD, FINE)])
    assert bad >= 0.5 > fine


def test_phrases_of_ordinary_words_are_told_apart(spark, model):
    bad, fine = scores(spark, model, ["marta " + "black crow " * 6 + "tolmo", "marta " + "black marta crow thene " * 6 + "tolmo"])
    assert bad >= 0.5 > fine


def test_contexts_that_share_a_cell_stay_apart(spark, model):
    known = {toxicity.cell_of(w[:k]) for w in (BAD, FINE, "black", "crow") for k in range(1, 9)}
    strange = [c for c in map(chr, range(0x3400, 0xD7A4)) if c.isalnum() and c.lower() == c]
    same = next(a + b for a in strange for b in strange[:200] if toxicity.cell_of(a + b) in known or toxicity.cell_of(a) in known)
    none, met, other = scores(spark, model, ["", same, "㐁㐂"])
    assert none == met == other


def test_shorter_contexts_are_distributions(spark):
    words = spark.createDataFrame([("stone",), ("tone",), ("on",), ("bones",)], "word string")
    p = toxicity.shorter(toxicity.steps_of(words).distinct())
    sums = {r.context: r.s for r in p.groupBy("context").agg(F.sum("p").alias("s")).collect()}
    assert all(0 < s <= 1 + 1e-9 for s in sums.values()) and {len(c) for c in sums} >= {toxicity.LOWER}


@pytest.mark.parametrize("common", [0, 10])
def test_join_and_column_agree(spark, texts, monkeypatch, common):
    monkeypatch.setattr(toxicity, "COMMON", common)
    some = [*texts[:300], *AWKWARD, *AWKWARD[:3], "understandzz understandmmox zzz " * 3]
    docs = frame(spark, some, [None, *range(1, len(some) - 1), 5])
    model = toxicity.train(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)], "doc_id long, toxic int"))
    stored = docs.localCheckpoint()
    want = {r.rid: r.s for r in keyed(stored, text="text").select("rid", model.score(F.col("text")).alias("s")).collect()}
    got = {r.rid: r.score for r in model.scored(keyed(stored, text="text")).collect()}
    assert got.keys() == want.keys() and len(got) == len(some)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert len({round(x, 6) for x in got.values()}) > 10
    assert model.scored(keyed(stored.limit(0), text="text")).count() == 0


ODD = [*AWKWARD, "x" * 200 + " " + "é" * 64 + "y", "İstanbul ΑΣ ΑΣ. ²½ ⅷ a_b", "", "the end the end"]


@pytest.mark.parametrize("block", [1 << 22, 50])
def test_words_of_texts_are_their_tokens(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    got, hashes = [[] for _ in ODD], {}
    for found in toxicity.words_of(ODD):
        for text, word, h in zip(found.text.tolist(), found.spelt(np.arange(len(found.text))), found.hash.tolist(), strict=True):
            got[text].append(word)
            assert hashes.setdefault(h, word) == word
    assert got == [toxicity.tokens_of(t) for t in ODD] and len(set(hashes.values())) == len(hashes)


def test_places_hold_each_key_once(monkeypatch):
    monkeypatch.setattr(toxicity, "SLOTS", np.uint64(3))
    keys = np.random.default_rng(1).integers(0, 40, 500, dtype=np.uint64)
    assert sorted(keys[toxicity._places(keys)].tolist()) == np.unique(keys).tolist()


def test_only_the_model_stays_on_disk(spark, texts):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)], "doc_id long, toxic int")
    toxicity.train(frame(spark, texts[:300]), labels)
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert not left & {"grams", "letters", "labelled", "heads", "new", "known", "fit"}


def test_chunks_of_a_few_rows_in_many_buckets_give_the_same(spark, texts, model, monkeypatch):
    stored = frame(spark, [*texts[:40], *ODD]).localCheckpoint()
    want = {r.rid: r.s for r in keyed(stored, text="text").select("rid", model.score(F.col("text")).alias("s")).collect()}
    monkeypatch.setattr(toxicity, "CHUNK", 1)
    monkeypatch.setattr(toxicity, "ROOM", 50)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(len(texts))], "doc_id long, toxic int")
    small = toxicity.train(frame(spark, texts), labels)
    got = {r.rid: r.score for r in small.scored(keyed(stored, text="text")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_rows_are_judged_as_by_the_trained_model(spark, texts, monkeypatch):
    monkeypatch.setattr(toxicity, "ROOM", 50)
    monkeypatch.setattr(toxicity, "CHUNK", 5)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(len(texts))], "doc_id long, toxic int")
    docs = settled(frame(spark, [*texts, *ODD, "und undxx un underzzq u"]))
    model = toxicity.train(docs, labels)
    want = {r.rid: r.s for r in keyed(docs, text="text").select("rid", model.score(F.col("text")).alias("s")).collect()}
    got = {r.rid: r.score for r in toxicity.judged(docs, labels).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_words_meet_their_beginnings_in_their_bucket():
    words = ["a", "ab", "abc", "abcd", "abcde", "中文", "é"]
    for buckets in (1, 3, 100):
        for found in toxicity.words_of(words):
            for word, own in zip(words, found.buckets(np.arange(len(words)), buckets).tolist(), strict=True):
                start = (word + toxicity.END)[: toxicity.CROWN]
                assert all(own in toxicity.homes(start[:k], buckets) for k in range(1, len(start) + 1))
                assert len(toxicity.homes(start, buckets)) == 1
    assert len(toxicity.homes("ab", 1000)) <= toxicity.SPLITS
