"""Row numbers stay with their rows when Spark splits the files in another way between two reads."""

import contextlib

import pytest
from cases import frame, invented
from pyspark.sql import functions as F

from railloom.llm import chat, near_vectors, ngram_join, pii, repeats
from railloom.llm.common import keyed, numbered, settled

SPLITS = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@contextlib.contextmanager
def split(spark, *values):
    for key, value in zip(SPLITS, values, strict=True):
        spark.conf.set(key, value)
    yield
    for key in SPLITS:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    texts = invented() + [None, "", "mail a@b.org or c@d.org", "mail a@b.org once more"] * 2
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    frame(spark, texts, [None, *range(1, len(texts) - 1), 5]).repartition(9).write.parquet(path)
    return spark.read.parquet(path)


def numbers(docs):
    return sorted(tuple(r) for r in keyed(docs, doc_id="doc_id", text="text").collect())


def test_numbers_do_not_depend_on_splits(spark, stored):
    with split(spark, "1", "64m", "4m"):
        one = numbers(stored)
        parts = stored.select("doc_id").rdd.getNumPartitions()
    with split(spark, "8", "1k", "0"):
        many = numbers(stored)
        assert stored.select("doc_id").rdd.getNumPartitions() > parts
    assert one == many and len({r[0] for r in one}) == stored.count()


def test_names_that_clash(spark, stored):
    clash = settled(stored.withColumns({n: F.lit(1) for n in ("_file", "_at", "_base", "rid", "_metadata")}))
    got = numbered(clash, "n")
    assert got.columns == [*clash.columns, "n"] and got.select("n").distinct().count() == stored.count()


def run(name, docs):
    if name == "copies":
        return ngram_join.one_of_each(docs).drop("ids")
    if name == "private":
        return pii.sanitise(docs).drop("ids")
    return repeats.remove_repeats(docs).select("doc_id", "n_bytes", F.size("spans"))


@pytest.mark.parametrize("name", ["copies", "private", "repeats"])
def test_operators_keep_their_rows(spark, stored, name):
    with split(spark, "1", "64m", "4m"):
        want = sorted((tuple(r) for r in run(name, stored).collect()), key=repr)
        lazy = run(name, stored)  # stages stored so far; the rest is read with other splits
    with split(spark, "8", "1k", "0"):
        assert sorted((tuple(r) for r in lazy.collect()), key=repr) == want


def test_vectors_keep_their_rows(spark, tmp_path):
    rows = [(i, [1.0, float(i % 7), 0.1 * (i % 3)], i % 2) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(6).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    with split(spark, "1", "64m", "4m"):
        lazy = near_vectors.near_vectors(stored)
        want = sorted(tuple(r) for r in lazy.collect())
    with split(spark, "8", "1k", "0"):
        assert sorted(tuple(r) for r in lazy.select("*").collect()) == want
        assert sorted(tuple(r) for r in near_vectors.near_vectors(stored).collect()) == want


def test_roles_of_messages_stay(spark):
    said = spark.createDataFrame([(1, [("human", "a"), ("gpt", "b"), ("bot", None)])], "id INT, messages ARRAY<STRUCT<role STRING, content STRING>>")
    turns = chat.canonical_turns(said, ["id"]).first()["turns"]
    assert [tuple(t) for t in turns] == [("human", "a"), ("gpt", "b"), ("bot", "")]
    shared = spark.createDataFrame([(1, [("human", "a"), ("gpt", "b")])], "id INT, conversations ARRAY<STRUCT<from STRING, value STRING>>")
    assert [t["role"] for t in chat.canonical_turns(shared, ["id"]).first()["turns"]] == ["user", "assistant"]
