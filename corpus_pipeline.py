"""Corpus preparation: drop toxic documents, keep one of each group of near duplicates, drop benchmark leaks, sanitise personal
data, pack what is left into sequences.

Each stage is a job of its own over all its predecessor kept. `run` writes each stage's result to the shared folder and reads it
again, so that a lost executor costs no earlier stage. Stages take and return the columns of `documents`, whatever else these hold;
null and empty texts pass every filter (they hold nothing to object to) and are packed as an end id alone. An empty table stays
empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railloom.llm.common import fresh, numbered, settled, stash, table
from railloom.llm.decontamination import clean
from railloom.llm.ngram_join import one_of_each
from railloom.llm.packing import pack
from railloom.llm.pii import sanitise
from railloom.llm.toxicity import judged

TOXIC = 0.5  # documents with this score or more go


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Score every text by models fitted on the labelled documents (9); toxic ones go."""
    docs = settled(docs)
    rid = fresh(docs, "rid")
    toxic = judged(docs, table(spark, sf_dir, "labels")).filter(F.col("score") >= TOXIC).select(F.col("rid").alias(rid))
    return numbered(docs, rid).join(toxic, rid, "left_anti").drop(rid)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word shingles (1) the one of least id stays."""
    return one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget (8) go."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it (6) are replaced in the texts."""
    return sanitise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their ids (10)."""
    return pack(docs, added=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]
# Tokens and trained scores are beyond SQL; tests/llm compares each stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
