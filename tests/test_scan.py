"""The bucketed scan must equal the plain window, also when one key holds most rows."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from railloom.operators.sequence import RunLayout, scan
from railloom.operators.tables import cut_by_range


def frame(spark, seed):
    rnd = random.Random(seed)
    data = []
    for key in ("a", "b", "c"):
        n = 200 if key == "a" else rnd.randint(1, 9)
        for i in rng(rnd, n):
            data.append((key, i, rnd.choice([None, 1, 2, 3]), float(rnd.randint(0, 50)) / 10))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k STRING, o INT, v INT, x DOUBLE")


def rng(rnd, n):
    return sorted(rnd.sample(range(1, 3 * n + 1), n))


def outputs():
    return dict(
        number="n", first="f", last="l", size="s", running={"r": F.col("v")}, total={"t": F.col("x")},
        lag={"p": F.col("v")}, lead={"q": F.col("v")}, carry={"c": F.col("v")},
    )


def rounded(df):
    return rows(df.select("k", "o", "v", "x", *"nflsrtpqc"))  # sums too are equal to the last bit


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_buckets_equal_plain(spark, size, seed):
    df = frame(spark, seed)
    plain = scan(df, ["k"], ["o"], **outputs())
    cut = scan(df, ["k"], ["o"], bucket=RunLayout(size).bucket("o"), **outputs())
    assert rounded(plain) == rounded(cut)


def test_range_cut_equals_plain(spark):
    df = frame(spark, 3)
    plain = scan(df, ["k"], ["o"], **outputs())
    ranged, bucket = cut_by_range(df.repartition(7), ["k"], ["o"])
    assert rounded(plain) == rounded(scan(ranged, ["k"], ["o"], bucket=bucket, **outputs()))


def test_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([("a", i, 0.1 * (i % 7)) for i in range(500)], "k STRING, o INT, x DOUBLE")
    plans = [scan(df.repartition(p), ["k"], ["o"], bucket=b, running={"r": F.col("x")}) for p, b in ((1, None), (5, None), (3, RunLayout(11).bucket("o")))]
    assert rows(plans[0]) == rows(plans[1]) == rows(plans[2])
