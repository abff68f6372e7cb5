"""Tables of loops in the shared folder: states that are replaced, and waves that are only added to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, swept


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str = "state", **metrics) -> DataFrame:
    """Written once and read back: no lineage, and a known size, so that Spark itself chooses how to join it.

    `metrics` are aggregates taken while the rows are written; they are in `.seen` of the result.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    seen = Observation() if metrics else None
    rows = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if metrics else df
    with swept(spark):
        rows.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path, out.seen = path, seen.get if seen else {}
    return out


def forget(*frames: DataFrame) -> None:
    """Delete stored frames that nothing reads any more."""
    for df in frames:
        _delete(df.sparkSession, df.stored_path)


class WaveStore:
    """Rows under a key, added wave by wave. No wave is written twice.

    Waves are partitions of one table that is bucketed by the key like a shuffle, so that what is joined to the store by the key is
    shuffled and the store is not.
    """

    def __init__(self, spark: SparkSession, key: Sequence[str], name: str = "waves"):
        self.spark, self.key = spark, list(key)
        self.table = f"{name}_{uuid.uuid4().hex}"
        self.path = f"{shared_folder(spark)}/{self.table}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.waves = 0
        self.seen: dict = {}

    def append(self, rows: DataFrame, **metrics) -> dict:
        """Add a wave; `metrics` are aggregates taken while it is written.

        The number of the wave is text: Spark writes numbers into the code it generates, and would compile every wave's code anew.
        """
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
        out = counted.withColumn("wave", F.lit(str(self.waves))).write.mode("append").format("parquet").option("path", self.path)
        out = out.partitionBy("wave").bucketBy(self.buckets, *self.key).sortBy(*self.key)
        with swept(self.spark):
            out.saveAsTable(self.table)
        self.waves += 1
        self.seen = seen.get
        return self.seen

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def wave(self, n: int) -> DataFrame:
        return self.rows().filter(F.col("wave") == str(n)).drop("wave")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        _delete(self.spark, self.path)
