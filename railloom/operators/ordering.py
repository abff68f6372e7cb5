"""Global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import durable


def sorted_positions(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """1..n position of every row in a global order.

    The sorted copy is written once; its partitions are then stable, each is numbered on its own and
    shifted by the sizes of those before it.
    """
    part = durable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = part.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rank = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    out = part.withColumn("_r", rank).join(starts, "_part")
    return out.withColumn(name, F.col("_r") + F.col("_off")).drop("_part", "_r", "_off")
