"""Writers: keyed tables, partitioned text files, CSV reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table; with partition columns only the partitions that come again are replaced."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append after comparing names and types with the stored table."""
    from ..operators.tables import require_same_schema

    require_same_schema(df.sparkSession.read.parquet(path), df)
    df.write.mode("append").parquet(path)


def write_text(df: DataFrame, path: str, order: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Write column `line` in order: part files of a folder follow each other when read by name."""
    keys = [*partition_by, *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = ranged.select(*partition_by, "line").write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, order: Sequence[str] = (), sep: str = ",") -> None:
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def with_header(body: DataFrame, header: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Header rows (by.., no, line) in front of the body of their partition."""
    first = header.withColumn("_sec", F.lit(0)).withColumnRenamed("no", "_no")
    rest = body.withColumns({"_sec": F.lit(1), "_no": F.lit(0)})
    return first.unionByName(rest, allowMissingColumns=True).select(*by, "_sec", "_no", *order, "line")
