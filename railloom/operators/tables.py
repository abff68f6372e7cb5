"""Table-level operators: keyed choice, semi/anti splits, upsert, row doubling, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the lowest `order` of each key, with partial results before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    # The remaining columns end the order, so that equal positions do not depend on the input split.
    at = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), at).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the old rows of every key that comes again, then add the new rows."""
    return union_all(old.join(new.select(*keys).distinct(), list(keys), "left_anti"), new)


def reconcile(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of `left` whose key is on both sides, and the keys found on one side only."""
    key = [key] if isinstance(key, str) else list(key)
    lk, rk = left.select(*key).distinct(), right.select(*key).distinct()
    good = left.join(rk, key, "left_semi")
    only = lk.join(rk, key, "left_anti").withColumn("side", F.lit("left"))
    only = only.unionByName(rk.join(lk, key, "left_anti").withColumn("side", F.lit("right")))
    return good, only


def rows_from(df: DataFrame, *variants: dict[str, Column | str]) -> DataFrame:
    """One output row per variant; a variant maps output columns to expressions over the input row."""
    names = list(variants[0])
    structs = [F.struct(*[(F.col(v[n]) if isinstance(v[n], str) else v[n]).alias(n) for n in names]) for v in variants]
    keep = [c for c in df.columns if c not in names]
    return df.select(*keep, F.explode(F.array(*structs)).alias("_v")).select(*keep, *[f"_v.{n}" for n in names])


def require_same_schema(have: DataFrame, add: DataFrame) -> None:
    """The append test: names and types must agree in any order."""
    a = {f.name: f.dataType for f in have.schema.fields}
    b = {f.name: f.dataType for f in add.schema.fields}
    if a != b:
        diff = sorted(set(a.items()) ^ set(b.items()), key=str)
        raise ValueError(f"schemas differ: {diff}")


def cut_by_range(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, Column]:
    """Prepare a scan over few, possibly huge keys.

    Rows are range partitioned on key and order and written out once, so that the partition number is a
    stable, order-preserving bucket and no task needs to hold a whole key.
    """
    cut = durable(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    return cut, F.col("_range")
