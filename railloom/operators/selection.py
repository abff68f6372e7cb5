"""Projection and row selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import PEAK_END, PEAK_START, le_missing

# The former eight periods (tod, first hour, hour after the last, minutes).
EIGHT_PERIODS = (
    (1, 20, 6, 600), (2, 6, 7, 60), (3, 7, 9, 120), (4, 9, 10, 60),
    (5, 10, 14, 240), (6, 14, 16, 120), (7, 16, 18, 120), (8, 18, 20, 120),
)


def pick(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep, rename and order columns."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def in_am_peak(dep: str = "dep_time", arr: str = "arr_time") -> Column:
    return (F.col(dep) >= PEAK_START) & le_missing(arr, PEAK_END)


def route_rows(df: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str, name: str = "kind") -> DataFrame:
    """Tag each row with the first rule that holds; branches are filters on the tag."""
    (k0, c0), *rest = rules
    tag = reduce(lambda acc, r: acc.when(r[1], r[0]), rest, F.when(c0, k0)).otherwise(otherwise)
    return df.withColumn(name, tag)


def select_any(df: DataFrame, *predicates: Column) -> DataFrame:
    """Start with the first selection and add the rows of the others."""
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(p, F.lit(False)) for p in predicates]))


def narrow_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns(
        {"pspace": F.col("pspace").try_cast("smallint"), "pcost": F.col("pcost").try_cast("smallint"),
         "label": F.col("label").cast("string")}
    )


def with_feed_constants(runs: DataFrame) -> DataFrame:
    return runs.withColumns(
        {"headway": F.lit(99), "veh_type": F.when(F.col("mode") == "C", 7).otherwise(8), "imputed": F.lit(0)}
    )
