"""Ordered scans inside a key: numbering, running sums, neighbours, group edges.

A window partition is one task. A scheduled run has some hundred segments at most, so a run is one
window unless the caller passes a bucket length; the plan never depends on how many rows there are.
With a length, runs are cut into order-preserving buckets, each scanned on its own and then shifted by
what the buckets before it hold, which is one row per bucket. Keys that can be huge (line prefixes,
groups, stations) go through `cut_by_range` instead.

Fractions are added up as whole numbers of 1e-8, so neither buckets nor the order of adding change a sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BK = "_bucket"
_UNIT = 1e8


@dataclass(frozen=True)
class RunLayout:
    """`rows` is the bucket length of runs, None for one window per run."""

    rows: int | None = None

    def bucket(self, position: str | Column) -> Column | None:
        if self.rows is None:
            return None
        col = F.col(position) if isinstance(position, str) else position
        return F.floor(col / F.lit(self.rows))


RUNS = RunLayout()


def _fractions(df: DataFrame, sums: Mapping[str, Column]) -> set[str]:
    """Names of the sums over fractional columns."""
    if not sums:
        return set()
    kinds = df.select(*[c.alias(n) for n, c in sums.items()]).dtypes
    return {n for n, kind in kinds if kind in ("double", "float")}


def scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    bucket: Column | None = None,
    number: str | None = None,
    first: str | None = None,
    last: str | None = None,
    size: str | None = None,
    running: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ordered columns per key.

    number   1..n position            running  inclusive running sum
    first    true on the first row    total    sum over the whole key
    last     true on the last row     lag/lead value on the previous/next row
    size     rows of the key          carry    latest non-null value up to the row

    `bucket` must not decrease along `order`; None scans each key as one window partition.
    """
    running, total = dict(running or {}), dict(total or {})
    lag, lead, carry = dict(lag or {}), dict(lead or {}), dict(carry or {})
    by, order = list(by), list(order)
    whole_numbers = _fractions(df, {**running, **total})

    def units(name: str, c: Column) -> Column:
        return F.round(c * _UNIT).cast("long") if name in whole_numbers else c

    def value(name: str, c: Column) -> Column:
        return c / _UNIT if name in whole_numbers else c

    running = {n: units(n, c) for n, c in running.items()}
    total = {n: units(n, c) for n, c in total.items()}

    if bucket is None:
        w = W.partitionBy(*by).orderBy(*order)
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        whole = W.partitionBy(*by)
        out: dict[str, Column] = {}
        if number:
            out[number] = F.row_number().over(w)
        if first:
            out[first] = F.row_number().over(w) == 1
        if last:
            out[last] = F.lead(F.lit(1)).over(w).isNull()
        if size:
            out[size] = F.count(F.lit(1)).over(whole)
        out.update({n: value(n, F.sum(c).over(upto)) for n, c in running.items()})
        out.update({n: value(n, F.sum(c).over(whole)) for n, c in total.items()})
        out.update({n: F.lag(c).over(w) for n, c in lag.items()})
        out.update({n: F.lead(c).over(w) for n, c in lead.items()})
        out.update({n: F.last(c, ignorenulls=True).over(upto) for n, c in carry.items()})
        return df.withColumns(out)

    cut = df.withColumn(_BK, bucket)
    at = F.struct(*[F.col(c) for c in order])
    stats = [F.count(F.lit(1)).alias("_n")]
    stats += [F.sum(c).alias(f"_rs_{n}") for n, c in {**running, **total}.items()]
    stats += [F.max_by(c, at).alias(f"_lg_{n}") for n, c in lag.items()]
    stats += [F.min_by(c, at).alias(f"_ld_{n}") for n, c in lead.items()]
    stats += [F.max_by(c, F.when(c.isNotNull(), at)).alias(f"_cy_{n}") for n, c in carry.items()]
    e = W.partitionBy(*by).orderBy(_BK)
    before = e.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    edge_cols = {
        "_e_n": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_e_size": F.sum("_n").over(whole),
        "_e_first": F.lag(F.lit(1)).over(e).isNull(),
        "_e_last": F.lead(F.lit(1)).over(e).isNull(),
    }
    edge_cols.update({f"_e_rs_{n}": F.sum(f"_rs_{n}").over(before) for n in running})
    edge_cols.update({f"_e_tt_{n}": F.sum(f"_rs_{n}").over(whole) for n in total})
    edge_cols.update({f"_e_lg_{n}": F.lag(f"_lg_{n}").over(e) for n in lag})
    edge_cols.update({f"_e_ld_{n}": F.lead(f"_ld_{n}").over(e) for n in lead})
    edge_cols.update({f"_e_cy_{n}": F.last(f"_cy_{n}", ignorenulls=True).over(before) for n in carry})
    edges = cut.groupBy(*by, _BK).agg(*stats).withColumns(edge_cols)
    edges = edges.select(*by, _BK, *edge_cols)

    w = W.partitionBy(*by, _BK).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = {"_l_n": F.row_number().over(w), "_l_end": F.lead(F.lit(1)).over(w).isNull()}
    local.update({f"_l_rs_{n}": F.sum(c).over(upto) for n, c in running.items()})
    local.update({f"_l_lg_{n}": F.lag(c).over(w) for n, c in lag.items()})
    local.update({f"_l_ld_{n}": F.lead(c).over(w) for n, c in lead.items()})
    local.update({f"_l_cy_{n}": F.last(c, ignorenulls=True).over(upto) for n, c in carry.items()})
    joined = cut.withColumns(local).join(edges, [*by, _BK], "left")

    out = {}
    if number:
        out[number] = (F.col("_l_n") + F.col("_e_n")).cast("int")
    if first:
        out[first] = (F.col("_l_n") == 1) & F.col("_e_first")
    if last:
        out[last] = F.col("_l_end") & F.col("_e_last")
    if size:
        out[size] = F.col("_e_size")
    for n in running:
        both = F.coalesce(F.col(f"_l_rs_{n}"), F.col(f"_e_rs_{n}"))
        out[n] = value(n, F.coalesce(F.col(f"_l_rs_{n}") + F.col(f"_e_rs_{n}"), both))
    for n in total:
        out[n] = value(n, F.col(f"_e_tt_{n}"))
    for n in lag:
        out[n] = F.when(F.col("_l_n") == 1, F.col(f"_e_lg_{n}")).otherwise(F.col(f"_l_lg_{n}"))
    for n in lead:
        out[n] = F.when(F.col("_l_end"), F.col(f"_e_ld_{n}")).otherwise(F.col(f"_l_ld_{n}"))
    for n in carry:
        out[n] = F.coalesce(F.col(f"_l_cy_{n}"), F.col(f"_e_cy_{n}"))
    joined = joined.withColumns(out)
    keep = [c for c in df.columns if c not in out] + list(out)
    return joined.select(*keep)
