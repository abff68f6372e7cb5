"""Operators over ordered itinerary segments (tr_line, it_order, itin_a, itin_b, ...).

`by` names the columns that tell runs of one name apart, such as the route system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import RUNS, RunLayout, scan

def resequence(itin: DataFrame, layout: RunLayout = RUNS, order: tuple[str, ...] = ("it_order",), by: Sequence[str] = ()) -> DataFrame:
    """Number the segments of every run 1..n in their present order."""
    return scan(itin, [*by, "tr_line"], order, bucket=layout.bucket(order[0]), number="it_order_new").withColumn(
        "it_order", F.col("it_order_new").cast("int")
    ).drop("it_order_new")


def measure(itin: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """f_meas and t_meas from `miles` along the run."""
    out = scan(itin, [*by, "tr_line"], ["it_order"], bucket=layout.bucket("it_order"), running={"t_meas": F.col("miles")})
    return out.withColumn("f_meas", F.col("t_meas") - F.col("miles"))


def gaps(itin: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """Segments that do not start where the previous one ended; z is that previous end."""
    seen = scan(itin, [*by, "tr_line"], ["it_order"], bucket=layout.bucket("it_order"), lag={"z": F.col("itin_b")})
    return seen.filter(F.col("z").isNotNull() & (F.col("itin_a") != F.col("z")))


def mark_ends(
    itin: DataFrame, layout: RunLayout = RUNS, first: str = "is_first", last: str = "is_last", by: Sequence[str] = ()
) -> DataFrame:
    return scan(itin, [*by, "tr_line"], ["it_order"], bucket=layout.bucket("it_order"), first=first, last=last)


def islands(itin: DataFrame, starts: Column, name: str, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """Number stretches of rows; `starts` is true on the first row of each."""
    return scan(
        itin, [*by, "tr_line"], ["it_order"], bucket=layout.bucket("it_order"), running={name: F.when(starts, 1).otherwise(0)}
    )


def imputed_clock(itin: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """Clock of imputed stretches and of the segment behind each.

    A stretch is consecutive rows with the same imputed flag and coded departure. Inside an imputed one
    arrivals run from its departure by the segment minutes and departures follow the arrival before;
    the row behind it, when its own order is above 1, departs at the last imputed arrival.
    """
    bucket = layout.bucket("it_order")
    seen = scan(
        itin, [*by, "tr_line"], ["it_order"], bucket=bucket, lag={"_imp": F.col("imputed"), "_dep": F.col("dep_time")}
    )
    fresh = ~(F.col("_imp").eqNullSafe(F.col("imputed")) & F.col("_dep").eqNullSafe(F.col("dep_time")))
    seconds = F.coalesce(F.col("ltime") * 60, F.lit(0.0))
    isle = islands(seen.withColumn("_fresh", fresh), F.col("_fresh"), "_isle", layout, by)
    spent = scan(isle, [*by, "tr_line", "_isle"], ["it_order"], bucket=bucket, running={"_ar": seconds})
    arr = F.when(F.col("imputed") == 1, F.col("dep_time") + F.col("_ar")).otherwise(F.col("arr_time"))
    timed = spent.withColumn("arr_time", arr)
    timed = scan(timed, [*by, "tr_line"], ["it_order"], bucket=bucket, lag={"_prev": F.col("arr_time")})
    inside = (F.col("imputed") == 1) & ~F.col("_fresh")
    behind = F.col("_fresh") & (F.col("_imp") > F.col("imputed")) & (F.col("seg_order") > 1)
    dep = F.when(inside | behind, F.col("_prev")).otherwise(F.col("dep_time"))
    return timed.withColumn("dep_time", dep).drop("_imp", "_dep", "_fresh", "_isle", "_ar", "_prev")


def drop_stations(itin: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leave out segments with either end among the excluded `node`s."""
    for end in ("itin_a", "itin_b"):
        itin = itin.join(nodes.select(F.col("node").alias(end)).distinct(), end, "left_anti")
    return itin


def finish_itinerary(
    itin: DataFrame, excluded: DataFrame, layout: RunLayout = RUNS, no_layover_prefix: str = "oes", by: Sequence[str] = ()
) -> DataFrame:
    """Final order after exclusions; the last segment gets layover 3, or 0 on the exception line."""
    kept = resequence(drop_stations(itin, excluded), layout, by=by)
    kept = mark_ends(kept, layout, by=by)
    end = F.when(F.startswith("tr_line", F.lit(no_layover_prefix)), "0").otherwise("3")
    return kept.withColumn("layover", F.when(F.col("is_last"), end).otherwise(F.col("layover"))).drop(
        "is_first", "is_last"
    )


def extension_orders(itin: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """Orders of line extensions: the first half counts up to -1, the second from 1001.

    Runs with an odd number of segments have no such halves and get a missing order.
    """
    c = scan(itin, [*by, "tr_line"], ["f_meas", "it_order"], number="_r", size="_n", bucket=layout.bucket("it_order"))
    half = F.floor(F.col("_n") / 2)
    new = F.when(F.col("_r") <= half, F.col("_r") - 1 - half).otherwise(1000 + F.col("_r") - half)
    return c.withColumn("it_order", F.when(F.col("_n") % 2 == 0, new).cast("int")).drop("_r", "_n")
