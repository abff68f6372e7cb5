"""Service summary per (mode, longname) of one or more periods.

`itin` is the final itinerary with `mode`, `longname` and `dw_time`; `runs` has one row per run with
`mode`, `longname`, `headway` and `tod`. Segments are folded to (line, link) before they meet the link
table, so a hot link or line shuffles as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import period_minutes

LINE = ("mode", "longname")


def run_weight(tod: str = "tod") -> Column:
    """Trips a coded run stands for: period over headway for CTA, one for Metra."""
    cta = F.try_divide(period_minutes(tod), F.col("headway").cast("double"))
    return F.when(F.col("mode") == "C", cta).otherwise(F.lit(1.0))


def runs_per_line(runs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    return runs.groupBy(*by).agg(F.sum(run_weight()).alias("runs"))


def directional_miles(itin: DataFrame, links: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    pairs = itin.select(*by, "itin_a", "itin_b").distinct()
    joined = pairs.join(links.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles"), ["itin_a", "itin_b"], "left")
    return joined.groupBy(*by).agg(F.sum("miles").alias("dir_lnk_mi"))


def service_miles(itin: DataFrame, links: DataFrame, runs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    weights = runs.select("tr_line", run_weight().alias("w"))
    folded = itin.join(weights, "tr_line").groupBy(*by, "itin_a", "itin_b").agg(F.sum("w").alias("w"))
    lengths = links.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles")
    joined = folded.join(lengths, ["itin_a", "itin_b"], "left")
    return joined.groupBy(*by).agg(F.sum(F.col("w") * F.col("miles")).alias("srvc_mi"))


def service_hours(itin: DataFrame, runs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    weights = runs.select("tr_line", run_weight().alias("w"))
    times = itin.groupBy("tr_line", *by).agg(F.sum("trv_time").alias("t"))
    return times.join(weights, "tr_line").groupBy(*by).agg((F.sum(F.col("w") * F.col("t")) / 60).alias("srvc_hrs"))


def stations(itin: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    stops = itin.filter(F.col("dw_time") > 0)
    return stops.select(*by, "itin_b").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("stations"))


def average_stops(itin: DataFrame, runs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """CTA: stops weighted by trips over the runs that stop; Metra: all stops over all runs."""
    weights = runs.select("tr_line", run_weight().alias("w"))
    stops = itin.filter(F.col("dw_time") > 0).groupBy("tr_line", *by).agg(F.count(F.lit(1)).alias("stops"))
    per_line = stops.join(weights, "tr_line").groupBy(*by).agg(
        F.sum(F.col("stops") * F.col("w")).alias("stops"), F.sum("w").alias("stopping_runs")
    )
    all_runs = runs_per_line(runs, by)
    base = F.when(F.col("mode") == "C", F.col("stopping_runs")).otherwise(F.col("runs"))
    joined = per_line.join(all_runs, list(by))
    return joined.select(*by, F.try_divide(F.col("stops"), base).alias("avg_stops"))


def line_summary(itin: DataFrame, links: DataFrame, runs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """All six measures side by side.

    The segments are read once for the sums: weights join by run, then rows fold to (line, link), to
    (line, node) and to the line. A second narrow read finds the runs that stop anywhere.
    """
    by = list(by)
    weights = runs.select("tr_line", run_weight().alias("w"))
    stop = F.col("dw_time") > 0
    folded = itin.join(weights, "tr_line").groupBy(*by, "itin_a", "itin_b").agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("trv_time")).alias("wt"),
        F.sum(F.when(stop, F.col("w"))).alias("stops"), F.max(F.when(stop, 1)).alias("stop"),
    )
    lengths = links.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles")
    per_link = folded.join(lengths, ["itin_a", "itin_b"], "left")
    per_node = per_link.groupBy(*by, "itin_b").agg(
        F.sum("miles").alias("dir_lnk_mi"), F.sum(F.col("w") * F.col("miles")).alias("srvc_mi"), F.sum("wt").alias("wt"),
        F.sum("stops").alias("stops"), F.max("stop").alias("stop"),
    )
    per_line = per_node.groupBy(*by).agg(
        F.sum("dir_lnk_mi").alias("dir_lnk_mi"), F.sum("srvc_mi").alias("srvc_mi"), (F.sum("wt") / 60).alias("srvc_hrs"),
        F.sum("stop").alias("stations"), F.sum("stops").alias("stops"),
    )
    stopping = itin.filter(stop).select("tr_line").distinct().withColumn("_stops", F.lit(True))
    per_run = runs.select(*by, "tr_line", run_weight().alias("w")).join(stopping, "tr_line", "left")
    trips = per_run.groupBy(*by).agg(F.sum("w").alias("runs"), F.sum(F.when(F.col("_stops"), F.col("w"))).alias("stopping"))
    out = trips.join(per_line, by, "full_outer")
    base = F.when(F.col("mode") == "C", F.col("stopping")).otherwise(F.col("runs"))
    return out.withColumn("avg_stops", F.try_divide("stops", base)).select(*by, *MEASURES)


MEASURES = ("runs", "dir_lnk_mi", "srvc_mi", "srvc_hrs", "stations", "avg_stops")
