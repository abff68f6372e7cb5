"""Run-level operators: statistics, representatives, departure gaps and headways."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import is_pm, line_group, period_minutes, round_half_away, start_hour
from .sequence import scan
from .tables import cut_by_range, first_per_key


def overnight_order(runs: DataFrame, tod: str = "tod") -> DataFrame:
    """Departure order inside a group: the overnight period takes afternoon runs first."""
    hour = F.when(F.col(tod) == 1, start_hour(F.pmod("start_sec", F.lit(86400)))).otherwise(0)
    pm = F.when((F.col(tod) == 1) & F.coalesce(is_pm("start_sec"), F.lit(False)), 1).otherwise(2)
    return runs.withColumns({"priority": pm, "hour_rank": F.coalesce(hour, F.lit(-1))})


def departure_gaps(runs: DataFrame, group: Sequence[str], tod: str = "tod") -> DataFrame:
    """Minutes since the previous departure of the group; a lone run stands for the whole period.

    A gap longer than the period is folded over midnight and a zero gap counts as the period. The first
    run of a larger group has no gap and is left out.
    """
    order = ["priority", "hour_rank", "start_sec", "tr_line"]
    ranked, bucket = cut_by_range(overnight_order(runs, tod), group, order)
    seen = scan(ranked, group, order, bucket=bucket, size="runs", first="_first", lag={"_prev": F.col("start_sec")})
    period = period_minutes(tod)
    gap = F.when(F.col("runs") == 1, period).otherwise(F.abs(F.col("start_sec") - F.col("_prev")) / 60)
    gap = F.when(gap > period, F.lit(1440.0) - gap).otherwise(gap)
    gap = F.when(gap == 0, period).otherwise(gap)
    kept = seen.filter(~F.col("_first") | (F.col("runs") == 1)).withColumn("gap", gap)
    return kept.drop("_first", "_prev", "priority", "hour_rank", "_range")


def group_headways(gaps: DataFrame, group: Sequence[str]) -> DataFrame:
    agg = gaps.groupBy(*group).agg(F.avg("gap").alias("hdwy"), F.max("runs").alias("runs"))
    return agg.withColumn("hdwy", round_half_away("hdwy", 1))


def representatives(segments_per_run: DataFrame, group: Sequence[str]) -> DataFrame:
    """The run that stands for its group: most segments, then earliest start, then name."""
    ranked = segments_per_run.withColumn("_neg", -F.col("segs"))
    return first_per_key(ranked, group, ["_neg", "start_sec", "tr_line"]).drop("_neg")


def metra_headway(runs: DataFrame, tod: str = "tod") -> DataFrame:
    """Headway 99 of a Metra run means one train in the period."""
    fill = (F.col("mode") == "M") & (F.col("headway") == 99)
    return runs.withColumn("headway", F.when(fill, period_minutes(tod)).otherwise(F.col("headway").cast("double")))


def collapse_groups(runs: DataFrame, groups: DataFrame, coded: str = "acthdwy") -> DataFrame:
    """Keep the representative of each CTA group with the coded or the averaged headway; Metra passes."""
    cta = runs.filter(F.col("mode") != "M").join(groups.select("tr_line", "hdwy"), "tr_line")
    head = F.when(F.col(coded) > 0, F.col(coded)).otherwise(F.col("hdwy"))
    cta = cta.withColumn("headway", head.cast("double")).drop("hdwy")
    return cta.unionByName(runs.filter(F.col("mode") == "M").withColumn("headway", F.col("headway").cast("double")))


def signature_rows(itin: DataFrame, runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct a-b-dwell segments of each CTA run under its route key (line group and route id)."""
    seg = F.concat_ws("-", F.col("itin_a"), F.col("itin_b"), F.col("dw_code"))
    key = F.substring(F.concat(line_group("tr_line"), F.regexp_replace("route_id", " ", "")), 1, 13)
    heads = runs.filter(F.startswith("tr_line", F.lit("c"))).select(*by, "tr_line", key.alias("route_key"))
    rows = itin.filter(F.startswith("tr_line", F.lit("c"))).select(*by, "tr_line", seg.alias("seg"))
    return rows.join(heads, [*by, "tr_line"]).select(*by, "route_key", "tr_line", "seg").distinct()


def run_statistics(segments: DataFrame, key: str = "tr_line", order: str = "it_order") -> DataFrame:
    """Start second, start hour and share of segments inside the morning peak."""
    from .selection import in_am_peak

    start = F.when(F.col("dep_time") == 0, F.col("arr_time")).otherwise(F.least("dep_time", "arr_time"))
    agg = segments.withColumn("_start", start).groupBy(key).agg(
        F.min_by("_start", F.when(F.col("_start") != 0, F.col(order))).alias("start_sec"),
        F.sum(F.when(in_am_peak(), 1).otherwise(0)).alias("_am"),
        F.count(F.lit(1)).alias("_n"),
    )
    begin = F.coalesce("start_sec", F.lit(0))
    share: Column = round_half_away(F.col("_am") / F.col("_n"), 2)
    return agg.select(key, begin.alias("start_sec"), start_hour(begin).alias("strthour"), share.alias("am_share"))
