"""Import jobs: scheduled runs from a feed, and coded future projects."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import MAX_ZONE, round_half_away
from ..operators import coding as D
from ..operators import feed as S
from ..operators import itinerary as I
from ..operators import qc as Q
from ..operators.links import directed_rail_links, link_miles
from ..operators.runs import run_statistics
from ..operators.sequence import RUNS, RunLayout
from ..session import durable
from ..sources import readers as T


@dataclass(frozen=True)
class Imported:
    routes: DataFrame
    itinerary: DataFrame
    hold: DataFrame | None
    violations: DataFrame


def import_feed(
    runs: DataFrame, segments: DataFrame, links: DataFrame, fares: DataFrame, base: bool = True,
    layout: RunLayout = RUNS, ranges=S.NETWORKS, max_zone: int = MAX_ZONE, strict: bool = True,
) -> Imported:
    """Feed runs and segments to route headers and gap-filled, timed and measured itineraries.

    With `strict`, the job ends when a check reports anything.
    """
    lengths = durable(link_miles(directed_rail_links(links)))
    good, bad = S.usable_segments(segments)
    routes = durable(S.format_runs(runs, good, base))
    rows = good.join(routes.select("line", "tr_line", "mode"), "line")
    rows = durable(rows.withColumn("ltime", round_half_away("ltime", 1)))
    rows = S.fold_zero_pairs(rows, layout)
    rows = durable(S.add_zone_fares(rows, fares))
    _, hold = S.split_matched(rows, lengths)
    filled = durable(S.fill_gaps(rows, lengths, layout, ranges))
    stats = run_statistics(filled)
    routes = routes.join(stats, "tr_line", "left").na.fill(0, ["start_sec", "strthour", "am_share"])
    mi = lengths.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles")
    itinerary = S.final_itinerary(filled, layout)
    measured = I.measure(itinerary.join(mi, ["itin_a", "itin_b"], "left").na.fill(0.0, ["miles"]), layout).drop("miles")
    found = Q.violations(Q.same_end_single(bad), Q.bad_ends(measured, max_zone), Q.not_on_link(measured, lengths))
    if strict:
        Q.assert_clean(found)
    return Imported(routes, measured, hold, found)


def import_coding(
    header: DataFrame, itinerary: DataFrame, links: DataFrame, old_routes: DataFrame, old_itinerary: DataFrame,
    layout: RunLayout = RUNS, ranges=S.NETWORKS, strict: bool = True,
) -> Imported:
    """Coded projects replace their lines in the future route and itinerary tables.

    With `strict`, the job ends when a check reports anything.
    """
    lengths = durable(link_miles(directed_rail_links(links)))
    routes = durable(D.read_headers(header))
    segments = durable(D.read_segments(itinerary, routes))
    on = segments.filter(F.col("action").isin(1, 5)).withColumn("it_order", F.col("ord"))
    on = D.swap_terminus(I.resequence(on, layout))
    four = segments.filter(F.col("action") == 4).withColumn("it_order", F.col("ord"))
    off = D.fill_paths(segments.filter(F.col("action").isin(*D.PATH_ACTIONS)), lengths, layout, ranges)
    every = on.unionByName(four, allowMissingColumns=True).unionByName(off, allowMissingColumns=True)
    measured = durable(D.measured(every, lengths, layout))
    coded = F.col("action").isin(*D.CODED_ACTIONS)
    back = D.coded_form(measured.filter(coded)).withColumn("dw_time", D.C.dwell_time("dw_code"))
    plain = measured.filter(~coded).withColumnRenamed("lo", "layover")
    plain = plain.drop("orig_a", "orig_b", "orig_lo", "action", "ord", "miles")
    new = plain.unionByName(back.withColumn("it_order", F.col("it_order").cast("int")), allowMissingColumns=True)
    all_routes, all_itin = D.replace_lines(old_routes, old_itinerary, routes, new)
    found = Q.violations(
        Q.header_without_itinerary(routes, segments), Q.itinerary_without_header(routes, segments),
        Q.not_on_link(segments, lengths), Q.all_segment_rules(segments), Q.header_rules(routes),
        Q.too_many_layovers(segments, (F.col("action") == 1) & (F.col("lo") != "")),
        Q.itinerary_gaps(on.filter(F.col("action") == 1), layout),
    )
    if strict:
        Q.assert_clean(found)
    return Imported(all_routes, all_itin, None, found)


def _with_refused(done: Imported, strict: bool, *refused: DataFrame) -> Imported:
    found = Q.violations(*refused, done.violations.select("check", "key", "detail"))
    if strict:
        Q.assert_clean(found)
    return replace(done, violations=found)


def import_feed_files(
    spark: SparkSession, runs_path: str, segments_path: str, links: DataFrame, fares: DataFrame, base: bool = True,
    layout: RunLayout = RUNS, ranges=S.NETWORKS, max_zone: int = MAX_ZONE, strict: bool = True, named: bool = False,
) -> Imported:
    """`import_feed` from the feed's two files. Refused records are violations; `named`: see `readers.records`."""
    runs, segments = T.read_feed_runs(spark, runs_path, named), T.read_feed_segments(spark, segments_path, named)
    done = import_feed(runs, segments, links, fares, base, layout, ranges, max_zone, strict=False)
    return _with_refused(done, strict, T.refused(spark, runs_path, T.FEED_RUNS, named), T.refused(spark, segments_path, T.FEED_SEGMENTS, named))


def import_coding_files(
    spark: SparkSession, header_path: str, itinerary_path: str, links: DataFrame, old_routes: DataFrame, old_itinerary: DataFrame,
    layout: RunLayout = RUNS, ranges=S.NETWORKS, strict: bool = True, named: bool = False,
) -> Imported:
    """`import_coding` from the two sheets. Refused records are violations; `named`: see `readers.records`."""
    header, itinerary = T.read_coding_sheets(spark, header_path, itinerary_path, named)
    done = import_coding(header, itinerary, links, old_routes, old_itinerary, layout, ranges, strict=False)
    return _with_refused(done, strict, T.refused(spark, header_path, T.HEADERS, named), T.refused(spark, itinerary_path, T.ITINERARIES, named))
