"""Import of coded future projects: header and itinerary sheets to routes and itineraries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core as C
from . import itinerary as I
from .feed import NETWORKS, along_paths
from .sequence import RUNS, RunLayout
from .tables import first_per_key, upsert

# Actions whose segments may lie off the network, and those stored in coded form.
PATH_ACTIONS = (2, 3, 6, 7)
CODED_ACTIONS = (2, 3, 5, 6, 7)


def read_headers(header: DataFrame) -> DataFrame:
    """Clean header rows: lower-case line, cut texts, missing numbers as 0, one row per line."""
    rows = header.filter(F.col("tr_line").isNotNull() & (F.col("action") >= 1))
    rows = rows.withColumns(
        {
            "tr_line": F.lower("tr_line"),
            "description": C.first_n(F.upper(C.strip_chars("description", "'")), 20),
            "notes": C.first_n(F.upper(C.strip_chars("notes", "'")), 30),
        }
    )
    numbers = [n for n, t in rows.dtypes if t in ("int", "bigint", "double", "float", "smallint")]
    rows = rows.na.fill(0, numbers)
    return first_per_key(rows, ["tr_line"], ["action"])


def read_segments(itinerary: DataFrame, routes: DataFrame) -> DataFrame:
    """Clean itinerary rows with the action of their header; header-only lines add nothing."""
    rows = itinerary.filter(F.col("tr_line").isNotNull()).withColumn("tr_line", F.lower("tr_line"))
    rows = rows.na.fill(0, ["ord", "itin_a", "itin_b", "trv_time", "zn_fare"])
    rows = rows.filter(F.col("ord") == F.floor("ord"))
    rows = rows.withColumns(
        {
            "ord": F.col("ord").cast("int"),
            "dw_time": C.dwell_time("dw_code"),
            "trv_time": C.round_half_away("trv_time", 1),
            "lo": F.when(F.col("layover") > 0, F.col("layover").cast("string")).otherwise(""),
        }
    )
    return rows.drop("layover").join(routes.select("tr_line", "action"), "tr_line", "left")


def swap_terminus(segments: DataFrame) -> DataFrame:
    """Action 5 plots its new path: order 1 swaps the first node with the coded one, order 2 the second."""
    five = F.col("action") == 5
    new = F.col("lo").try_cast("int")
    first, second = five & (F.col("it_order") == 1), five & (F.col("it_order") == 2)
    return segments.withColumns(
        {
            "orig_a": F.when(five, F.col("itin_a")),
            "orig_b": F.when(five, F.col("itin_b")),
            "orig_lo": F.when(five, F.col("lo")),
            "itin_a": F.when(first, new).otherwise(F.col("itin_a")),
            "itin_b": F.when(second, new).otherwise(F.col("itin_b")),
            "lo": F.when(first, F.col("itin_a").cast("string"))
            .when(second, F.col("itin_b").cast("string"))
            .otherwise(F.col("lo")),
        }
    )


def fill_paths(segments: DataFrame, links: DataFrame, layout: RunLayout = RUNS, ranges=NETWORKS) -> DataFrame:
    """Segments of the path actions follow the shortest path; attributes are copied, orders counted anew.

    The coded ends are kept in orig_a, orig_b. A pair out of reach keeps its coded nodes.
    """
    rows = segments.withColumn("mode", F.upper(F.substring("tr_line", 1, 1)))
    rows = along_paths(rows, links, ranges, every=True).drop("mode", "linkmi", "totmi")
    rows = rows.withColumns({"orig_a": F.col("itin_a"), "orig_b": F.col("itin_b"), "i": F.coalesce("i", F.lit(0))})
    rows = rows.withColumns({"itin_a": F.coalesce("newa", "itin_a"), "itin_b": F.coalesce("newb", "itin_b")})
    rows = rows.withColumn("it_order", F.col("ord"))
    return I.resequence(rows, layout, ("it_order", "i")).drop("newa", "newb", "i")


def measured(segments: DataFrame, lengths: DataFrame, layout: RunLayout = RUNS) -> DataFrame:
    """Segments with link miles (0 when off the network) and measures.

    Workers that find paths hold the network; here its lengths go to the segments, which stay where their runs are.
    """
    mi = lengths.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles")
    return I.measure(segments.join(F.broadcast(mi), ["itin_a", "itin_b"], "left").na.fill(0.0, ["miles"]), layout)


def coded_form(segments: DataFrame) -> DataFrame:
    """Back to the coded segments: one row per (line, coded ends, dwell code)."""
    order = F.when(F.col("action") == 5, F.col("it_order")).otherwise(0)
    layover = F.when(F.col("action") == 5, F.col("orig_lo")).otherwise(F.col("lo"))
    return segments.groupBy("tr_line", F.col("orig_a").alias("itin_a"), F.col("orig_b").alias("itin_b"), "dw_code").agg(
        F.max(layover).alias("layover"), F.min("f_meas").alias("f_meas"), F.max("t_meas").alias("t_meas"),
        F.sum(order).alias("it_order"), F.avg("trv_time").alias("trv_time"),
    )


def replace_lines(old_routes: DataFrame, old_itin: DataFrame, routes: DataFrame, itin: DataFrame):
    """Imported lines replace their rows in the route and the itinerary table."""
    keys = routes.select("tr_line")
    kept = old_itin.join(keys, "tr_line", "left_anti")
    return upsert(old_routes, routes, ["tr_line"]), kept.unionByName(itin, allowMissingColumns=True)
