"""Data checks. Each returns rows (check, key, detail); an empty frame means clean.

`by` names columns, such as scenario and period, that rows are told apart by; they stand in front of the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import MAX_ZONE, is_junction
from . import itinerary as I
from .sequence import RUNS, RunLayout

COLUMNS = ("check", "key", "detail")


def _rows(df: DataFrame, check: str, key: Column | str, *detail: Column | str, by: Sequence[str] = ()) -> DataFrame:
    key = _key(F.col(key) if isinstance(key, str) else key, by)
    parts = [F.coalesce((F.col(d) if isinstance(d, str) else d).cast("string"), F.lit(".")) for d in detail]
    text = F.concat_ws(" ", *parts) if parts else F.lit("")
    return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), text.alias("detail"))


def _key(key: Column, by: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in by], key.cast("string")) if by else key


def same_end_single(bad_segments: DataFrame) -> DataFrame:
    return _rows(bad_segments, "bad_itinerary", "line", "itin_a", "itin_b")


def header_without_itinerary(routes: DataFrame, itin: DataFrame) -> DataFrame:
    lost = routes.select("tr_line").join(itin.select("tr_line").distinct(), "tr_line", "left_anti")
    return _rows(lost, "route_without_itinerary", "tr_line")


def itinerary_without_header(routes: DataFrame, itin: DataFrame) -> DataFrame:
    lost = itin.select("tr_line").distinct().join(routes.select("tr_line"), "tr_line", "left_anti")
    return _rows(lost, "itinerary_without_header", "tr_line")


def not_on_link(itin: DataFrame, lengths: DataFrame, skip_actions: Sequence[int] = (2, 3, 6, 7)) -> DataFrame:
    rows = itin if "action" not in itin.columns else itin.filter(~F.coalesce(F.col("action").isin(*skip_actions), F.lit(False)))
    on = lengths.filter(F.col("miles") > 0).select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"))
    return _rows(rows.join(on, ["itin_a", "itin_b"], "left_anti"), "not_on_link", "tr_line", "itin_a", "itin_b")




def _segment_rules() -> dict[str, Column]:
    action, lo = F.col("action"), F.col("lo")
    return {
        "junction_stop": (action == 1) & is_junction("itin_b") & (F.col("dw_code") == "0"),
        "no_time_reduction": (action == 2) & (F.col("trv_time") == 0),
        "no_new_station": (action == 3) & (lo == ""),
        "bad_terminus": (action == 5) & ((lo == "") | ~F.col("ord").isin(1, 2, 6)),
        "time_on_action_6": (action == 6) & (F.col("trv_time") != 0),
        "no_consolidated_station": (action == 7) & (lo == ""),
    }


def segment_rule(itin: DataFrame, name: str) -> DataFrame:
    return _rows(itin.filter(_segment_rules()[name]), name, "tr_line", "itin_a", "itin_b")


def all_segment_rules(itin: DataFrame) -> DataFrame:
    """Every rule in one pass over the segments."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in _segment_rules().items()]))
    found = itin.select("tr_line", "itin_a", "itin_b", F.explode(hits).alias("_check"))
    detail = F.concat_ws(" ", F.col("itin_a").cast("string"), F.col("itin_b").cast("string"))
    return found.select(F.col("_check").alias("check"), F.col("tr_line").alias("key"), detail.alias("detail"))


def header_rules(routes: DataFrame) -> DataFrame:
    hits = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col("scenario"), F.lit("")) == "", F.lit("no_scenario")),
            F.when(F.length("mode") > 1, F.lit("several_modes")),
        )
    )
    found = routes.select("tr_line", F.explode(hits).alias("check"))
    return found.select("check", F.col("tr_line").alias("key"), F.lit("").alias("detail"))


def too_many_layovers(itin: DataFrame, coded: Column, allowed: int = 2, by: Sequence[str] = ()) -> DataFrame:
    counts = itin.filter(coded).groupBy(*by, "tr_line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > allowed)
    return _rows(counts, "too_many_layovers", "tr_line", "n", by=by)


def itinerary_gaps(itin: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    return _rows(I.gaps(itin, layout, by), "itinerary_gap", "tr_line", "it_order", "itin_a", "z", by=by)


def bad_ends(itin: DataFrame, max_zone: int = MAX_ZONE) -> DataFrame:
    bad = itin.filter((F.col("itin_a") == F.col("itin_b")) | (F.col("itin_a") <= max_zone) | (F.col("itin_b") <= max_zone))
    pairs = bad.select("itin_a", "itin_b").distinct()
    return _rows(pairs, "bad_segment", F.concat_ws("-", F.col("itin_a"), F.col("itin_b")))


def junction_stops(itin: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _rows(itin.filter(is_junction("itin_b") & (F.col("dw_code") == "0")), "stop_at_junction", "tr_line", "itin_a", "itin_b", by=by)


def link_faults(links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    hits = F.array_compact(
        F.array(
            F.when(F.col("miles") == 0, F.lit("link_without_length")),
            F.when(F.coalesce(F.trim("modes1"), F.lit("")) == "", F.lit("link_without_mode")),
        )
    )
    found = links.select(*by, "a", "b", F.explode(hits).alias("check"))
    return found.select("check", _key(F.concat_ws("-", F.col("a"), F.col("b")), by).alias("key"), F.lit("").alias("detail"))


def node_faults(nodes: DataFrame) -> DataFrame:
    lost = nodes.filter(F.col("point_x").isNull() | F.col("point_y").isNull())
    twice = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return _rows(lost, "node_without_coordinates", "node").unionByName(_rows(twice, "duplicate_node", "node", "n"))


def several_coordinates(ends: DataFrame, first_temporary: int = 90000) -> DataFrame:
    """Nodes at more than one place; ends a split made (temporary numbers) are skipped."""
    kept = ends.filter(F.col("temp_node") < first_temporary) if "temp_node" in ends.columns else ends
    places = kept.select("node", "point_x", "point_y").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    return _rows(places.filter(F.col("n") > 1), "several_coordinates", "node", "n")


def extension_orders(segments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    bad = segments.filter((F.col("it_order") > -1) & (F.col("it_order") < 1001))
    return _rows(bad, "bad_extension_order", "tr_line", "it_order", by=by)


def generic_uses_deleted(itin: DataFrame, deleted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    generic = itin.filter(F.col("tr_line").contains("*"))
    hits = None
    for end in ("itin_a", "itin_b"):
        part = generic.join(deleted.select(F.col("node").alias(end)).distinct(), end, "left_semi")
        part = part.select(*by, "tr_line", "it_order", F.col(end).alias("node"))
        hits = part if hits is None else hits.unionByName(part)
    return _rows(hits.distinct(), "generic_line_uses_deleted_node", "tr_line", "it_order", "node", by=by)


def one_sided_routes(only: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """From `reconcile`: lines found in one of the two tables only."""
    return _rows(only, "dropped_route", "tr_line", "side", by=by)


def violations(*checks: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def assert_clean(found: DataFrame, show: int = 20) -> None:
    """Raise when a check reports anything; shows the first few rows only."""
    head = found.limit(show).collect()
    if head:
        lines = "\n".join(f"{r['check']}: {r['key']} {r['detail']}" for r in head)
        raise ValueError(f"data checks failed:\n{lines}")
