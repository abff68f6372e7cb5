"""Scenario networks: all scenarios and periods in one job, written partitioned by both."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import actions as A
from ..operators import itinerary as I
from ..operators import network as N
from ..operators import qc as Q
from ..operators import report as M
from ..operators import runs as R
from ..operators.clustering import similar_runs
from ..operators.links import both_directions
from ..operators.sequence import RUNS, RunLayout
from ..operators.spatial import node_zones
from ..operators.summary import line_summary
from ..operators.tables import first_per_key
from ..session import durable
from ..sinks import layouts as L
from ..sinks.writers import with_header, write_csv, write_text

BY = ("scenario", "tod")


@dataclass(frozen=True)
class Scenario:
    runs: DataFrame
    itinerary: DataFrame
    links: DataFrame
    nodes: DataFrame
    summary: DataFrame
    violations: DataFrame
    scenarios: tuple[int, ...] = ()
    report: DataFrame | None = None


def collapse_cta(runs: DataFrame, itin: DataFrame) -> DataFrame:
    """CTA runs of a scenario and period shrink to one representative per group of similar runs."""
    cta = runs.filter(F.startswith("tr_line", F.lit("c")))
    signatures = R.signature_rows(itin, cta, BY)
    groups = similar_runs(signatures, key=(*BY, "route_key")).select(*BY, "tr_line", F.col("leader").alias("grp"))
    segs = itin.groupBy(*BY, "tr_line").agg(F.max("it_order").alias("segs"))
    known = durable(cta.select(*BY, "tr_line", "start_sec").join(segs, [*BY, "tr_line"]).join(groups, [*BY, "tr_line"]))
    keys = ["scenario", "grp", "tod"]
    reps = R.representatives(known, keys).select(*keys, "tr_line")
    head = R.group_headways(R.departure_gaps(known, keys), keys)
    reps = reps.join(head, keys).select(*BY, "tr_line", "hdwy")
    kept = runs.filter(F.col("mode") != "M").join(reps, [*BY, "tr_line"])
    coded = F.when(F.col("acthdwy") > 0, F.col("acthdwy")).otherwise(F.col("hdwy"))
    kept = kept.withColumn("headway", coded).drop("hdwy")
    return kept.unionByName(R.metra_headway(runs.filter(F.col("mode") == "M")))


def _coded_rows(routes: DataFrame, itin: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """Segments of the coded projects, for each scenario and period they belong to."""
    lines = N.coded_by_period(routes, scenarios)
    keep = [c for c in (*BY, "tr_line", "action", "descr") if c in lines.columns]
    rows = itin.drop(*[c for c in keep if c != "tr_line" and c in itin.columns]).join(lines.select(*keep), "tr_line")
    return rows.withColumns({"ln": C.line_group("tr_line"), "new": F.col("layover").try_cast("int")})


def coded_actions(
    routes: DataFrame, itin: DataFrame, scenarios: Sequence[int], vertices: DataFrame | None = None,
    nodes: DataFrame | None = None, layout: RunLayout = RUNS,
) -> dict[str, DataFrame]:
    """The rows of the five actions by scenario and period, named as in `apply_actions`.

    Coded segments hold in `layover` the other terminus (5), the new station (3, 7) or 99 for a whole line (2),
    in `it_order` which node changes (5) or the place of an extension (4), in `dw_code` the share of runs that
    stop (3) and in `trv_time` the reduction (2), which acts along the drawn `vertices` of the line.
    """
    rows = durable(_coded_rows(routes, itin, scenarios))
    of = lambda action: rows.filter(F.col("action") == action)
    lay = F.when(F.coalesce(F.trim("layover"), F.lit("")) == "", "0").otherwise(F.col("layover"))
    out = {
        "shifts": of(5).select(*BY, "ln", "itin_a", "itin_b", "new", F.col("it_order").alias("nd")),
        "stations": of(3).select(*BY, "ln", "itin_a", "itin_b", "new", "dw_code"),
        "spans": of(7).select(*BY, "ln", F.col("itin_a").alias("start_node"), F.col("itin_b").alias("end_node"), "new"),
        "extensions": of(4).select(*BY, "ln", F.col("tr_line").alias("project"), "it_order", "itin_a", "itin_b", lay.alias("layover"), "dw_code", "trv_time"),
        "whole_lines": of(2).filter("layover = '99'").select(*BY, "ln").distinct(),
    }
    if vertices is not None and nodes is not None:
        # The rate that is coded first holds for the line.
        first = F.struct("it_order", "itin_a", "itin_b")
        rates = of(2).groupBy(*BY, "tr_line").agg(F.min_by("trv_time", first).alias("reduc"))
        out["cuts"] = A.cut_pairs(vertices, nodes, rates, layout, BY)
    else:
        out["cuts"] = of(2).filter("coalesce(layover, '') <> '99'").select(*BY, "ln", "itin_a", "itin_b", F.col("trv_time").alias("reduc"))
    return out


def scenario_report(routes: DataFrame, itin: DataFrame, movers: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """One sentence per edit of each scenario and period; `routes` carry their description in `descr`, else in `description`."""
    if "descr" not in routes.columns:
        text = F.col("description") if "description" in routes.columns else F.lit(None).cast("string")
        routes = routes.withColumn("descr", text)
    lines = N.coded_by_period(routes, scenarios)
    rows = _coded_rows(routes, itin, scenarios)
    of = lambda df, action: df.filter(F.col("action") == action)
    spans = of(rows, 7).withColumnsRenamed({"itin_a": "start_node", "itin_b": "end_node"})
    return M.change_report(
        M.mover_report(N.closed_movers(movers, scenarios)), M.new_route_report(of(lines, 1)), M.shift_report(of(lines, 5)),
        M.extension_report(of(lines, 4)), M.station_report(of(rows, 3)), M.consolidation_report(spans), M.time_report(of(rows, 2)),
    )


def build_scenarios(
    runs: DataFrame, itin: DataFrame, links: DataFrame, nodes: DataFrame, coded_runs: DataFrame, coded_itin: DataFrame,
    movers: DataFrame, scenarios: Sequence[int], zones: DataFrame | None = None,
    excluded: DataFrame | None = None, actions: dict[str, DataFrame] | None = None, action_vertices: DataFrame | None = None,
    layout: RunLayout = RUNS, max_zone: int = C.MAX_ZONE, strict: bool = True, future_routes: DataFrame | None = None,
) -> Scenario:
    """Runs, itineraries, links, nodes and summary of every scenario and period.

    Runs and coded runs carry description, veh_type and speed for the line file; lines that a project of
    `coded_runs` changes are marked in their description. `actions` holds the coded rows of the actions by
    scenario and period, named as in `apply_actions`; without them they are made from `coded_runs` and
    `coded_itin`. With `strict`, the job ends when a check reports anything.

    With the drawn `future_routes` (tr_line, vertices) of coded lines, `links` holds base and future links with their vertices: a
    link belongs to a scenario when a base run or a future route active in the scenario runs along it, or when it is for neither
    CTA nor Metra. Without them all links are in every scenario.
    """
    spark = itin.sparkSession
    if excluded is None:
        excluded = spark.createDataFrame([(C.DROP_NODE,)], "node INT")
    periods = durable(N.tod_runs(runs, coded_runs, scenarios))
    every = itin.unionByName(coded_itin, allowMissingColumns=True) if coded_itin is not None else itin
    rows = N.tod_itineraries(every, periods)
    if actions is None and coded_itin is not None:
        actions = coded_actions(coded_runs, coded_itin, scenarios, action_vertices, nodes, layout)
    if actions:
        rows = A.apply_actions(rows, by=BY, tod=F.col("tod"), layout=layout, **actions)
    rows = durable(rows)
    marked = collapse_cta(periods, rows)
    coded = N.coded_by_period(coded_runs, scenarios).select(*BY, "tr_line", "action")
    kept = durable(A.revise_descriptions(marked, coded, F.col("scenario"), BY))
    heads = kept.select(*BY, "tr_line", "mode", "longname")
    final = durable(I.finish_itinerary(rows.join(heads, [*BY, "tr_line"]), excluded, layout, by=BY))
    base = scenario_links(links, itin, coded_runs, future_routes, movers, scenarios)
    tods = F.explode(F.array(*[F.lit(p) for p in N.ALL_TODS])).alias("tod")
    plain = base.select(*[c for c in base.columns if c != "vertices"], tods)  # drawings stay out of the copies per period
    net = durable(N.service_network(plain, final, BY, max_zone))
    table = N.network_node_table(net, nodes, BY, F.col("scenario"), max_zone)
    if zones is not None:
        table = table.join(node_zones(nodes, zones).select("node", "zone"), "node", "left")
    table = durable(table)
    lengths = both_directions(base).select("scenario", "a", "b", "miles", "opposite")
    lengths = first_per_key(lengths, ["scenario", "a", "b"], ["opposite", "miles"]).drop("opposite")
    summed = final.filter(F.col("tod").isin(2, 4))
    summary = scenario_summary(summed, lengths, kept.filter(F.col("tod").isin(2, 4)))
    found = Q.violations(
        Q.too_many_layovers(rows, F.coalesce(F.col("layover").try_cast("double"), F.lit(0.0)) > 0, by=BY),
        Q.itinerary_gaps(final, layout, BY), Q.junction_stops(final, BY), Q.link_faults(net, BY),
        Q.node_faults(table.select("node", "point_x", "point_y").distinct()),
    )
    if actions and actions.get("extensions") is not None:
        found = Q.violations(found, Q.extension_orders(actions["extensions"].withColumn("tr_line", F.col("ln")), BY))
    if strict:
        Q.assert_clean(found)
    said = scenario_report(coded_runs, coded_itin, movers, scenarios) if coded_itin is not None else None
    return Scenario(kept, final, net, table, summary, found, tuple(scenarios), said)


def scenario_links(links: DataFrame, itin: DataFrame, coded_runs: DataFrame, future_routes: DataFrame | None, movers: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """Links of each scenario without its closed people movers: the base network, then links along its active future routes."""
    closed = N.closed_movers(movers, scenarios)
    if future_routes is None:
        return N.without_closed_movers(N.per_scenario(links, scenarios), closed)
    links = durable(links)
    used = itin.select(F.col("itin_a").alias("a"), F.col("itin_b").alias("b"))
    # A base link serves a base run in one of its directions, or no rail run at all.
    used = used.unionByName(used.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    rail = C.has_code("modes1", "C") | C.has_code("modes1", "M")
    base = links.filter(~rail).unionByName(links.filter(rail).join(used, ["a", "b"], "left_semi"))
    base = N.without_closed_movers(N.per_scenario(base, scenarios), closed)
    active = N.per_scenario(coded_runs.select("tr_line", "scenario").distinct(), scenarios, "scenario")
    routes = future_routes.select("tr_line", "vertices").join(active, "tr_line").drop("tr_line")
    future = N.future_links(N.per_scenario(links, scenarios), routes)
    return durable(N.scenario_network(base, future))


def scenario_summary(itin: DataFrame, lengths: DataFrame, runs: DataFrame) -> DataFrame:
    """Line summary per scenario and period; the scenario is made part of the node and run keys."""
    tag = F.col("scenario").cast("string")

    def keyed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        return df.withColumns({c: F.concat_ws("|", tag, F.col(c).cast("string")) for c in cols})

    runs = runs.withColumn("tr_line", F.concat_ws("|", "scenario", "tod", "tr_line"))
    rows = itin.withColumn("tr_line", F.concat_ws("|", "scenario", "tod", "tr_line"))
    rows = keyed(rows, ["itin_a", "itin_b"])
    return line_summary(rows, keyed(lengths, ["a", "b"]), runs, (*BY, "mode", "longname"))


def write_scenarios(built: Scenario, vertices: DataFrame, path: str, date: str, layout: RunLayout = RUNS) -> None:
    """The files of every scenario and period below `path`.

    Text folders are partitioned by scenario and period; their part files follow each other in order.
    """
    spark = built.itinerary.sparkSession
    # One header per scenario asked for and period, with or without runs.
    keys = [(s, p) for s in built.scenarios for p in N.ALL_TODS]

    def header(texts) -> DataFrame:
        data = [(s, p, i, line) for s, p in keys for i, line in enumerate(texts(s, p))]
        return spark.createDataFrame(data, "scenario INT, tod INT, no INT, line STRING")

    def text(name: str, body: DataFrame, order: list[str], texts) -> None:
        rows = with_header(body, header(texts), BY, order)
        write_text(rows, f"{path}/{name}", ["_sec", "_no", *order], BY)

    heads = built.runs.select(*BY, "tr_line", "headway", "description", "veh_type", "speed")
    rows = I.mark_ends(built.itinerary.join(heads, [*BY, "tr_line"]), layout, by=BY)
    text("lines", L.transit_lines(rows, BY), ["tr_line", "it_order", "part"], lambda s, p: L.transit_header(s, p, date))
    nodes = built.nodes if "zone" in built.nodes.columns else built.nodes.withColumn("zone", F.lit(None).cast("int"))
    text("node_attributes", L.node_attributes(nodes, BY), ["node"], lambda s, p: L.node_attributes_header(s, p, date))
    text("network", L.network_file(nodes, built.links, BY), ["section", "k1", "k2"], lambda s, p: L.network_header(s, p, date))
    pairs = built.links.select("scenario", "a", "b").distinct()
    shapes = L.link_shapes(pairs, vertices, ("scenario",))
    first = [(s, i, line) for s in built.scenarios for i, line in enumerate(L.link_shape_header(s, date))]
    shapes = with_header(shapes, spark.createDataFrame(first, "scenario INT, no INT, line STRING"), ("scenario",), ["a", "b", "ord"])
    write_text(shapes, f"{path}/link_shapes", ["_sec", "_no", "a", "b", "ord"], ("scenario",))
    write_csv(pairs, f"{path}/links", False, ["scenario", "a", "b"])
    write_csv(built.summary, f"{path}/summary", True, [*BY, "mode", "longname"])
    if built.report is not None:
        said = built.report.withColumnRenamed("message", "line")
        write_text(said, f"{path}/report", ["section", "seq", "line"], BY)
