"""Scenario networks by time of day.

Scenarios and periods are columns: a row is exploded to the scenarios and periods it belongs to, and all
of them run through one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import core as C
from .links import both_directions, end_nodes
from .spatial import sharing_segment, sharing_vertices
from .tables import first_per_key, union_all

ALL_TODS = (1, 2, 3, 4)


def per_scenario(df: DataFrame, scenarios: Sequence[int], codes: str | None = None, name: str = "scenario") -> DataFrame:
    """One copy of each row per scenario; with `codes`, only the scenarios its digit set names."""
    opts = F.array(*[F.lit(s) for s in scenarios])
    if codes is not None:
        opts = F.filter(opts, lambda s: F.coalesce(F.col(codes), F.lit("")).contains(s.cast("string")))
    return df.withColumn("_s", opts).drop(*([codes] if codes else [])).withColumn(name, F.explode("_s")).drop("_s")


def closed_movers(movers: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """(scenario, a, b, open_in, notes) of people-mover links that do not run in a scenario."""
    opts = F.filter(
        F.array(*[F.lit(s) for s in scenarios]),
        lambda s: ~F.coalesce(F.col("scenario"), F.lit("")).contains(s.cast("string")),
    )
    rows = movers.select(F.explode(opts).alias("_s"), "anode", "bnode", F.col("scenario").alias("open_in"), "notes")
    return rows.select(F.col("_s").alias("scenario"), F.col("anode").alias("a"), F.col("bnode").alias("b"), "open_in", "notes")


def without_closed_movers(links: DataFrame, closed: DataFrame) -> DataFrame:
    return links.join(closed.select("scenario", "a", "b").distinct(), ["scenario", "a", "b"], "left_anti")


def future_links(links: DataFrame, routes: DataFrame, same_vertices: bool = False) -> DataFrame:
    """Links along an active future route of their scenario; both sides carry scenario and vertices.

    Routes that were built from the links themselves (`same_vertices`) are told by their vertices, which takes less work.
    """
    return (sharing_vertices if same_vertices else sharing_segment)(links, routes, by=("scenario",))


def scenario_network(base: DataFrame, future: DataFrame) -> DataFrame:
    """Base links and future links of each scenario; a pair in both keeps the base link."""
    cols = [c for c in base.columns if c in future.columns]
    both = union_all(base.select(*cols, F.lit(0).alias("_src")), future.select(*cols, F.lit(1).alias("_src")))
    return first_per_key(both, ["scenario", "a", "b"], ["_src"]).drop("_src")


def coded_by_period(coded: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """Coded routes, one copy per scenario and period of their digit sets."""
    rows = per_scenario(coded, scenarios, "scenario")
    tods = F.filter(F.array(*[F.lit(p) for p in ALL_TODS]), lambda p: F.col("_t").contains(p.cast("string")))
    return rows.withColumnRenamed("tod", "_t").withColumn("tod", F.explode(tods)).drop("_t")


def tod_runs(base: DataFrame, coded: DataFrame, scenarios: Sequence[int]) -> DataFrame:
    """Runs per scenario and period: base runs by start hour, and action-1 routes by their coded sets.

    Base runs: tr_line, mode, headway, strthour and more; coded: tr_line, mode, headway (text), scenario, tod,
    action. A line in both keeps the base run. `acthdwy` is the coded headway of the period.
    """
    own = base.withColumns({"tod": C.time_of_day("strthour"), "acthdwy": F.lit(None).cast("double")})
    own = own.withColumn("headway", F.col("headway").cast("double"))
    own = per_scenario(own, scenarios).withColumn("_src", F.lit(0))
    new = coded_by_period(coded.filter(F.col("action") == 1), scenarios).drop("action")
    value = C.period_value("headway", F.col("tod"))
    # Two steps: a lambda over `headway` must not sit beside its replacement in one projection.
    new = new.withColumn("acthdwy", value).withColumns({"headway": F.col("acthdwy"), "_src": F.lit(1)})
    both = own.unionByName(new, allowMissingColumns=True)
    return first_per_key(both, ["scenario", "tod", "tr_line"], ["_src"]).drop("_src")


def tod_itineraries(itin: DataFrame, runs: DataFrame) -> DataFrame:
    """Segments of every run of a scenario and period, with dwell time and a layover of at least '0'."""
    rows = itin.join(runs.select("scenario", "tod", "tr_line"), "tr_line")
    lay = F.coalesce(F.when(F.trim("layover") != "", F.col("layover")), F.lit("0"))
    return rows.withColumns({"layover": lay, "dw_time": C.dwell_time("dw_code")})


def used_links(directed: DataFrame, itin: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Directed links some itinerary runs over."""
    pairs = itin.select(*by, F.col("itin_a").alias("a"), F.col("itin_b").alias("b")).distinct()
    return directed.join(pairs, [*by, "a", "b"], "left_semi")


def auxiliary_links(
    directed: DataFrame, used: DataFrame, by: Sequence[str] = (), max_zone: int = C.MAX_ZONE
) -> DataFrame:
    """Links for neither CTA nor Metra that touch service: both ends occur more than three times.

    Occurrences count over the ends of used and of all auxiliary links; a zone centroid counts at least four.
    """
    aux = directed.filter(~(C.has_code("modes1", "C") | C.has_code("modes1", "M")))
    cols = [*by, "a", "b"]
    nodes = end_nodes(used.select(*cols).unionByName(aux.select(*cols))).groupBy(*by, "node").agg(F.count(F.lit(1)).alias("_n"))
    enough = nodes.filter((F.col("_n") > 3) | (F.col("node") <= max_zone)).select(*by, "node")
    for end in ("a", "b"):
        aux = aux.join(enough.withColumnRenamed("node", end), [*by, end], "left_semi")
    return aux


def service_network(
    network: DataFrame, itin: DataFrame, by: Sequence[str] = (), max_zone: int = C.MAX_ZONE
) -> DataFrame:
    """Used mainline links plus connected auxiliary links, directed."""
    directed = both_directions(network).drop("directions", "opposite")
    used = used_links(directed, itin, by)
    return used.unionByName(auxiliary_links(directed, used, by, max_zone))


def network_node_table(
    links: DataFrame, nodes: DataFrame, by: Sequence[str] = (), scenario: int | Column = 1, max_zone: int = C.MAX_ZONE
) -> DataFrame:
    """Nodes of the network above the zone range, with the parking values of the scenario."""
    keys = end_nodes(links.select(*by, "a", "b")).select(*by, "node").filter(F.col("node") > max_zone).distinct()
    rows = keys.join(nodes, "node")
    values = {
        n: C.scenario_value(F.coalesce(f"ftr_{n}", F.lit("")), scenario, F.col(n).cast("double")) for n in ("pspace", "pcost")
    }
    return rows.withColumns(values)
