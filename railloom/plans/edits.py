"""Edit propagation: changed links and nodes through node tables, itineraries and route shapes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import edits as E
from ..operators import geometry as G
from ..operators import qc as Q
from ..operators.links import directed_rail_links, drawn_first, link_ends
from ..operators.sequence import RUNS, RunLayout
from ..operators.spatial import nearest_node
from ..operators.tables import reconcile
from ..session import durable


@dataclass(frozen=True)
class Edited:
    nodes: DataFrame
    deleted: DataFrame
    pieces: DataFrame
    itinerary: DataFrame
    shapes: DataFrame
    violations: DataFrame


SYSTEM = "system"


def propagate_edits(
    links: DataFrame, nodes: DataFrame, routes: DataFrame, itinerary: DataFrame, layout: RunLayout = RUNS, strict: bool = True
) -> Edited:
    """`links` are the edited links (a, b, orig_fid, miles, shape_leng, vertices, ...), `nodes` the old nodes.

    Several route systems share a job: where routes and itineraries carry a `system` column, it is a part of
    every run's key. With `strict`, the job ends when a check reports anything.
    """
    by = [SYSTEM] if SYSTEM in itinerary.columns else []
    ends = durable(link_ends(links))
    pieces, _ = E.split_pieces(ends, nodes)
    pieces = durable(pieces)
    new_nodes, deleted = E.refresh_nodes(ends, nodes)
    deleted = durable(deleted)
    kept, only = reconcile(itinerary, routes, [*by, "tr_line"])
    split = durable(E.apply_splits(kept, pieces, True, layout, by))
    final = durable(E.delete_nodes(split, deleted, layout, by=by))
    shapes = G.route_vertices(final, drawn_first(directed_rail_links(_renamed(links, pieces))), layout, by)
    number = F.when(F.col("which") == "start", F.col("a")).otherwise(F.col("b"))
    marked = E.split_ends(ends, nodes).filter(~F.col("fresh")).select(number.alias("node"), "point_x", "point_y")
    found = Q.violations(
        Q.one_sided_routes(only, by), Q.itinerary_gaps(kept, layout, by), Q.several_coordinates(marked), Q.generic_uses_deleted(split, deleted, by)
    )
    if strict:
        Q.assert_clean(found)
    return Edited(new_nodes, deleted, pieces, final, shapes, found)


def _renamed(links: DataFrame, pieces: DataFrame) -> DataFrame:
    """Edited links with the numbers and miles of their pieces."""
    temp = pieces.select("orig_fid", "tempa", "tempb", "newmile")
    return links.join(temp, "orig_fid", "left").withColumns(
        {"a": F.coalesce("tempa", "a"), "b": F.coalesce("tempb", "b"), "miles": F.coalesce("newmile", "miles")}
    )


def propagate_future(
    links: DataFrame, old_nodes: DataFrame, itinerary: DataFrame, stored: DataFrame, edited: Edited, layout: RunLayout = RUNS
) -> tuple[DataFrame, DataFrame]:
    """The same edits on future lines: their itinerary, and the vertices of their routes.

    `itinerary` carries `action`, `stored` the drawn vertices (tr_line, seq, x, y). Splits and deletions go
    through the segments, orders start again by action, and shapes follow the chain of nodes on the old drawing.
    """
    by = [SYSTEM] if SYSTEM in itinerary.columns else []
    split = durable(E.apply_splits(itinerary, edited.pieces, False, layout, by))
    left = durable(E.delete_nodes(split, edited.deleted, layout, True, by))
    ordered = E.future_orders(left, layout, by)
    directed = drawn_first(directed_rail_links(_renamed(links, edited.pieces)))
    return ordered, G.rebuild_future_routes(stored, old_nodes, edited.pieces, directed, layout, by)


def renumber(links: DataFrame, nodes: DataFrame, itinerary: DataFrame, tolerance: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Link ends and itineraries take the numbers of the nodes they coincide with."""
    found = nearest_node(link_ends(links), nodes, ["a", "b", "which"], tolerance)
    changed = durable(E.renumber_links(links, found))
    itin = E.renumber_itinerary(itinerary, changed.select("a", "b", "newa", "newb"))
    new = changed.withColumns({"a": F.col("newa"), "b": F.col("newb")}).drop("newa", "newb")
    return new, itin
