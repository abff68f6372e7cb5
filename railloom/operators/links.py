"""Links, directions and vertices.

A link carries `a, b, miles, directions, modes1, modes2` and, where geometry matters, `vertices`
(array of x, y in drawing order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import MAX_ZONE, has_code, round_half_away
from .tables import first_per_key, rows_from


def _rail(modes: str):
    return has_code(modes, "C") | has_code(modes, "M")


def both_directions(links: DataFrame) -> DataFrame:
    """Each link, and its opposite when it runs both ways; the opposite takes the second mode set."""
    forward = {"a": "a", "b": "b", "modes1": "modes1", "opposite": F.lit(False)}
    backward = {"a": "b", "b": "a", "modes1": "modes2", "opposite": F.lit(True)}
    both = rows_from(links.withColumn("_keep", F.col("modes2")), forward, backward)
    return both.filter(~F.col("opposite") | (F.col("directions") == 2)).drop("_keep", "modes2")


def directed_rail_links(links: DataFrame) -> DataFrame:
    """Links trains may use, per direction; vertices of the opposite direction are reversed."""
    rail = links.filter(_rail("modes1")).withColumn("miles", round_half_away("miles", 2))
    both = both_directions(rail).filter(_rail("modes1"))
    if "vertices" in links.columns:
        both = both.withColumn("vertices", F.when(F.col("opposite"), F.reverse("vertices")).otherwise(F.col("vertices")))
    return both


def drawn_first(directed: DataFrame) -> DataFrame:
    """One link per directed pair; the drawn direction wins over a derived one."""
    return first_per_key(directed, ["a", "b"], ["opposite", "miles"])


def link_miles(directed: DataFrame) -> DataFrame:
    """One length per directed pair; the drawn direction wins over a derived one."""
    cols = directed.select("a", "b", "miles", "opposite")
    return first_per_key(cols, ["a", "b"], ["opposite", "miles"]).drop("opposite")


def vertex_rows(links: DataFrame) -> DataFrame:
    """(a, b, ord, x, y) of directed or undirected links."""
    keep = [c for c in links.columns if c != "vertices"]
    rows = links.select(*keep, F.posexplode("vertices").alias("_p", "_v"))
    return rows.select(*keep, (F.col("_p") + 1).alias("ord"), F.col("_v.x").alias("x"), F.col("_v.y").alias("y"))


def two_way_vertices(links: DataFrame) -> DataFrame:
    """Vertices of every link in both directions, whatever its coded directions; shape files need both."""
    n = F.size("vertices")
    rows = links.select("a", "b", n.alias("_n"), F.posexplode("vertices").alias("_p", "_v"))
    rows = rows.select("a", "b", "_n", "_p", F.col("_v.x").alias("x"), F.col("_v.y").alias("y"))
    both = rows_from(
        rows,
        {"a": "a", "b": "b", "ord": F.col("_p") + 1},
        {"a": "b", "b": "a", "ord": F.col("_n") - F.col("_p")},
    )
    return both.select("a", "b", "ord", "x", "y")


def link_ends(links: DataFrame) -> DataFrame:
    """First and last vertex of each link with the coordinates the node tables are built from."""
    head, tail = F.element_at("vertices", 1), F.element_at("vertices", -1)
    keep = [c for c in links.columns if c != "vertices"]
    ends = links.select(*keep, head.alias("_h"), tail.alias("_t"))
    return rows_from(
        ends,
        {"which": F.lit("start"), "point_x": F.col("_h.x"), "point_y": F.col("_h.y")},
        {"which": F.lit("end"), "point_x": F.col("_t.x"), "point_y": F.col("_t.y")},
    ).drop("_h", "_t")


def xy_points(df: DataFrame, x: str = "point_x", y: str = "point_y") -> DataFrame:
    """Point column from two coordinate columns."""
    return df.withColumn("point", F.struct(F.col(x).alias("x"), F.col(y).alias("y")))


def end_nodes(links: DataFrame) -> DataFrame:
    """One row per end of a link."""
    return rows_from(links, {"node": "a"}, {"node": "b"})


def network_nodes(links: DataFrame, max_zone: int = MAX_ZONE) -> DataFrame:
    return end_nodes(links.select("a", "b")).select("node").filter(F.col("node") > max_zone).distinct()
