"""Measured route polylines from itineraries and link vertices.

The rounded distance of a vertex along its link does not depend on the run, so it is worked out once
per link. A run then only needs one running sum over its segments, and vertices appear last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import round_half_away
from .edits import order_pieces
from .sequence import RUNS, RunLayout, scan

FEET_PER_MILE = 5280


def measured_links(directed: DataFrame) -> DataFrame:
    """Directed links with `pts` (x, y, mo, dup): offset along the link and repeat of the vertex before."""
    v, n = F.col("vertices"), F.size("vertices")
    step = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when(
            i > 1,
            F.hypot(
                F.element_at(v, i)["x"] - F.element_at(v, F.greatest(i - 1, F.lit(1)))["x"],
                F.element_at(v, i)["y"] - F.element_at(v, F.greatest(i - 1, F.lit(1)))["y"],
            )
            / FEET_PER_MILE,
        ).otherwise(0.0),
    )
    rows = directed.select("a", "b", "miles", "vertices", step.alias("_step"))
    rows = rows.withColumn("_tot", F.aggregate("_step", F.lit(0.0), lambda s, d: s + d))
    part = F.transform("_step", lambda d: F.coalesce(round_half_away(F.try_divide(d, F.col("_tot")) * F.col("miles"), 5), F.lit(0.0)))
    rows = rows.withColumn("_part", part)
    start = F.struct(F.lit(0.0).alias("m"), F.array().cast("array<double>").alias("all"))
    offsets = F.aggregate(
        "_part",
        start,
        lambda acc, d: F.struct((acc["m"] + d).alias("m"), F.concat(acc["all"], F.array(acc["m"] + d)).alias("all")),
    )["all"]
    rows = rows.withColumn("_off", offsets)
    pts = F.transform(
        F.sequence(F.lit(1), F.size("vertices")),
        lambda i: F.struct(
            F.element_at("vertices", i)["x"].alias("x"),
            F.element_at("vertices", i)["y"].alias("y"),
            F.element_at("_off", i).alias("mo"),
            ((i > 1) & (F.element_at("vertices", i) == F.element_at("vertices", F.greatest(i - 1, F.lit(1))))).alias("dup"),
        ),
    )
    return rows.select("a", "b", "miles", pts.alias("pts"), F.element_at("_off", -1).alias("length"))


def route_vertices(itin: DataFrame, directed: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """(by.., tr_line, it_order, ord, x, y, m): vertices along each run, repeats between segments left out."""
    shapes = measured_links(directed).withColumnsRenamed({"a": "itin_a", "b": "itin_b"}).drop("miles")
    segs = itin.select(*by, "tr_line", "it_order", "itin_a", "itin_b").join(shapes, ["itin_a", "itin_b"])
    end = F.element_at("pts", -1)
    segs = scan(
        segs, [*by, "tr_line"], ["it_order"], bucket=layout.bucket("it_order"),
        running={"_upto": F.col("length")}, lag={"_px": end["x"], "_py": end["y"]},
    )
    rows = segs.select(
        *by, "tr_line", "it_order", (F.col("_upto") - F.col("length")).alias("_base"), "_px", "_py", F.posexplode("pts").alias("_p", "_v")
    )
    again = F.col("_v.dup") | (
        (F.col("_p") == 0) & F.coalesce((F.col("_v.x") == F.col("_px")) & (F.col("_v.y") == F.col("_py")), F.lit(False))
    )
    return rows.filter(~again).select(
        *by, "tr_line", "it_order", (F.col("_p") + 1).alias("ord"), F.col("_v.x").alias("x"), F.col("_v.y").alias("y"),
        (F.col("_base") + F.col("_v.mo")).alias("m"),
    )


def reuse_stored(
    stored: DataFrame, itin: DataFrame, unchanged: DataFrame, directed: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()
) -> DataFrame:
    """Stored vertices of unchanged lines, rebuilt ones of all others: (by.., tr_line, x, y, m)."""
    key = [*by, "tr_line"]
    keys = unchanged.select(*key).distinct()
    kept = stored.join(keys, key, "left_semi").select(*key, "x", "y", round_half_away("m", 5).alias("m"))
    rest = itin.join(keys, key, "left_anti")
    return kept.unionByName(route_vertices(rest, directed, layout, by).select(*key, "x", "y", "m"))


def chain_nodes(vertices: DataFrame, nodes: DataFrame, by: list[str], seq: str, layout: RunLayout = RUNS) -> DataFrame:
    """Consecutive nodes along a stored polyline: (by.., seq, itin_a, itin_b).

    Vertices meet nodes on rounded coordinates; what lies between two nodes is passed over.
    """
    keyed = nodes.select("node", F.round("point_x", 6).alias("_x"), F.round("point_y", 5).alias("_y"))
    at = vertices.withColumns({"_x": F.round("x", 6), "_y": F.round("y", 5)}).join(keyed, ["_x", "_y"]).drop("_x", "_y")
    seen = scan(at, by, [seq], bucket=layout.bucket(seq), lag={"itin_a": F.col("node")})
    return seen.filter(F.col("itin_a").isNotNull()).withColumnRenamed("node", "itin_b")


def rebuild_future_routes(
    stored: DataFrame, old_nodes: DataFrame, pieces: DataFrame, directed: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()
) -> DataFrame:
    """Polylines of future lines after edits.

    Stored vertices give the node chain before the edit, split links put their pieces into it, and the
    vertices of the new links are measured along the result.
    """
    key = [*by, "tr_line"]
    chain = chain_nodes(stored, old_nodes, key, "seq", layout)
    keyed = order_pieces(pieces).select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "o", "tempa", "tempb")
    rows = chain.select(*key, "seq", "itin_a", "itin_b").join(keyed, ["itin_a", "itin_b"], "left")
    rows = rows.withColumns(
        {"itin_a": F.coalesce("tempa", "itin_a"), "itin_b": F.coalesce("tempb", "itin_b"), "o": F.coalesce("o", F.lit(0))}
    )
    rows = scan(rows, key, ["seq", "o"], bucket=layout.bucket("seq"), number="it_order")
    return route_vertices(rows, directed, layout, by)
