"""Text layouts of the output files, as rows (sort keys.., line).

Every layout keeps its order in columns, so the writer can range-partition on them and no file is put
together in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import dwell_text, number_text


def _pad(c: Column, width: int) -> Column:
    return F.rpad(c, F.greatest(F.length(c), F.lit(width)), F.lit(" "))


def _join(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _str(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("."))


def transit_lines(itin: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Line file body: (by.., tr_line, it_order, part, line).

    `itin` has the run columns (mode, veh_type, headway, speed, description) and flags is_first, is_last.
    """
    name = _join("'", F.regexp_replace("tr_line", " ", ""), "'")
    descr = _join("'", F.substring(F.translate("description", "'", ""), 1, 20), "'")
    head = _join(
        "a  ", name, "   ", F.col("mode"), "   ", _str("veh_type"), "   ", number_text("headway"), "   ", number_text("speed"), "   ", descr
    )
    times = _join("ttf=1  us1=", _pad(number_text("trv_time"), 7), "us2=", number_text(F.coalesce("zn_fare", F.lit(0.0))))
    a, b = _pad(_str("itin_a"), 8), _pad(_str("itin_b"), 8)
    dwell = _pad(dwell_text("dw_code", "dw_time"), 11)
    mid_lay = ~F.col("is_first") & ~F.col("is_last") & ~F.col("layover").isin("0", "") & F.col("layover").isNotNull()
    seg = F.when(F.col("is_first") & F.col("is_last"), _join("    ", a, times)).otherwise(
        _join("    ", a, dwell, times, F.when(mid_lay, _join("   lay=", F.col("layover"))).otherwise(""))
    )
    tail = _join("    ", b, "lay=", F.coalesce("layover", F.lit("")))
    lines = F.concat(
        F.when(F.col("is_first"), F.array(head, F.lit("    path=no"), F.lit("    dwt=0.01"))).otherwise(F.array().cast("array<string>")),
        F.array(seg),
        F.when(F.col("is_last"), F.array(tail)).otherwise(F.array().cast("array<string>")),
    )
    rows = itin.select(*by, "tr_line", "it_order", F.posexplode(lines).alias("part", "line"))
    return rows


def transit_header(scenario: int, tod: int, date: str) -> list[str]:
    return [
        f"c RAIL TRANSIT BATCHIN FILE FOR SCENARIO {scenario}00 TOD {tod}", f"c {date}",
        "c us1 holds segment travel time, us2 holds zone fare", "t lines init",
    ]


def node_attributes(nodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    line = _join("  ", _str("node"), "   ", number_text("pspace"), "   ", number_text("pcost"), "   ", _str("zone"))
    return nodes.select(*by, "node", line.alias("line"))


def node_attributes_header(scenario: int, tod: int, date: str) -> list[str]:
    return [f"  inode  @pspace  @pcost  @zone - {date} - NODE EXTRA ATTRIBUTES FOR SCENARIO {scenario}00 TOD {tod}"]


def network_file(nodes: DataFrame, links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., section, k1, k2, line): nodes are section 1, the blank line and the record in front of the links 2, links 3."""
    xy = [F.format_string("%.6f", F.col(c)) for c in ("point_x", "point_y")]
    node = _join("a  ", _str("node"), "  ", xy[0], " ", xy[1], "   0  0  0 ", F.coalesce("label", F.lit("")))
    link = _join("a   ", _str("a"), "   ", _str("b"), "   ", number_text("miles"), "   ", F.coalesce("modes1", F.lit("")), "   1  0  1")
    n = nodes.select(*by, F.lit(1).alias("section"), F.col("node").alias("k1"), F.lit(0).alias("k2"), node.alias("line"))
    m = links.select(*by, F.lit(3).alias("section"), F.col("a").alias("k1"), F.col("b").alias("k2"), link.alias("line"))
    parts = n.select(*by).unionByName(m.select(*by)).distinct() if by else nodes.sparkSession.range(1)
    records = F.posexplode(F.array(F.lit(""), F.lit("t links"))).alias("k2", "line")
    between = parts.select(*by, F.lit(2).alias("section"), F.lit(0).alias("k1"), records)
    return n.unionByName(between).unionByName(m)


def network_header(scenario: int, tod: int, date: str) -> list[str]:
    return [
        f"c RAIL NETWORK BATCHIN FILE FOR TRANSIT SCENARIO {scenario}00 TOD {tod}.", f"c  {date}",
        "c a  node  x  y ui1 ui2 ui3 label", "t nodes",
    ]


def link_shapes(links: DataFrame, vertices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., a, b, ord, line): an `r` record per link, then its vertices."""
    keys = links.select(*by, "a", "b").distinct()
    head = keys.select(*by, "a", "b", F.lit(0).alias("ord"), F.concat_ws(" ", F.lit("r"), "a", "b").alias("line"))
    xy = [F.format_string("%.6f", F.col(c)) for c in ("x", "y")]
    body = keys.join(vertices, ["a", "b"]).select(
        *by, "a", "b", "ord", F.concat_ws(" ", F.lit("a"), "a", "b", "ord", *xy).alias("line")
    )
    return head.unionByName(body)


def link_shape_header(scenario: int, date: str) -> list[str]:
    return [f"c RAIL LINK SHAPE FILE FOR SCENARIO {scenario}", f"c {date}", "t linkvertices"]


def route_vertex_text(vertices: DataFrame) -> DataFrame:
    """`rte;x;y;m` rows with their order (rte, it_order, ord)."""
    parts = [F.format_string("%.6f", "x"), F.format_string("%.5f", "y"), F.format_string("%.5f", "m")]
    return vertices.select("rte", "it_order", "ord", F.concat_ws(";", F.col("rte"), *parts).alias("line"))


def dropped_routes(lines: DataFrame, date: str) -> DataFrame:
    body = lines.select(F.lit(1).alias("section"), "tr_line", F.col("tr_line").alias("line"))
    head = lines.sparkSession.createDataFrame([(0, "", f"{date} - Routes Deleted from Coding:")], body.schema)
    return head.unionByName(body)


# Route attribute columns of the three layouts: table column and output name.
FEED_ROUTE = {
    "tr_line": "line1", "description": "desc1", "mode": "mode1", "veh_type": "type1", "headway": "hdwy1", "speed": "speed1",
    "feedline": "fdline", "route_id": "r_id", "longname": "rln", "direction": "dir", "terminal": "term",
    "start": "start", "strthour": "strthour", "am_share": "ampct",
}
FUTURE_ROUTE = {
    "tr_line": "line1", "description": "desc1", "mode": "mode1", "veh_type": "type1", "headway": "hdwy1", "speed": "speed1",
    "tod": "tod1", "scenario": "scen1", "action": "action1", "tip_id": "tipid1", "rsp_id": "rspid1",
    "completion_year": "comp1", "notes": "notes1",
}


def route_table(routes: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Columns of the layout in order; ones the table lacks are null."""
    have = set(routes.columns)
    return routes.select(*[(F.col(c) if c in have else F.lit(None).cast("string")).alias(n) for c, n in layout.items()])
