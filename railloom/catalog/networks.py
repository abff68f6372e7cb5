"""Edits and geometry."""

from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import edits as E
from ..operators import geometry as G
from ..operators import itinerary as I
from ..operators import spatial as X
from ..operators.links import directed_rail_links, drawn_first, link_ends, two_way_vertices, xy_points
from .registry import query, rnd

# --- split and deleted nodes --------------------------------------------------------------------------

_SPLIT = """g AS (SELECT a, b FROM fx_link_end GROUP BY a, b HAVING count(*) > 2),
 m AS MATERIALIZED (SELECT e.*, g.a IS NOT NULL AS split, g.a IS NOT NULL AND n.node IS NULL AS fresh FROM fx_link_end e
   LEFT JOIN g ON g.a = e.a AND g.b = e.b LEFT JOIN fx_node n ON n.point_x = e.point_x AND n.point_y = e.point_y),
 tmp AS MATERIALIZED (SELECT point_x, point_y, CAST(90000 + row_number() OVER (ORDER BY point_x, point_y) AS INT) AS node
   FROM (SELECT DISTINCT point_x, point_y FROM m WHERE fresh) q)"""


@query("w13_temporary_nodes", f"WITH {_SPLIT} SELECT {rnd('point_x', 3)} AS point_x, {rnd('point_y', 3)} AS point_y, node FROM tmp")
def temporary_nodes(t):
    temp = X.number_points(E.split_ends(t["fx_link_end"], t["fx_node"]).filter("fresh"))
    return temp.select(C.round_half_away("point_x", 3).alias("point_x"), C.round_half_away("point_y", 3).alias("point_y"), "node")


@query(
    "d13_split_links",
    f"""WITH {_SPLIT}, p AS (SELECT m.orig_fid, m.a, m.b, max(miles) AS miles, max(shape_leng) AS len,
          max(CASE WHEN which = 'start' THEN t.node END) AS ta, max(CASE WHEN which = 'end' THEN t.node END) AS tb
        FROM m LEFT JOIN tmp t ON t.point_x = m.point_x AND t.point_y = m.point_y AND m.fresh WHERE split GROUP BY m.orig_fid, m.a, m.b),
      f AS (SELECT a, b FROM m WHERE fresh GROUP BY a, b)
      SELECT orig_fid, p.a, p.b, {rnd("len / sum(len) OVER (PARTITION BY p.a, p.b) * miles", 2)} AS newmile,
        coalesce(ta, p.a) AS tempa, coalesce(tb, p.b) AS tempb FROM p JOIN f ON f.a = p.a AND f.b = p.b""",
)
def split_links(t):
    return E.split_pieces(t["fx_link_end"], t["fx_node"])[0]


@query(
    "d14_refreshed_nodes",
    f"""WITH {_SPLIT}, k AS (SELECT point_x, point_y, max(CASE WHEN fresh THEN 0 WHEN which = 'start' THEN a ELSE b END) AS node FROM m GROUP BY 1, 2)
      SELECT k.node, {rnd("k.point_x", 3)} AS point_x, {rnd("k.point_y", 3)} AS point_y, coalesce(n.pspace, 0) AS pspace,
        coalesce(n.pcost, 0) AS pcost, n.label, n.point_x AS point_x0, n.point_y AS point_y0 FROM k LEFT JOIN fx_node n ON n.node = k.node""",
)
def refreshed_nodes(t):
    new, _ = E.refresh_nodes(t["fx_link_end"], t["fx_node"])
    xy = {"point_x": C.round_half_away("point_x", 3), "point_y": C.round_half_away("point_y", 3)}
    return new.withColumns(xy).select("node", "point_x", "point_y", "pspace", "pcost", "label", "point_x0", "point_y0")


_ORDERED = """pc AS (SELECT a, b, o, n, tempa, tempb, newmile FROM fx_piece UNION ALL SELECT b, a, n + 1 - o, n, tempb, tempa, newmile FROM fx_piece),
 op AS MATERIALIZED (SELECT *, coalesce(sum(newmile) OVER (PARTITION BY a, b ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x,
   sum(newmile) OVER (PARTITION BY a, b) AS tot FROM pc)"""
SPLIT_ITIN = f"""{_ORDERED},
 j AS (SELECT i.*, p.o, p.n, p.tempa, p.tempb, p.newmile, p.x, CASE WHEN p.o IS NULL THEN i.trv_time ELSE {rnd("i.trv_time * (p.newmile / p.tot)", 2)} END AS trv,
     CASE WHEN p.o > 1 THEN {rnd("i.f_meas + p.x", 2)} ELSE i.f_meas END AS f2
   FROM fx_mitin i LEFT JOIN op p ON p.a = i.itin_a AND p.b = i.itin_b),
 st AS (SELECT *, {rnd("trv * 60", 0)} AS step FROM j),
 sp AS (SELECT *, sum(step) OVER (PARTITION BY tr_line, it_order ORDER BY o) AS spent FROM st),
 cut AS (SELECT tr_line, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY it_order, coalesce(o, 0)) AS INT) AS it_order,
   CASE WHEN o > 1 THEN tempa ELSE itin_a END AS itin_a, CASE WHEN o < n THEN tempb ELSE itin_b END AS itin_b, dw_code,
   CASE WHEN o < n THEN '0' ELSE layover END AS layover, trv AS trv_time,
   CASE WHEN o IS NULL THEN dep_time ELSE dep_time + spent - step END AS dep_time,
   CASE WHEN o < n THEN dep_time + spent ELSE arr_time END AS arr_time,
   CASE WHEN o > 1 THEN 0.0::DOUBLE ELSE zn_fare END AS zn_fare, f2 AS f_meas,
   CASE WHEN o < n THEN {rnd("f2 + newmile", 2)} ELSE t_meas END AS t_meas FROM sp)"""


def pieces_of(t):
    return t["fx_piece"].select("a", "b", "tempa", "tempb", "newmile")


@query("d15_split_itineraries", f"WITH {SPLIT_ITIN} SELECT * REPLACE (CAST(dep_time AS DOUBLE) AS dep_time, CAST(arr_time AS DOUBLE) AS arr_time) FROM cut")
def split_itineraries(t):
    out = E.apply_splits(t["fx_mitin"], pieces_of(t), True, t.layout)
    return out.withColumns({n: F.col(n).cast("double") for n in ("dep_time", "arr_time")})


@query(
    "d16_future_orders",
    """SELECT tr_line, itin_a, itin_b, f_meas, CAST(CASE WHEN action IN (1, 5) THEN r WHEN action = 4 THEN CASE WHEN n % 2 = 0 THEN
          CASE WHEN r <= n / 2 THEN r - 1 - n / 2 ELSE 1000 + r - n / 2 END END ELSE 0 END AS INT) AS it_order
       FROM (SELECT *, 1 + CAST(substr(tr_line, 4, 7) AS BIGINT) % 7 AS action, row_number() OVER (PARTITION BY tr_line ORDER BY f_meas, it_order) AS r,
               count(*) OVER (PARTITION BY tr_line) AS n FROM fx_mitin) q""",
)
def future_orders(t):
    action = 1 + F.substring("tr_line", 4, 7).cast("bigint") % 7
    out = E.future_orders(t["fx_mitin"].withColumn("action", action), t.layout)
    return out.select("tr_line", "itin_a", "itin_b", "f_meas", "it_order")


@query(
    "w14_extension_orders",
    """SELECT tr_line, itin_a, itin_b, f_meas, CAST(CASE WHEN n % 2 = 0 THEN CASE WHEN r <= n / 2 THEN r - 1 - n / 2 ELSE 1000 + r - n / 2 END END AS INT) AS it_order
       FROM (SELECT *, row_number() OVER (PARTITION BY tr_line ORDER BY f_meas, it_order) AS r, count(*) OVER (PARTITION BY tr_line) AS n FROM fx_mitin) q""",
)
def extension_orders(t):
    return I.extension_orders(t["fx_mitin"], t.layout).select("tr_line", "itin_a", "itin_b", "f_meas", "it_order")


DELETED_SQL = f"""f AS (SELECT i.*, a.node IS NOT NULL AS sa, b.node IS NOT NULL AS sb FROM fx_mitin i
   LEFT JOIN fx_deleted a ON a.node = i.itin_a LEFT JOIN fx_deleted b ON b.node = i.itin_b),
 g AS (SELECT *, sum(CASE WHEN sa THEN 0 ELSE 1 END) OVER (PARTITION BY tr_line ORDER BY it_order) AS g,
   max(CASE WHEN sa OR sb THEN 1 ELSE 0 END) OVER (PARTITION BY tr_line) AS hit FROM f),
 mg AS (SELECT tr_line, max(it_order) AS it_order, max(hit) AS hit, arg_max(sb, it_order) AS opn, arg_min(itin_a, it_order) AS itin_a,
   arg_max(itin_b, it_order) AS itin_b, arg_min(f_meas, it_order) AS f_meas, arg_max(t_meas, it_order) AS t_meas, arg_min(dep_time, it_order) AS dep_time,
   arg_max(arr_time, it_order) AS arr_time, sum(zn_fare) AS zn_fare, sum(trv_time) AS trv_time, arg_max(layover, it_order) AS layover,
   arg_max(dw_code, it_order) AS dw_code FROM g WHERE g > 0 GROUP BY tr_line, g),
 kp AS (SELECT *, row_number() OVER w AS r, lead(1) OVER w IS NULL AS lst, sum(t_meas - f_meas) OVER w AS t FROM mg WHERE NOT opn
   WINDOW w AS (PARTITION BY tr_line ORDER BY it_order)),
 del AS (SELECT tr_line, CAST(CASE WHEN hit = 1 THEN r ELSE it_order END AS INT) AS it_order, itin_a, itin_b,
   CASE WHEN hit = 1 AND lst AND r > 1 THEN '0' ELSE dw_code END AS dw_code, CASE WHEN hit = 1 AND lst AND r > 1 THEN '3' ELSE layover END AS layover,
   {rnd("trv_time", 6)} AS trv_time, dep_time, arr_time, zn_fare, {rnd("CASE WHEN hit = 1 THEN t - (t_meas - f_meas) ELSE f_meas END", 6)} AS f_meas,
   {rnd("CASE WHEN hit = 1 THEN t ELSE t_meas END", 6)} AS t_meas FROM kp)"""


@query("d17_deleted_nodes", f"WITH {DELETED_SQL} SELECT * FROM del")
def deleted_nodes(t):
    out = E.delete_nodes(t["fx_mitin"], t["fx_deleted"], t.layout)
    return out.withColumns({n: C.round_half_away(n, 6) for n in ("trv_time", "f_meas", "t_meas")})


def _moved(node: str) -> str:
    return f"CASE WHEN {node} % 9 = 4 THEN {node} + 8990 ELSE {node} END"


_CHANGES = f"ch AS (SELECT a, b, {_moved('a')} AS newa, {_moved('b')} AS newb FROM fx_link)"


def renumbered_nodes(t):
    """Every ninth node got a new number, most of them in the junction range."""
    new = F.when(F.col("node") % 9 == 4, F.col("node") + 8990).otherwise(F.col("node"))
    return t["fx_node"].withColumn("node", new.cast("int"))


def link_changes(t):
    pts = link_ends(t["link_shape"].select("a", "b", "vertices"))
    found = X.nearest_node(pts, renumbered_nodes(t), ["a", "b", "which"], 0.5)
    return E.renumber_links(t["fx_link"].select("a", "b"), found)


@query("d18_renumbered_links", f"WITH {_CHANGES} SELECT a, b, newa, newb FROM ch")
def renumbered_links(t):
    return link_changes(t).select("a", "b", "newa", "newb")


@query(
    "d18_renumbered_itineraries",
    f"""WITH {_CHANGES}, bo AS (SELECT a, b, newa, newb, 0 AS k FROM ch WHERE a <> newa OR b <> newb UNION ALL SELECT b, a, newb, newa, 1 FROM ch WHERE a <> newa OR b <> newb),
      on1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY k) AS r FROM bo) q WHERE r = 1),
      u AS (SELECT tr_line, it_order, coalesce(newa, itin_a) AS itin_a, coalesce(newb, itin_b) AS itin_b, dw_code FROM fx_mitin LEFT JOIN on1 ON a = itin_a AND b = itin_b)
      SELECT tr_line, it_order, itin_a, itin_b, CASE WHEN itin_b BETWEEN 39001 AND 39999 THEN '1' ELSE dw_code END AS dw_code FROM u""",
)
def renumbered_itineraries(t):
    rows = t["fx_mitin"].select("tr_line", "it_order", "itin_a", "itin_b", "dw_code")
    return E.renumber_itinerary(rows, link_changes(t))


# --- geometry -----------------------------------------------------------------------------------------

_DIRV = """dv AS MATERIALIZED (SELECT a, b, miles, ord, x, y FROM fx_vertex WHERE contains(modes1, 'C') OR contains(modes1, 'M')
   UNION ALL SELECT v.b, v.a, miles, 4 - ord, x, y FROM fx_vertex v WHERE (contains(modes1, 'C') OR contains(modes1, 'M')) AND directions = 2
     AND NOT EXISTS (SELECT 1 FROM fx_link d WHERE d.a = v.b AND d.b = v.a AND (contains(d.modes1, 'C') OR contains(d.modes1, 'M'))))"""


def directed(t):
    """Both directions of every rail link; where both are drawn, each keeps its own drawing."""
    return drawn_first(directed_rail_links(t["link_shape"]))


ROUTE_SQL = f"""{_DIRV},
 v AS (SELECT i.tr_line, i.it_order, d.ord, d.x, d.y, d.miles, lag(d.x) OVER w AS vx, lag(d.y) OVER w AS vy FROM fx_itin i JOIN dv d ON d.a = i.itin_a AND d.b = i.itin_b
   WINDOW w AS (PARTITION BY i.tr_line, i.it_order ORDER BY d.ord)),
 sd AS (SELECT *, CASE WHEN vx IS NULL THEN 0 ELSE sqrt((x - vx) * (x - vx) + (y - vy) * (y - vy)) / 5280 END AS segdist FROM v),
 lt AS (SELECT *, sum(segdist) OVER (PARTITION BY tr_line, it_order) AS tot FROM sd),
 ms AS (SELECT *, sum({rnd("segdist / tot * miles", 5)}) OVER (PARTITION BY tr_line ORDER BY it_order, ord) AS m,
   lag(x) OVER (PARTITION BY tr_line ORDER BY it_order, ord) AS px, lag(y) OVER (PARTITION BY tr_line ORDER BY it_order, ord) AS py FROM lt)"""


@query("w05_vertex_measures", f"WITH {_DIRV}, q AS (SELECT a, b, ord, x, y, miles, lag(x) OVER w AS vx, lag(y) OVER w AS vy FROM dv WINDOW w AS (PARTITION BY a, b ORDER BY ord)), "
       f"sd AS (SELECT *, CASE WHEN vx IS NULL THEN 0 ELSE sqrt((x - vx) * (x - vx) + (y - vy) * (y - vy)) / 5280 END AS segdist FROM q), "
       f"lt AS (SELECT *, sum(segdist) OVER (PARTITION BY a, b) AS tot FROM sd) "
       f"SELECT a, b, ord, {rnd('mm', 5)} AS mo FROM (SELECT a, b, ord, sum({rnd('segdist / tot * miles', 5)}) OVER (PARTITION BY a, b ORDER BY ord) AS mm FROM lt) z")  # fmt: skip
def vertex_measures(t):
    rows = G.measured_links(directed(t)).select("a", "b", F.posexplode("pts").alias("_p", "_v"))
    return rows.select("a", "b", (F.col("_p") + 1).alias("ord"), C.round_half_away("_v.mo", 5).alias("mo"))


@query("g07_route_vertices", f"WITH {ROUTE_SQL} SELECT tr_line, it_order, ord, {rnd('x', 3)} AS x, {rnd('y', 3)} AS y, {rnd('m', 5)} AS m FROM ms WHERE px IS NULL OR NOT (x = px AND y = py)")
def route_vertices(t):
    out = G.route_vertices(t["fx_itin"], directed(t), t.layout)
    return out.withColumns({"x": C.round_half_away("x", 3), "y": C.round_half_away("y", 3), "m": C.round_half_away("m", 5)})


@query("w06_repeated_vertices", f"WITH {ROUTE_SQL} SELECT tr_line, count(*) AS n FROM ms WHERE px IS NULL OR NOT (x = px AND y = py) GROUP BY tr_line")
def repeated_vertices(t):
    out = G.route_vertices(t["fx_itin"], directed(t), t.layout)
    return out.groupBy("tr_line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g08_reused_geometry",
    f"""WITH {ROUTE_SQL} SELECT tr_line, {rnd("x", 3)} AS x, {rnd("y", 3)} AS y, {rnd("m", 5)} AS m FROM ms
        WHERE (px IS NULL OR NOT (x = px AND y = py)) AND CAST(substr(tr_line, 4, 7) AS BIGINT) % 4 <> 0
        UNION ALL SELECT tr_line, 1.0::DOUBLE, 2.0::DOUBLE, {rnd("it_order / 3.0", 5)} FROM fx_itin WHERE CAST(substr(tr_line, 4, 7) AS BIGINT) % 4 = 0""",
)
def reused_geometry(t):
    """Every fourth line keeps its stored shape, here one point per segment."""
    same = t["fx_itin"].filter(F.substring("tr_line", 4, 7).cast("bigint") % 4 == 0)
    stored = t["fx_itin"].select("tr_line", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), (F.col("it_order") / F.lit(3.0)).alias("m"))
    out = G.reuse_stored(stored, t["fx_itin"], same, directed(t), t.layout)
    return out.withColumns({"x": C.round_half_away("x", 3), "y": C.round_half_away("y", 3), "m": C.round_half_away("m", 5)})


@query(
    "g09_rebuilt_future_routes",
    f"""WITH {_ORDERED}, vx AS (SELECT i.tr_line, i.it_order, v.ord, v.x, v.y FROM fx_itin i JOIN fx_vertex v ON v.a = i.itin_a AND v.b = i.itin_b),
      nd AS (SELECT tr_line, it_order * 10 + ord AS seq, node FROM vx JOIN fx_node ON point_x = x AND point_y = y),
      ch AS (SELECT tr_line, seq, lag(node) OVER (PARTITION BY tr_line ORDER BY seq) AS ia, node AS ib FROM nd),
      pz AS (SELECT tr_line, seq, coalesce(o, 0) AS o, coalesce(tempa, ia) AS ia, coalesce(tempb, ib) AS ib FROM ch LEFT JOIN op ON op.a = ia AND op.b = ib WHERE ia IS NOT NULL),
      nx AS (SELECT tr_line, row_number() OVER (PARTITION BY tr_line ORDER BY seq, o) AS it_order, ia, ib FROM pz),
      {_DIRV},
      w AS (SELECT n.tr_line, n.it_order, d.ord, d.x, d.y, d.miles FROM nx n JOIN dv d ON d.a = n.ia AND d.b = n.ib)
      SELECT tr_line, CAST(it_order AS INT) AS it_order, count(*) AS n FROM (SELECT *, lag(x) OVER q AS px, lag(y) OVER q AS py FROM w
        WINDOW q AS (PARTITION BY tr_line ORDER BY it_order, ord)) z WHERE px IS NULL OR NOT (x = px AND y = py) GROUP BY tr_line, it_order""",
)
def rebuilt_future(t):
    shape = t["fx_vertex"].select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "ord", "x", "y")
    stored = t["fx_itin"].join(shape, ["itin_a", "itin_b"]).select("tr_line", (F.col("it_order") * 10 + F.col("ord")).alias("seq"), "x", "y")
    out = G.rebuild_future_routes(stored, t["fx_node"], pieces_of(t), directed(t), t.layout)
    return out.groupBy("tr_line", "it_order").agg(F.count(F.lit(1)).alias("n"))


_TWOWAY = "SELECT a, b, ord, x, y FROM fx_vertex UNION ALL SELECT b, a, 4 - ord, x, y FROM fx_vertex"


@query("g03_two_way_vertices", _TWOWAY)
def two_way(t):
    return two_way_vertices(t["link_shape"])


@query("w15_reverse_numbering", "SELECT b AS a, a AS b, 4 - ord AS ord, count(*) AS n FROM fx_vertex GROUP BY 1, 2, 3")
def reverse_numbering(t):
    shapes = t["link_shape"].select(F.col("b").alias("a"), F.col("a").alias("b"), F.reverse("vertices").alias("vertices"))
    rows = shapes.select("a", "b", (F.posexplode("vertices").alias("p", "v")))
    return rows.groupBy("a", "b", (F.col("p") + 1).alias("ord")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "g04_link_ends",
    """SELECT a, b, CASE WHEN ord = 1 THEN 'start' ELSE 'end' END AS which, x AS point_x, y AS point_y FROM fx_vertex WHERE ord <> 2""",
)
def ends(t):
    return link_ends(t["link_shape"].select("a", "b", "vertices"))


@query("g10_points", "SELECT node, point_x AS px, point_y AS py FROM fx_node")
def points(t):
    return xy_points(t["fx_node"]).select("node", F.col("point.x").alias("px"), F.col("point.y").alias("py"))
