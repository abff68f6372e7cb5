"""Joins, aggregates, ordered scans, sorts and set operations (J, A, W, O, U)."""

from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import itinerary as I
from ..operators import runs as R
from ..operators import spatial as X
from ..operators import tables as T
from ..operators.links import both_directions, end_nodes, link_miles, vertex_rows
from ..operators.sequence import scan
from ..sources.dims import fare_zones
from .registry import query, rnd
from .scalars import FARE_SQL


def seg_keys(df):
    return df.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles")


@query("j01_segments_with_header", "SELECT i.tr_line, it_order, mode, longname FROM fx_itin i JOIN fx_run r ON i.tr_line = r.tr_line")
def with_header(t):
    heads = t["fx_run"].select("tr_line", "mode", "longname")
    return t["fx_itin"].join(heads, "tr_line").select("tr_line", "it_order", "mode", "longname")


@query(
    "j02_segments_with_vertices",
    """SELECT itin_a, itin_b, count(*) AS n, round(sum(x), 3) AS sx FROM fx_itin i JOIN fx_vertex v
       ON i.itin_a = v.a AND i.itin_b = v.b GROUP BY itin_a, itin_b""",
)
def with_vertices(t):
    v = t["fx_vertex"].select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "x")
    out = t["fx_itin"].select("itin_a", "itin_b").join(v, ["itin_a", "itin_b"]).groupBy("itin_a", "itin_b")
    return out.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 3).alias("sx"))


@query("j03_left_join_miles", "SELECT tr_line, it_order, miles FROM fx_itin i LEFT JOIN fx_link l ON itin_a = a AND itin_b = b")
def left_miles(t):
    return t["fx_itin"].join(seg_keys(t["fx_link"]), ["itin_a", "itin_b"], "left").select("tr_line", "it_order", "miles")


@query(
    "j04_left_join_lines",
    """SELECT r.tr_line, x.descr FROM fx_run r LEFT JOIN
       (SELECT 'cbl' AS ln, 'blue' AS descr UNION ALL SELECT 'mbn', 'burlington') x ON substr(r.tr_line, 1, 3) = x.ln""",
)
def left_lines(t):
    rev = t.spark.createDataFrame([("cbl", "blue"), ("mbn", "burlington")], "ln STRING, descr STRING")
    return t["fx_run"].withColumn("ln", C.line_group("tr_line")).join(F.broadcast(rev), "ln", "left").select("tr_line", "descr")


@query("j05_semi_join", "SELECT a, b FROM fx_link WHERE (a, b) IN (SELECT itin_a, itin_b FROM fx_itin WHERE dw_code = '1')")
def semi(t):
    used = t["fx_itin"].filter(F.col("dw_code") == "1").select(F.col("itin_a").alias("a"), F.col("itin_b").alias("b")).distinct()
    return t["fx_link"].join(used, ["a", "b"], "left_semi").select("a", "b")


@query(
    "j06_anti_join",
    "SELECT tr_line, it_order FROM fx_itin WHERE NOT EXISTS (SELECT 1 FROM fx_link WHERE a = itin_a AND b = itin_b)",
)
def anti(t):
    return t["fx_itin"].join(seg_keys(t["fx_link"]), ["itin_a", "itin_b"], "left_anti").select("tr_line", "it_order")


_COUNTED = "(SELECT tr_line, count(*) AS segs FROM fx_itin WHERE it_order > 1 GROUP BY tr_line)"


@query(
    "j07_full_outer",
    f"""SELECT coalesce(r.tr_line, s.tr_line) AS tr_line, r.mode, s.segs
        FROM (SELECT * FROM fx_run WHERE mode = 'C') r FULL JOIN {_COUNTED} s ON r.tr_line = s.tr_line""",
)
def full_outer(t):
    segs = t["fx_itin"].filter(F.col("it_order") > 1).groupBy("tr_line").agg(F.count(F.lit(1)).alias("segs"))
    return t["fx_run"].filter(F.col("mode") == "C").select("tr_line", "mode").join(segs, "tr_line", "full_outer")


@query(
    "j09_reconcile",
    """SELECT CASE WHEN s.tr_line IS NULL THEN 'right' WHEN r.tr_line IS NULL THEN 'left' ELSE 'both' END AS side, count(*) AS n
       FROM (SELECT tr_line FROM fx_itin) s FULL JOIN (SELECT tr_line FROM fx_run WHERE o_orderkey % 10 <> 3) r
       ON r.tr_line = s.tr_line GROUP BY 1""",
)
def reconcile(t):
    runs = t["fx_run"].filter(F.col("o_orderkey") % 10 != 3)
    good, only = T.reconcile(t["fx_itin"].select("tr_line"), runs, "tr_line")
    lost = t["fx_itin"].select("tr_line").join(only.filter("side = 'left'"), "tr_line").select("side")
    rows = good.select(F.lit("both").alias("side")).unionByName(lost)
    rows = rows.unionByName(only.filter("side = 'right'").select("side"))
    return rows.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j10_two_zone_join",
    f"""SELECT line, it_order, tr_line, fa.cost AS cost_a, fb.cost AS cost_b
        FROM (SELECT *, CASE WHEN line LIKE 'metra%' THEN 'metra' ELSE 'shore' END AS sys FROM fx_feed_seg WHERE mode = 'M') s
        LEFT JOIN (SELECT * FROM {FARE_SQL}) fa ON fa.system = s.sys AND fa.zone_id = s.zone_id_a
        LEFT JOIN (SELECT * FROM {FARE_SQL}) fb ON fb.system = s.sys AND fb.zone_id = s.zone_id_b""",
)
def two_zones(t):
    fares = fare_zones(t.spark).select("system", "zone_id", "cost")
    a, b = F.broadcast(fares.toDF("system", "zone_id_a", "cost_a")), F.broadcast(fares.toDF("system", "zone_id_b", "cost_b"))
    system = F.when(F.col("line").startswith("metra"), "metra").otherwise("shore")
    segs = t["fx_feed_seg"].filter("mode = 'M'").withColumn("system", system)
    out = segs.join(a, ["system", "zone_id_a"], "left").join(b, ["system", "zone_id_b"], "left")
    return out.select("line", "it_order", "tr_line", "cost_a", "cost_b")


@query(
    "j11_either_end",
    """SELECT DISTINCT tr_line, it_order, node FROM fx_itin JOIN fx_deleted ON itin_a = node OR itin_b = node""",
)
def either_end(t):
    """Both ends become rows of an equi join, then each segment and node is kept once."""
    ends = T.rows_from(t["fx_itin"].select("tr_line", "it_order", "itin_a", "itin_b"), {"node": "itin_a"}, {"node": "itin_b"})
    return ends.join(t["fx_deleted"].select("node"), "node", "left_semi").select("tr_line", "it_order", "node").distinct()


@query(
    "j12_new_points",
    """SELECT a, b, x, y FROM fx_vertex v WHERE NOT EXISTS (SELECT 1 FROM fx_node WHERE point_x = x AND point_y = y)""",
)
def new_points(t):
    known = t["fx_node"].select(F.col("point_x").alias("x"), F.col("point_y").alias("y"))
    return t["fx_vertex"].join(known, ["x", "y"], "left_anti").select("a", "b", "x", "y")


@query(
    "j13_coordinate_join",
    """SELECT a, b, ord, node FROM fx_vertex JOIN fx_node ON round(x, 6) = round(point_x, 6) AND round(y, 5) = round(point_y, 5)""",
)
def coordinate(t):
    return X.coordinate_join(t["fx_vertex"], t["fx_node"]).select("a", "b", "ord", "node")


@query(
    "j14_join_field",
    """SELECT l.a, l.b, p.newmile, coalesce(p.newmile, l.miles) AS miles FROM fx_link l
       LEFT JOIN fx_piece p ON l.a = p.a AND l.b = p.b AND p.o = 1""",
)
def join_field(t):
    pieces = t["fx_piece"].filter("o = 1").select("a", "b", "newmile")
    joined = t["fx_link"].join(pieces, ["a", "b"], "left")
    return joined.select("a", "b", "newmile", F.coalesce("newmile", "miles").alias("miles"))


# Straight pieces of links, and of routes drawn over every seventh link with other vertices: cut at a quarter and at three fifths of
# the first piece, from the middle of the second one on drawn back over it, every other one in the opposite direction.
SHARED_SQL = """s AS (SELECT a, b, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2, ord FROM fx_vertex WINDOW w AS (PARTITION BY a, b ORDER BY ord)),
  l AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS n FROM s WHERE x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)),
  r AS (SELECT CASE WHEN a % 2 = 0 THEN '34567' ELSE '67' END AS codes, x1 + (x2 - x1) * k.f AS p1, y1 + (y2 - y1) * k.f AS q1, x1 + (x2 - x1) * k.t AS p2, y1 + (y2 - y1) * k.t AS q2
    FROM l JOIN (SELECT 1 AS o, 0.25e0 AS f, 0.6e0 AS t UNION ALL SELECT 1, 0.6e0, 1.0e0 UNION ALL SELECT 2, 0.0e0, 0.5e0) k ON k.o = l.ord WHERE (a + b) % 7 = 0),
  m AS (SELECT codes, a, b, n, ((p1 - x1) * (x2 - x1) + (q1 - y1) * (y2 - y1)) / n AS s1, ((p2 - x1) * (x2 - x1) + (q2 - y1) * (y2 - y1)) / n AS s2,
      ((q1 - y1) * (x2 - x1) - (p1 - x1) * (y2 - y1)) / n AS c1, ((q2 - y1) * (x2 - x1) - (p2 - x1) * (y2 - y1)) / n AS c2
    FROM l JOIN r ON least(p1, p2) <= greatest(x1, x2) + 1 AND greatest(p1, p2) >= least(x1, x2) - 1 AND least(q1, q2) <= greatest(y1, y2) + 1
      AND greatest(q1, q2) >= least(y1, y2) - 1 AND abs((x2 - x1) * (q2 - q1) - (y2 - y1) * (p2 - p1)) <= 0.03 * n * sqrt((p2 - p1) * (p2 - p1) + (q2 - q1) * (q2 - q1))),
  o AS (SELECT *, greatest(0, least(s1, s2)) AS lo, least(n, greatest(s1, s2)) AS hi FROM m WHERE s1 <> s2),
  shared AS (SELECT DISTINCT codes, a, b FROM o WHERE hi - lo >= 10 AND abs(c1 + (c2 - c1) * (lo - s1) / (s2 - s1)) <= 0.01 AND abs(c1 + (c2 - c1) * (hi - s1) / (s2 - s1)) <= 0.01)"""


def cut_routes(shapes):
    """Routes over every seventh link, drawn with other vertices."""
    at = lambda p, q, t: F.struct((p["x"] + (q["x"] - p["x"]) * t).alias("x"), (p["y"] + (q["y"] - p["y"]) * t).alias("y"))
    v = [F.col("vertices")[k] for k in range(3)]
    drawn = F.array(at(v[0], v[1], 0.25), at(v[0], v[1], 0.6), at(v[1], v[2], 0.0), at(v[1], v[2], 0.5))
    drawn = F.when(F.col("a") % 2 == 0, F.reverse(drawn)).otherwise(drawn)
    return shapes.filter((F.col("a") + F.col("b")) % 7 == 0).withColumn("vertices", drawn)


@query(
    "j16_links_along_routes",
    f"WITH {SHARED_SQL} SELECT DISTINCT a, b FROM shared",
)
def along_routes(t):
    """Links drawn over the same stretch count, in either direction and whatever vertices the route has."""
    shapes = t["link_shape"]
    return X.sharing_segment(shapes, cut_routes(shapes).select("vertices")).select("a", "b")


@query(
    "j17_node_zones",
    """SELECT n.node, min(z.zone) AS zone FROM fx_node n LEFT JOIN fx_zone z
       ON abs(n.point_x - z.cx) + abs(n.point_y - z.cy) < z.r GROUP BY n.node""",
)
def node_zones(t):
    return X.node_zones(t["fx_node"].select("node", "point_x", "point_y"), t["zone_ring"]).select("node", "zone")


@query(
    "j18_coincident_node",
    """SELECT v.a, v.b, v.ord, n.node FROM fx_vertex v JOIN fx_node n ON abs(v.x - n.point_x) < 0.5 AND abs(v.y - n.point_y) < 0.5
       WHERE v.ord <> 2 AND (v.ord = 1 AND n.node = v.a OR v.ord = 3 AND n.node = v.b)""",
)
def coincident(t):
    """End vertices are moved by a fifth of a foot before the search."""
    pts = t["fx_vertex"].filter("ord <> 2").select("a", "b", "ord", (F.col("x") + 0.2).alias("point_x"), F.col("y").alias("point_y"))
    return X.nearest_node(pts, t["fx_node"], ["a", "b", "ord"], 0.5)


# --- aggregates -------------------------------------------------------------------------------------


@query("a01_count", "SELECT dw_code, layover, count(*) AS n FROM fx_itin GROUP BY dw_code, layover")
def count(t):
    return t["fx_itin"].groupBy("dw_code", "layover").agg(F.count(F.lit(1)).alias("n"))


@query("a02_sum", f"SELECT tr_line, {rnd('sum(trv_time)', 6)} AS total FROM fx_itin GROUP BY tr_line")
def total(t):
    return t["fx_itin"].groupBy("tr_line").agg(C.round_half_away(F.sum("trv_time"), 6).alias("total"))


@query(
    "a03_min_max_mean",
    f"""SELECT itin_a, min(dep_time) AS first_dep, max(dep_time) AS last_dep, {rnd('sum(trv_time)', 6)} AS trv,
        {rnd('avg(trv_time)', 6)} AS mean_trv FROM fx_itin GROUP BY itin_a""",
)
def min_max_mean(t):
    return t["fx_itin"].groupBy("itin_a").agg(
        F.min("dep_time").alias("first_dep"), F.max("dep_time").alias("last_dep"),
        C.round_half_away(F.sum("trv_time"), 6).alias("trv"), C.round_half_away(F.avg("trv_time"), 6).alias("mean_trv"),
    )


@query(
    "a04_max_merge",
    """SELECT tr_line, max(CASE WHEN it_order = 1 THEN itin_a END) AS first_node,
       max(CASE WHEN it_order = n THEN itin_b END) AS last_node
       FROM (SELECT *, count(*) OVER (PARTITION BY tr_line) AS n FROM fx_itin) q GROUP BY tr_line""",
)
def max_merge(t):
    marked = I.mark_ends(t["fx_itin"], t.layout)
    return marked.groupBy("tr_line").agg(
        F.max(F.when(F.col("is_first"), F.col("itin_a"))).alias("first_node"),
        F.max(F.when(F.col("is_last"), F.col("itin_b"))).alias("last_node"),
    )


@query("a05_id_carry", "SELECT tr_line, max(layover) AS layover, max(it_order) AS segs FROM fx_itin GROUP BY tr_line")
def id_carry(t):
    return t["fx_itin"].groupBy("tr_line").agg(F.max("layover").alias("layover"), F.max("it_order").alias("segs"))


@query(
    "a06_count_filter",
    "SELECT tr_line, count(*) AS n FROM fx_itin WHERE layover = '4' GROUP BY tr_line HAVING count(*) > 1",
)
def count_filter(t):
    return t["fx_itin"].filter("layover = '4'").groupBy("tr_line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("a07_count_broadcast", "SELECT tr_line, it_order, count(*) OVER (PARTITION BY tr_line) AS n FROM fx_itin")
def count_back(t):
    counted = scan(t["fx_itin"], ["tr_line"], ["it_order"], bucket=t.layout.bucket("it_order"), size="n")
    return counted.select("tr_line", "it_order", "n")


@query(
    "a08_ratio_of_sums",
    f"""SELECT substr(tr_line, 1, 3) AS ln, {rnd("sum(CASE WHEN dw_code = '0' THEN 1.0 ELSE 0.0 END) / count(DISTINCT tr_line)", 6)}
        AS stops_per_run FROM fx_itin GROUP BY 1""",
)
def ratio(t):
    """Stops are summed per run first, so the distinct count needs no second shuffle of the segments."""
    per_run = t["fx_itin"].groupBy("tr_line").agg(F.sum(F.when(F.col("dw_code") == "0", 1.0).otherwise(0.0)).alias("stops"))
    out = per_run.groupBy(C.line_group("tr_line").alias("ln"))
    return out.agg(C.round_half_away(F.sum("stops") / F.count(F.lit(1)), 6).alias("stops_per_run"))


@query(
    "a09_distinct_keys",
    """SELECT substr(tr_line, 1, 3) AS ln, count(*) AS links, count(DISTINCT itin_b) AS stations
       FROM (SELECT DISTINCT substr(tr_line, 1, 3) || '000' AS tr_line, itin_a, itin_b FROM fx_itin) q GROUP BY 1""",
)
def distinct_keys(t):
    pairs = t["fx_itin"].select(C.line_group("tr_line").alias("ln"), "itin_a", "itin_b").distinct()
    ends = pairs.groupBy("ln", "itin_b").agg(F.count(F.lit(1)).alias("n"))
    return ends.groupBy("ln").agg(F.sum("n").alias("links"), F.count(F.lit(1)).alias("stations"))


@query(
    "a10_grand_distinct",
    "SELECT a, b FROM fx_link UNION SELECT itin_a, itin_b FROM fx_itin UNION SELECT a, b FROM fx_net",
)
def grand_distinct(t):
    itin = t["fx_itin"].select(F.col("itin_a").alias("a"), F.col("itin_b").alias("b"))
    return T.union_all(t["fx_link"].select("a", "b"), itin, t["fx_net"].select("a", "b")).distinct()


# --- ordered scans ----------------------------------------------------------------------------------


@query(
    "w01_resequence",
    """SELECT tr_line, itin_a, itin_b, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY it_order) AS INT) AS it_order
       FROM fx_itin WHERE (itin_a + itin_b) % 4 <> 0""",
)
def resequence(t):
    kept = t["fx_itin"].filter((F.col("itin_a") + F.col("itin_b")) % 4 != 0)
    return I.resequence(kept, t.layout).select("tr_line", "itin_a", "itin_b", "it_order")


@query(
    "w02_previous_row",
    """SELECT tr_line, it_order, lag(itin_b) OVER w AS z, lag(dw_code) OVER w AS prev_dw FROM fx_itin
       WINDOW w AS (PARTITION BY tr_line ORDER BY it_order)""",
)
def previous(t):
    lag = {"z": F.col("itin_b"), "prev_dw": F.col("dw_code")}
    seen = scan(t["fx_itin"], ["tr_line"], ["it_order"], bucket=t.layout.bucket("it_order"), lag=lag)
    return seen.select("tr_line", "it_order", "z", "prev_dw")


@query(
    "w03_first_last",
    """SELECT tr_line, it_order, row_number() OVER (PARTITION BY tr_line ORDER BY it_order) = 1 AS is_first,
       row_number() OVER (PARTITION BY tr_line ORDER BY it_order DESC) = 1 AS is_last FROM fx_itin""",
)
def first_last(t):
    return I.mark_ends(t["fx_itin"], t.layout).select("tr_line", "it_order", "is_first", "is_last")


@query(
    "w04_measures",
    f"""SELECT tr_line, it_order, {rnd("t - m", 6)} AS f_meas, {rnd("t", 6)} AS t_meas FROM (
         SELECT tr_line, it_order, coalesce(miles, 0) AS m, sum(coalesce(miles, 0)) OVER (PARTITION BY tr_line ORDER BY it_order) AS t
         FROM fx_itin LEFT JOIN fx_link ON itin_a = a AND itin_b = b) q""",
)
def measures(t):
    itin = t["fx_itin"].join(seg_keys(t["fx_link"]), ["itin_a", "itin_b"], "left").na.fill(0.0, ["miles"])
    out = I.measure(itin, t.layout)
    return out.select("tr_line", "it_order", C.round_half_away("f_meas", 6).alias("f_meas"), C.round_half_away("t_meas", 6).alias("t_meas"))


@query(
    "w07_islands",
    """SELECT tr_line, it_order, CAST(sum(CASE WHEN p IS NULL OR p <> dw_code THEN 1 ELSE 0 END)
         OVER (PARTITION BY tr_line ORDER BY it_order) AS BIGINT) AS isle
       FROM (SELECT *, lag(dw_code) OVER (PARTITION BY tr_line ORDER BY it_order) AS p FROM fx_itin) q""",
)
def islands(t):
    seen = scan(t["fx_itin"], ["tr_line"], ["it_order"], bucket=t.layout.bucket("it_order"), lag={"p": F.col("dw_code")})
    return I.islands(seen, ~F.col("p").eqNullSafe(F.col("dw_code")), "isle", t.layout).select("tr_line", "it_order", "isle")


def imputed_rows(t):
    """Two stops of each run are imputed: orders 2 and 3, sharing the clock of the coded segment."""
    it = t["fx_feed_seg"]
    imp = F.col("it_order").between(2, 3)
    dep = F.when(imp, F.col("dep_time") - (F.col("it_order") - 2) * 300).otherwise(F.col("dep_time"))
    return it.withColumns({"imputed": F.when(imp, 1).otherwise(0), "dep_time": dep, "seg_order": F.col("it_order")})


_IMPUTED = """z AS (SELECT tr_line, it_order, ltime, CASE WHEN it_order BETWEEN 2 AND 3 THEN 1 ELSE 0 END AS imputed,
    CASE WHEN it_order BETWEEN 2 AND 3 THEN dep_time - (it_order - 2) * 300 ELSE dep_time END AS dep_time, arr_time FROM fx_feed_seg),
  c AS (SELECT *, coalesce(lag(imputed) OVER w = imputed AND lag(dep_time) OVER w = dep_time, false) AS same, lag(imputed) OVER w AS pi
        FROM z WINDOW w AS (PARTITION BY tr_line ORDER BY it_order)),
  d AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY tr_line ORDER BY it_order) AS isle FROM c),
  e AS (SELECT *, CASE WHEN imputed = 1 THEN dep_time + sum(ltime * 60) OVER (PARTITION BY tr_line, isle ORDER BY it_order)
                   ELSE arr_time END AS arr FROM d),
  f AS (SELECT *, lag(arr) OVER (PARTITION BY tr_line ORDER BY it_order) AS prev FROM e)"""


@query(
    "w08_imputed_clock",
    f"""WITH {_IMPUTED} SELECT tr_line, it_order, {rnd("arr", 3)} AS arr_time,
        {rnd("CASE WHEN (imputed = 1 AND same) OR (NOT same AND pi > imputed AND it_order > 1) THEN prev ELSE dep_time END", 3)} AS dep_time FROM f""",
)
def imputed_clock(t):
    out = I.imputed_clock(imputed_rows(t), t.layout)
    return out.select("tr_line", "it_order", C.round_half_away("arr_time", 3).alias("arr_time"), C.round_half_away("dep_time", 3).alias("dep_time"))


GROUPED_SQL = """g AS (SELECT tr_line, start_sec, substr(tr_line, 1, 3) || route_id AS grp,
    CASE WHEN strthour >= 18 OR strthour < 6 THEN 1 WHEN strthour < 9 THEN 2 WHEN strthour < 16 THEN 3 ELSE 4 END AS tod
  FROM fx_run WHERE mode = 'C' AND start_sec IS NOT NULL),
h AS (SELECT *, count(*) OVER (PARTITION BY grp, tod) AS runs, lag(start_sec) OVER (PARTITION BY grp, tod ORDER BY
    CASE WHEN tod = 1 AND start_sec % 86400 >= 43200 THEN 1 ELSE 2 END,
    CASE WHEN tod = 1 THEN floor((start_sec % 86400) / 3600.0) ELSE 0 END, start_sec, tr_line) AS prev,
    CASE tod WHEN 1 THEN 720.0 WHEN 2 THEN 180.0 WHEN 3 THEN 420.0 ELSE 120.0 END AS period FROM g),
k AS (SELECT *, CASE WHEN runs = 1 THEN period ELSE abs(start_sec - prev) / 60.0 END AS g0 FROM h WHERE runs = 1 OR prev IS NOT NULL),
m AS (SELECT *, CASE WHEN g0 > period THEN 1440 - g0 ELSE g0 END AS g1 FROM k),
gaps AS (SELECT grp, tod, tr_line, CAST(runs AS BIGINT) AS runs, CASE WHEN g1 = 0 THEN period ELSE g1 END AS gap FROM m)"""


def grouped_runs(t):
    runs = t["fx_run"].filter((F.col("mode") == "C") & F.col("start_sec").isNotNull())
    grp = F.concat(C.line_group("tr_line"), F.col("route_id"))
    return runs.select("tr_line", "start_sec", grp.alias("grp"), C.time_of_day("strthour").alias("tod"))


@query("w09_departure_gaps", f"WITH {GROUPED_SQL} SELECT grp, tod, tr_line, runs, {rnd('gap', 6)} AS gap FROM gaps")
def departure_gaps(t):
    gaps = R.departure_gaps(grouped_runs(t), ["grp", "tod"])
    return gaps.select("grp", "tod", "tr_line", "runs", C.round_half_away("gap", 6).alias("gap"))


@query(
    "o02_first_per_key",
    """SELECT itin_a, itin_b, tr_line, it_order FROM (SELECT *, row_number() OVER (PARTITION BY itin_a, itin_b
       ORDER BY dep_time, tr_line, it_order) AS r FROM fx_itin) q WHERE r = 1""",
)
def first_per_key(t):
    cols = t["fx_itin"].select("itin_a", "itin_b", "dep_time", "tr_line", "it_order")
    return T.first_per_key(cols, ["itin_a", "itin_b"], ["dep_time", "tr_line", "it_order"]).drop("dep_time")


@query(
    "o01_multi_key_sort",
    """SELECT itin_a, itin_b, tr_line, it_order, CAST(row_number() OVER (ORDER BY itin_a, itin_b DESC, tr_line, it_order) AS BIGINT) AS pos
       FROM fx_itin""",
)
def multi_sort(t):
    """A global sort; the position column is numbered from partition sizes, not in one task."""
    from ..operators.ordering import sorted_positions

    cols = t["fx_itin"].select("itin_a", "itin_b", "tr_line", "it_order")
    return sorted_positions(cols, ["itin_a", F.col("itin_b").desc(), "tr_line", "it_order"], "pos")


_SEGS = """s AS (SELECT r.tr_line, substr(r.tr_line, 1, 3) || route_id AS grp, start_sec, n AS segs FROM fx_run r
  JOIN (SELECT tr_line, count(*) AS n FROM fx_itin GROUP BY tr_line) c ON r.tr_line = c.tr_line)"""


def run_segments(t):
    segs = t["fx_itin"].groupBy("tr_line").agg(F.count(F.lit(1)).alias("segs"))
    grp = F.concat(C.line_group("tr_line"), F.col("route_id"))
    return t["fx_run"].join(segs, "tr_line").select("tr_line", grp.alias("grp"), "start_sec", "segs")


@query(
    "o03_representative",
    f"""WITH {_SEGS} SELECT grp, tr_line, segs FROM (SELECT *, row_number() OVER (PARTITION BY grp
        ORDER BY segs DESC, start_sec NULLS FIRST, tr_line) AS r FROM s) q WHERE r = 1""",
)
def representative(t):
    return R.representatives(run_segments(t), ["grp"]).select("grp", "tr_line", "segs")


@query(
    "o04_overnight_order",
    f"""WITH {GROUPED_SQL} SELECT grp, tr_line, CAST(row_number() OVER (PARTITION BY grp ORDER BY
        CASE WHEN start_sec % 86400 >= 43200 THEN 1 ELSE 2 END, floor((start_sec % 86400) / 3600.0), start_sec, tr_line) AS INT) AS pos
        FROM g WHERE tod = 1""",
)
def overnight(t):
    night = R.overnight_order(grouped_runs(t).filter("tod = 1"))
    order = ["priority", "hour_rank", "start_sec", "tr_line"]
    cut, bucket = T.cut_by_range(night, ["grp"], order)
    return scan(cut, ["grp"], order, bucket=bucket, number="pos").select("grp", "tr_line", "pos")


# --- set operations ---------------------------------------------------------------------------------


@query(
    "u01_append_by_name",
    """SELECT tr_line, mode, CAST(NULL AS INT) AS action FROM fx_run UNION ALL SELECT tr_line, mode, action FROM fx_future""",
)
def append_by_name(t):
    return T.union_all(t["fx_run"].select("tr_line", "mode"), t["fx_future"].select("tr_line", "mode", "action"))


@query(
    "u02_append_periods",
    """SELECT tod, a, b FROM (SELECT 1 AS tod, a, b FROM fx_link WHERE (a + b) % 4 = 0 UNION ALL SELECT 2, a, b FROM fx_link WHERE (a + b) % 4 < 2) q""",
)
def append_periods(t):
    """One tagged pass instead of a table appended per period."""
    k = (F.col("a") + F.col("b")) % 4
    tods = F.when(k == 0, F.array(F.lit(1), F.lit(2))).when(k == 1, F.array(F.lit(2)))
    return t["fx_link"].select(F.explode(tods).alias("tod"), "a", "b")


@query("u03_checked_append", "SELECT a, b, miles FROM fx_link UNION ALL SELECT a, b, miles FROM fx_net")
def checked_append(t):
    have, add = t["fx_link"].select("a", "b", "miles"), t["fx_net"].select("a", "b", "miles")
    T.require_same_schema(have, add)
    return have.unionByName(add)


@query(
    "u04_upsert",
    """SELECT tr_line, mode, route_id FROM fx_run WHERE o_orderkey % 3 <> 0
       UNION ALL SELECT tr_line, 'X', route_id FROM fx_run WHERE o_orderkey % 3 = 0""",
)
def upsert(t):
    runs = t["fx_run"].select("tr_line", "mode", "route_id")
    new = t["fx_run"].filter("o_orderkey % 3 = 0").select("tr_line", F.lit("X").alias("mode"), "route_id")
    return T.upsert(runs, new, ["tr_line"])


@query(
    "u05_row_doubling",
    """SELECT a, b, modes1, miles FROM fx_link UNION ALL SELECT b, a, modes2, miles FROM fx_link WHERE directions = 2""",
)
def doubling(t):
    return both_directions(t["fx_link"]).select("a", "b", "modes1", "miles")


@query(
    "u06_deleted_keys",
    "SELECT node, label FROM fx_node WHERE node NOT IN (SELECT a FROM fx_link WHERE a % 3 = 0 AND b % 3 = 0 UNION SELECT b FROM fx_link WHERE a % 3 = 0 AND b % 3 = 0)",
)
def deleted_keys(t):
    left = end_nodes(t["fx_link"].filter("a % 3 = 0 AND b % 3 = 0").select("a", "b")).select("node")
    return t["fx_node"].join(left, "node", "left_anti").select("node", "label")


@query("g02_link_lengths", """SELECT a, b, miles FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY opp, miles) AS r FROM (
   SELECT a, b, miles, 0 AS opp FROM fx_link WHERE contains(modes1, 'C') UNION ALL
   SELECT b, a, miles, 1 FROM fx_link WHERE contains(modes1, 'C') AND directions = 2) u) q WHERE r = 1""")  # fmt: skip
def lengths(t):
    from ..operators.links import directed_rail_links

    return link_miles(directed_rail_links(t["fx_link"]))


@query(
    "g01_directed_vertices",
    """SELECT a, b, modes1, ord, x, y FROM fx_vertex WHERE contains(modes1, 'C') UNION ALL
       SELECT b, a, modes2, 4 - ord, x, y FROM fx_vertex WHERE contains(modes1, 'C') AND directions = 2""",
)
def directed_vertices(t):
    from ..operators.links import directed_rail_links

    return vertex_rows(directed_rail_links(t["link_shape"])).select("a", "b", "modes1", "ord", "x", "y")
