"""Scenario networks, output layouts, reports and sources (D19-D22, D31-D34, D42, K, S)."""

import uuid

from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import itinerary as I
from ..operators import network as N
from ..operators import report as M
from ..operators import runs as R
from ..operators import tables as T
from ..operators.links import two_way_vertices
from ..operators.summary import MEASURES
from ..sinks import layouts as L
from ..sources import readers
from ..session import shared_folder
from ..sources.dims import fare_zones
from .networks import ROUTE_SQL, SPLIT_ITIN, directed, pieces_of
from .registry import query, rnd
from .scalars import FARE_SQL
from .summaries import _ALL, itin_of, runs_of

SCENARIOS = (1, 3, 6)
_SCEN = "(SELECT 1 AS scenario UNION ALL SELECT 3 UNION ALL SELECT 6)"
_CLOSED = f"""cl AS (SELECT s.scenario, anode AS a, bnode AS b, m.scenario AS open_in, notes FROM fx_mover m CROSS JOIN {_SCEN} s
   WHERE NOT contains(m.scenario, CAST(s.scenario AS STRING)))"""


def closed(t):
    return N.closed_movers(t["fx_mover"], SCENARIOS)


@query(
    "d19_without_people_movers",
    f"WITH {_CLOSED} SELECT s.scenario, l.a, l.b, l.miles FROM fx_link l CROSS JOIN {_SCEN} s WHERE (s.scenario, l.a, l.b) NOT IN (SELECT scenario, a, b FROM cl)",
)
def without_movers(t):
    links = N.per_scenario(t["fx_link"], SCENARIOS)
    return N.without_closed_movers(links, closed(t)).select("scenario", "a", "b", "miles")


_ACTIVE = f"""ac AS (SELECT s.scenario, a, b FROM fx_link CROSS JOIN {_SCEN} s WHERE (a + b) % 7 = 0 AND contains(CASE WHEN a % 2 = 0 THEN '34567' ELSE '67' END, CAST(s.scenario AS STRING))),
 ff AS (SELECT s.scenario, l.a, l.b, l.miles FROM fx_link l CROSS JOIN {_SCEN} s WHERE (s.scenario, l.a, l.b) IN (SELECT scenario, a, b FROM ac UNION SELECT scenario, b, a FROM ac))"""


def scenario_links(t):
    """Base links leave out a seventh of the pairs; future links follow the active routes drawn on them."""
    shapes = t["link_shape"]
    seventh = (F.col("a") + F.col("b")) % 7 == 0
    codes = F.when(F.col("a") % 2 == 0, "34567").otherwise("67")
    routes = shapes.filter(seventh).select(codes.alias("codes"), "vertices")
    routes = N.per_scenario(routes, SCENARIOS, "codes")
    future = N.future_links(N.per_scenario(shapes, SCENARIOS), routes, same_vertices=True)
    cols = ["scenario", "a", "b", "miles", "directions", "modes1", "modes2"]
    base = N.per_scenario(t["fx_link"].filter(~seventh), SCENARIOS)
    base = N.without_closed_movers(base, closed(t)).select(*cols)
    return N.scenario_network(base, future.withColumn("miles", F.col("miles") + 100).select(*cols))


@query(
    "d20_scenario_network",
    f"""WITH {_CLOSED}, {_ACTIVE}, ba AS (SELECT s.scenario, l.a, l.b, l.miles, 0 AS k FROM fx_link l CROSS JOIN {_SCEN} s WHERE (a + b) % 7 <> 0
          AND (s.scenario, l.a, l.b) NOT IN (SELECT scenario, a, b FROM cl)),
       al AS (SELECT *, row_number() OVER (PARTITION BY scenario, a, b ORDER BY k) AS r FROM (SELECT * FROM ba UNION ALL SELECT scenario, a, b, miles + 100, 1 FROM ff) q)
       SELECT scenario, a, b, miles FROM al WHERE r = 1""",
)
def scenario_network(t):
    return scenario_links(t).select("scenario", "a", "b", "miles")


def _hdwy(tod: str) -> str:
    return f"CASE WHEN instr(headway, ':') = 0 THEN TRY_CAST(headway AS DOUBLE) ELSE CASE {tod} WHEN 1 THEN 30.0 WHEN 4 THEN TRY_CAST(string_split(headway, ':')[6] AS DOUBLE) ELSE 12.0 END END"


_RUNS = f"""rn AS MATERIALIZED (SELECT s.scenario, CASE WHEN strthour IS NULL OR strthour >= 18 OR strthour < 6 THEN 1 WHEN strthour < 9 THEN 2 WHEN strthour < 16 THEN 3 ELSE 4 END AS tod,
     tr_line, mode, longname, CAST(headway AS DOUBLE) AS headway, CAST(NULL AS DOUBLE) AS acthdwy FROM fx_run CROSS JOIN {_SCEN} s
   UNION ALL SELECT s.scenario, p.tod, tr_line, mode, longname, {_hdwy("p.tod")}, {_hdwy("p.tod")} FROM fx_future f CROSS JOIN {_SCEN} s
     CROSS JOIN (SELECT 1 AS tod UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) p
     WHERE action = 1 AND contains(f.scenario, CAST(s.scenario AS STRING)) AND contains(f.tod, CAST(p.tod AS STRING)))"""


def scenario_runs(t):
    base = t["fx_run"].select("tr_line", "mode", "longname", "headway", "strthour")
    coded = t["fx_future"].select("tr_line", "mode", "longname", "headway", "scenario", "tod", "action")
    return N.tod_runs(base, coded, SCENARIOS)


@query("d21_period_runs", f"WITH {_RUNS} SELECT scenario, tod, tr_line, mode, longname, headway, acthdwy FROM rn")
def period_runs(t):
    return scenario_runs(t).select("scenario", "tod", "tr_line", "mode", "longname", "headway", "acthdwy")


def scenario_itins(t):
    return N.tod_itineraries(t["fx_itin"], scenario_runs(t))


@query(
    "d22_period_itineraries",
    f"""WITH {_RUNS} SELECT rn.scenario, rn.tod, i.tr_line, i.it_order, i.layover, CASE WHEN dw_code = '1' THEN 0.0::DOUBLE ELSE 0.01::DOUBLE END AS dw_time
        FROM rn JOIN fx_itin i ON i.tr_line = rn.tr_line""",
)
def period_itineraries(t):
    return scenario_itins(t).select("scenario", "tod", "tr_line", "it_order", "layover", "dw_time")


@query(
    "d31_metra_headway",
    f"WITH {_RUNS} SELECT scenario, tod, tr_line, CASE WHEN mode = 'M' AND headway = 99 THEN CASE tod WHEN 1 THEN 720.0::DOUBLE WHEN 2 THEN 180 WHEN 3 THEN 420 ELSE 120 END ELSE headway END AS headway FROM rn",
)
def metra_headway(t):
    return R.metra_headway(scenario_runs(t)).select("scenario", "tod", "tr_line", "headway")


_DIRECTED = """di AS MATERIALIZED (SELECT a, b, miles, modes1 FROM fx_link UNION ALL SELECT b, a, miles, modes2 FROM fx_link WHERE directions = 2)"""
_SERVED = "sv AS MATERIALIZED (SELECT DISTINCT itin_a AS a, itin_b AS b FROM fx_itin)"


def directed_links(t):
    from ..operators.links import both_directions

    return both_directions(t["fx_link"]).drop("directions", "opposite")


@query("d32_used_links", f"WITH {_DIRECTED}, {_SERVED} SELECT a, b, miles, modes1 FROM di WHERE (a, b) IN (SELECT a, b FROM sv)")
def used(t):
    return N.used_links(directed_links(t), t["fx_itin"]).select("a", "b", "miles", "modes1")


_AUX = f"""{_DIRECTED}, {_SERVED}, us AS MATERIALIZED (SELECT a, b, miles, modes1 FROM di WHERE (a, b) IN (SELECT a, b FROM sv)),
 ax AS MATERIALIZED (SELECT * FROM di WHERE NOT contains(modes1, 'C') AND NOT contains(modes1, 'M')),
 cn AS (SELECT node, count(*) AS n FROM (SELECT a AS node FROM us UNION ALL SELECT b FROM us UNION ALL SELECT a FROM ax UNION ALL SELECT b FROM ax) q GROUP BY node),
 au AS MATERIALIZED (SELECT * FROM ax WHERE a IN (SELECT node FROM cn WHERE n > 40 OR node <= 30020) AND b IN (SELECT node FROM cn WHERE n > 40 OR node <= 30020))"""


@query("d33_auxiliary_links", f"WITH {_AUX.replace('n > 40', 'n > 3')} SELECT a, b, miles, modes1 FROM au")
def auxiliary(t):
    links = directed_links(t)
    return N.auxiliary_links(links, N.used_links(links, t["fx_itin"]), (), 30020).select("a", "b", "miles", "modes1")


@query(
    "d34_network_nodes",
    f"""WITH {_AUX.replace('n > 40', 'n > 3')}, nn AS (SELECT a AS node FROM us UNION SELECT b FROM us UNION SELECT a FROM au UNION SELECT b FROM au)
        SELECT n.node, CAST(CASE WHEN ftr_pspace <> '' THEN pspace * 10 ELSE pspace END AS DOUBLE) AS pspace, CAST(pcost AS DOUBLE) AS pcost, point_x, point_y
        FROM fx_node n JOIN nn ON nn.node = n.node WHERE n.node > 30020""",
)
def network_nodes(t):
    net = N.service_network(t["fx_link"], t["fx_itin"], (), 30020)
    out = N.network_node_table(net, t["fx_node"], (), 3, 30020)
    return out.select("node", "pspace", "pcost", "point_x", "point_y")


@query(
    "d42_final_itineraries",
    """WITH k AS (SELECT *, row_number() OVER w AS r, lead(1) OVER w IS NULL AS lst FROM fx_itin
         WHERE itin_a NOT IN (SELECT node FROM fx_deleted) AND itin_b NOT IN (SELECT node FROM fx_deleted) WINDOW w AS (PARTITION BY tr_line ORDER BY it_order))
       SELECT tr_line, CAST(r AS INT) AS it_order, itin_a, itin_b, CASE WHEN lst THEN CASE WHEN tr_line LIKE 'cor%' THEN '0' ELSE '3' END ELSE layover END AS layover FROM k""",
)
def final_itineraries(t):
    out = I.finish_itinerary(t["fx_itin"], t["fx_deleted"], t.layout, no_layover_prefix="cor")
    return out.select("tr_line", "it_order", "itin_a", "itin_b", "layover")


# --- output layouts -----------------------------------------------------------------------------------


def _num(x: str) -> str:
    return f"regexp_replace(regexp_replace(printf('%.2f', CAST({x} AS DOUBLE)), '0+$', ''), '\\.$', '')"


def _pad(x: str, n: int) -> str:
    return f"rpad({x}, greatest(length({x}), {n})::INT, ' ')"


_TRANSIT = f"""k AS (SELECT i.*, r.mode, r.headway, r.longname, it_order = 1 AS f, lead(1) OVER (PARTITION BY i.tr_line ORDER BY it_order) IS NULL AS lst,
     CASE WHEN dw_code = '1' THEN 'dwt=#0' ELSE 'dwt=0.01' END AS d FROM fx_mitin i JOIN fx_run r ON r.tr_line = i.tr_line),
  x AS (SELECT *, 'ttf=1  us1=' || {_pad(_num("trv_time"), 7)} || 'us2=' || {_num("zn_fare")} AS tm, {_pad("CAST(itin_a AS STRING)", 8)} AS pa, {_pad("CAST(itin_b AS STRING)", 8)} AS pb FROM k),
  y AS (SELECT tr_line, it_order, CASE WHEN f THEN ['a  ''' || tr_line || '''   ' || mode || '   7   ' || {_num("headway")} || '   60   ''' || longname || '''', '    path=no', '    dwt=0.01'] ELSE [] END
     || [CASE WHEN f AND lst THEN '    ' || pa || tm ELSE '    ' || pa || {_pad("d", 11)} || tm || CASE WHEN NOT f AND NOT lst AND layover NOT IN ('0', '') THEN '   lay=' || layover ELSE '' END END]
     || CASE WHEN lst THEN ['    ' || pb || 'lay=' || layover] ELSE [] END AS ls FROM x)"""


@query("k06_transit_lines", f"WITH {_TRANSIT} SELECT tr_line, it_order, CAST(generate_subscripts(ls, 1) - 1 AS INT) AS part, unnest(ls) AS line FROM y")
def transit_lines(t):
    heads = t["fx_run"].select("tr_line", "mode", "headway", F.col("longname").alias("description"))
    heads = heads.withColumns({"veh_type": F.lit(7), "speed": F.lit(60.0)})
    rows = I.mark_ends(t["fx_mitin"].join(heads, "tr_line"), t.layout)
    return L.transit_lines(rows.withColumn("dw_time", C.dwell_time("dw_code")))


@query(
    "k07_node_attributes",
    f"""SELECT node, '  ' || CAST(node AS STRING) || '   ' || CAST(pspace AS STRING) || '   ' || CAST(pcost AS STRING) || '   ' || CAST(node % 50 AS STRING) AS line FROM fx_node""",
)
def node_attributes(t):
    return L.node_attributes(t["fx_node"].withColumn("zone", F.col("node") % 50))


@query(
    "k08_network_file",
    f"""SELECT 1 AS section, node AS k1, 0 AS k2, 'a  ' || CAST(node AS STRING) || '  ' || printf('%.6f', point_x) || ' ' || printf('%.6f', point_y) || '   0  0  0 ' || label AS line FROM fx_node
        UNION ALL SELECT 2, 0, 0, '' UNION ALL SELECT 2, 0, 1, 't links'
        UNION ALL SELECT 3, a, b, 'a   ' || CAST(a AS STRING) || '   ' || CAST(b AS STRING) || '   ' || {_num("miles")} || '   ' || modes1 || '   1  0  1' FROM fx_link""",
)
def network_file(t):
    return L.network_file(t["fx_node"], t["fx_link"])


@query(
    "k09_distinct_links",
    f"""WITH {_DIRECTED}, tp AS (SELECT 1 AS tod UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4), dt AS MATERIALIZED (SELECT tp.tod, di.* FROM di CROSS JOIN tp),
       sv AS MATERIALIZED (SELECT DISTINCT CASE WHEN strthour IS NULL OR strthour >= 18 OR strthour < 6 THEN 1 WHEN strthour < 9 THEN 2 WHEN strthour < 16 THEN 3 ELSE 4 END AS tod,
         itin_a AS a, itin_b AS b FROM fx_itin i JOIN fx_run r ON r.tr_line = i.tr_line),
       us AS MATERIALIZED (SELECT * FROM dt WHERE (tod, a, b) IN (SELECT tod, a, b FROM sv)),
       ax AS MATERIALIZED (SELECT * FROM dt WHERE NOT contains(modes1, 'C') AND NOT contains(modes1, 'M')),
       en AS MATERIALIZED (SELECT tod, node FROM (SELECT tod, a AS node FROM us UNION ALL SELECT tod, b FROM us UNION ALL SELECT tod, a FROM ax UNION ALL SELECT tod, b FROM ax) q
         GROUP BY tod, node HAVING count(*) > 3 OR node <= 30020)
       SELECT a, b FROM us UNION SELECT a, b FROM ax WHERE (tod, a) IN (SELECT tod, node FROM en) AND (tod, b) IN (SELECT tod, node FROM en)""",
)
def distinct_links(t):
    """Links of the networks of all periods."""
    rows = t["fx_itin"].join(t["fx_run"].select("tr_line", C.time_of_day("strthour").alias("tod")), "tr_line")
    tods = F.explode(F.array(*[F.lit(p) for p in N.ALL_TODS])).alias("tod")
    return N.service_network(t["fx_link"].select("*", tods), rows, ("tod",), 30020).select("a", "b").distinct()


@query(
    "k13_link_shapes",
    """WITH q AS (SELECT a, b, ord, x, y FROM fx_vertex UNION ALL SELECT b, a, 4 - ord, x, y FROM fx_vertex), n AS (SELECT a, b FROM fx_net)
       SELECT a, b, 0 AS ord, 'r ' || CAST(a AS STRING) || ' ' || CAST(b AS STRING) AS line FROM n
       UNION ALL SELECT q.a, q.b, ord, 'a ' || CAST(q.a AS STRING) || ' ' || CAST(q.b AS STRING) || ' ' || CAST(ord AS STRING) || ' ' || printf('%.6f', x) || ' ' || printf('%.6f', y)
       FROM q JOIN n ON n.a = q.a AND n.b = q.b
       UNION ALL SELECT 0, 0, no, line FROM (SELECT 0 AS no, 'c RAIL LINK SHAPE FILE FOR SCENARIO 3' AS line UNION ALL SELECT 1, 'c 01JAN24' UNION ALL SELECT 2, 't linkvertices') h""",
)
def link_shapes(t):
    """The whole file: its header has no link numbers and so comes first."""
    head = list(enumerate(L.link_shape_header(3, "01JAN24")))
    first = t.spark.createDataFrame(head, "ord INT, line STRING").select(F.lit(0).alias("a"), F.lit(0).alias("b"), "ord", "line")
    return first.unionByName(L.link_shapes(t["fx_net"], two_way_vertices(t["link_shape"])))


@query(
    "k03_route_vertex_text",
    f"""WITH {ROUTE_SQL}, rt AS (SELECT tr_line, row_number() OVER (ORDER BY tr_line) AS rte FROM (SELECT DISTINCT tr_line FROM fx_itin) q),
       z AS (SELECT rt.rte, it_order, ord, x, y, {rnd("m", 5)} AS m FROM ms JOIN rt ON rt.tr_line = ms.tr_line WHERE px IS NULL OR NOT (x = px AND y = py))
       SELECT rte, it_order, ord, CAST(rte AS STRING) || ';' || printf('%.6f', x) || ';' || printf('%.5f', y) || ';' || printf('%.5f', m) AS line FROM z""",
)
def route_vertex_text(t):
    from ..operators.geometry import route_vertices
    from ..operators.ordering import sorted_positions

    lines = sorted_positions(t["fx_itin"].select("tr_line").distinct(), ["tr_line"], "rte")
    rows = route_vertices(t["fx_itin"], directed(t), t.layout).withColumn("m", C.round_half_away("m", 5))
    return L.route_vertex_text(rows.join(lines, "tr_line"))


@query(
    "k04_dropped_routes",
    """SELECT 0 AS section, '' AS tr_line, '01JAN24 - Routes Deleted from Coding:' AS line
       UNION ALL SELECT DISTINCT 1, tr_line, tr_line FROM fx_itin WHERE tr_line NOT IN (SELECT tr_line FROM fx_run WHERE o_orderkey % 10 <> 3)""",
)
def dropped_routes(t):
    runs = t["fx_run"].filter(F.col("o_orderkey") % 10 != 3)
    only = T.reconcile(t["fx_itin"], runs, "tr_line")[1].filter("side = 'left'")
    return L.dropped_routes(only.select("tr_line"), "01JAN24")


@query(
    "k01_itinerary_table",
    f"WITH {SPLIT_ITIN} SELECT tr_line, f_meas, t_meas, itin_a, itin_b, it_order, layover, dw_code, zn_fare, trv_time, CAST(dep_time AS DOUBLE) AS dep_time, CAST(arr_time AS DOUBLE) AS arr_time, 0 AS imputed FROM cut",
)
def itinerary_table(t):
    from ..operators.edits import apply_splits

    cols = ["tr_line", "f_meas", "t_meas", "itin_a", "itin_b", "it_order", "layover", "dw_code", "zn_fare", "trv_time", "dep_time", "arr_time"]
    out = apply_splits(t["fx_mitin"], pieces_of(t), True, t.layout)
    out = out.withColumns({n: F.col(n).cast("double") for n in ("dep_time", "arr_time")})
    return out.select(*cols, F.lit(0).alias("imputed"))


@query(
    "k02_route_table",
    """SELECT tr_line AS line1, CAST(NULL AS STRING) AS desc1, mode AS mode1, CAST(NULL AS STRING) AS type1, headway AS hdwy1, CAST(NULL AS STRING) AS speed1,
         CAST(NULL AS STRING) AS fdline, route_id AS r_id, longname AS rln, CAST(NULL AS STRING) AS dir, CAST(NULL AS STRING) AS term, start_sec AS start, strthour,
         CAST(NULL AS STRING) AS ampct FROM fx_run""",
)
def route_table(t):
    return L.route_table(t["fx_run"].withColumnRenamed("start_sec", "start"), L.FEED_ROUTE)


@query(
    "k02_future_route_table",
    """SELECT tr_line AS line1, CAST(NULL AS STRING) AS desc1, mode AS mode1, CAST(NULL AS STRING) AS type1, headway AS hdwy1, CAST(NULL AS STRING) AS speed1, tod AS tod1,
         scenario AS scen1, action AS action1, CAST(NULL AS STRING) AS tipid1, CAST(NULL AS STRING) AS rspid1, CAST(NULL AS STRING) AS comp1, CAST(NULL AS STRING) AS notes1 FROM fx_future""",
)
def future_route_table(t):
    return L.route_table(t["fx_future"], L.FUTURE_ROUTE)


@query(
    "k05_node_tables",
    """SELECT 'piece' AS tab, CAST(tempa AS BIGINT) AS k, newmile AS v FROM fx_piece UNION ALL SELECT 'deleted', node, 0.0::DOUBLE FROM fx_deleted
       UNION ALL SELECT DISTINCT 'new', CAST(tempb AS BIGINT), 0.0::DOUBLE FROM fx_piece WHERE tempb > 90000""",
)
def node_tables(t):
    pieces = pieces_of(t).select(F.lit("piece").alias("tab"), F.col("tempa").cast("long").alias("k"), F.col("newmile").alias("v"))
    new = pieces_of(t).filter("tempb > 90000").select(F.lit("new").alias("tab"), F.col("tempb").cast("long").alias("k"), F.lit(0.0).alias("v")).distinct()
    gone = t["fx_deleted"].select(F.lit("deleted").alias("tab"), F.col("node").cast("long").alias("k"), F.lit(0.0).alias("v"))
    return pieces.unionByName(gone).unionByName(new)


@query(
    "k11_change_report",
    f"""WITH {_CLOSED}, fu AS (SELECT s.scenario, p.tod, f.tr_line, f.descr, f.action FROM fx_future f CROSS JOIN {_SCEN} s
         CROSS JOIN (SELECT 2 AS tod UNION ALL SELECT 4) p WHERE contains(f.scenario, CAST(s.scenario AS STRING)) AND contains(f.tod, CAST(p.tod AS STRING))),
       r AS (SELECT scenario, 0 AS tod, 1 AS section, '--> removed scenario = ' || open_in || ' people mover link anode = ' || CAST(a AS STRING) || ' bnode = ' || CAST(b AS STRING) || ' from network' AS message FROM cl
         UNION ALL SELECT scenario, tod, 2, '--> ' || descr || ' : added route ' || tr_line FROM fu WHERE action = 1
         UNION ALL SELECT scenario, tod, 3, '--> ' || descr || ' : shifted ' || substr(tr_line, 1, 3) || ' CBD terminus' FROM fu WHERE action = 5
         UNION ALL SELECT scenario, tod, 7, '--> ' || descr || ' : extended ' || substr(tr_line, 1, 3) FROM fu WHERE action = 4
         UNION ALL SELECT s.scenario, 2, 5, '--> new stops : added new ' || ln || ' station at ' || CAST(new AS STRING) || ' between itin_a = ' || CAST(itin_a AS STRING) || ' and itin_b = ' || CAST(itin_b AS STRING)
           FROM fx_station CROSS JOIN {_SCEN} s
         UNION ALL SELECT s.scenario, 4, 6, '--> hubs : consolidated ' || ln || ' stations between itin_a = ' || CAST(start_node AS STRING) || ' and itin_b = ' || CAST(end_node AS STRING) || ' into new station at ' || CAST(new AS STRING)
           FROM fx_span CROSS JOIN {_SCEN} s
         UNION ALL SELECT s.scenario, 2, 4, '--> faster : reduced ' || ln || ' travel time from ' || CAST(itin_a AS STRING) || ' to ' || CAST(itin_b AS STRING) || ' by ' || {_num("reduc * 100")} || ' percent'
           FROM fx_cut CROSS JOIN {_SCEN} s)
       SELECT scenario, tod, section, 1 AS seq, message FROM r UNION ALL SELECT DISTINCT scenario, tod, section, 0, CASE section
         WHEN 1 THEN '### O''HARE PEOPLE MOVER EXTENSION ###' WHEN 2 THEN '### NEW ROUTES ' || CAST(tod AS STRING) || ' ###' WHEN 3 THEN '### CBD TERMINUS SHIFT ' || CAST(tod AS STRING) || ' ###'
         WHEN 4 THEN '### TRAVEL TIME REDUCTIONS ' || CAST(tod AS STRING) || ' ###' WHEN 5 THEN '### NEW STATIONS ' || CAST(tod AS STRING) || ' ###'
         WHEN 6 THEN '### NEW CONSOLIDATED STATIONS ' || CAST(tod AS STRING) || ' ###' ELSE '### LINE EXTENSIONS ' || CAST(tod AS STRING) || ' ###' END FROM r""",
)
def change_report(t):
    coded = N.per_scenario(t["fx_future"], SCENARIOS, "scenario")
    tods = F.filter(F.array(F.lit(2), F.lit(4)), lambda p: F.col("_t").contains(p.cast("string")))
    coded = coded.withColumnRenamed("tod", "_t").withColumn("tod", F.explode(tods))

    def rows(name, tod, descr):
        return N.per_scenario(t[name], SCENARIOS).withColumns({"tod": F.lit(tod), "descr": F.lit(descr)})

    cut = rows("fx_cut", 2, "faster").withColumns({"tr_line": F.col("ln"), "trv_time": F.col("reduc"), "layover": F.lit("")})
    return M.change_report(
        M.mover_report(closed(t)), M.new_route_report(coded.filter("action = 1")), M.shift_report(coded.filter("action = 5")),
        M.extension_report(coded.filter("action = 4")), M.station_report(rows("fx_station", 2, "new stops")),
        M.consolidation_report(rows("fx_span", 4, "hubs")), M.time_report(cut),
    )


@query("k10_summary_table", f"SELECT s.scenario, q.* FROM ({_ALL}) q CROSS JOIN {_SCEN} s")
def summary_table(t):
    """The combined summary of every scenario and period, as the scenario job makes it."""
    from ..plans.scenario import scenario_summary

    lengths = t["fx_link"].select("a", "b", "miles")
    parts = (N.per_scenario(df, SCENARIOS) for df in (itin_of(t), lengths, runs_of(t)))
    out = scenario_summary(*parts)
    nums = [c for c in MEASURES if c in out.columns and c != "stations"]
    return out.withColumns({c: C.round_half_away(c, 6) for c in nums})


@query(
    "k15_replaced_systems",
    """SELECT CASE WHEN mode = 'C' THEN 'cta' ELSE 'metra' END AS system, tr_line, CASE WHEN mode = 'C' THEN 1 ELSE 0 END AS version FROM fx_run""",
)
def replaced_systems(t):
    """A new version of one system replaces its rows; the rows of other systems stay."""
    system = F.when(F.col("mode") == "C", "cta").otherwise("metra")
    old = t["fx_run"].select(system.alias("system"), "tr_line", F.lit(0).alias("version"))
    new = old.filter("system = 'cta'").withColumn("version", F.lit(1))
    return T.upsert(old, new, ["system"])


# --- sources ------------------------------------------------------------------------------------------


@query(
    "s01_feed_runs",
    "SELECT substr(line, 1, 20) AS line, description, mode, route_id, direction, terminal FROM fx_feed_run",
)
def feed_runs(t):
    return readers.cut_line(t["fx_feed_run"]).select("line", "description", "mode", "route_id", "direction", "terminal")


@query(
    "s02_feed_segments",
    "SELECT substr(line, 1, 20) AS line, it_order, tr_line, itin_a, itin_b, ltime FROM fx_feed_seg WHERE itin_a % 5 <> 0",
)
def feed_segments(t):
    """Every fifth start node has its line blanked, and those rows go."""
    blank = t["fx_feed_seg"].withColumn("line", F.when(F.col("itin_a") % 5 == 0, " ").otherwise(F.col("line")))
    out = readers.drop_blank_lines(readers.cut_line(blank))
    return out.select("line", "it_order", "tr_line", "itin_a", "itin_b", "ltime")


@query("s04_keyed_tables", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def keyed_tables(t):
    return readers.read_table(t.spark, f"{t.sf_dir}/supplier.parquet", "s_suppkey BIGINT, s_name STRING, s_nationkey INT")


@query("s05_link_vertices", "SELECT a, b, ord, x, y FROM fx_vertex")
def link_vertices(t):
    from ..operators.links import vertex_rows

    return vertex_rows(t["link_shape"].select("a", "b", "vertices"))


@query(
    "s06_route_vertices",
    f"WITH {ROUTE_SQL} SELECT tr_line, count(*) AS n, {rnd('max(m)', 4)} AS length FROM ms WHERE px IS NULL OR NOT (x = px AND y = py) GROUP BY tr_line",
)
def stored_route_vertices(t):
    """Vertices written as text and read back from it."""
    from ..operators.geometry import route_vertices
    from ..operators.ordering import sorted_positions

    lines = sorted_positions(t["fx_itin"].select("tr_line").distinct(), ["tr_line"], "rte")
    text = L.route_vertex_text(route_vertices(t["fx_itin"], directed(t), t.layout).join(lines, "tr_line"))
    read = text.select(F.from_csv("line", F.lit(readers.VERTEX_LINE), {"sep": ";"}).alias("v")).select("v.*")
    sums = read.groupBy("rte").agg(F.count(F.lit(1)).alias("n"), C.round_half_away(F.max("m"), 4).alias("length"))
    return sums.join(lines, "rte").select("tr_line", "n", "length")


@query(
    "s07_fare_dimension",
    f"SELECT n.node, f.system, f.zone_id, f.cost FROM fx_node n JOIN {FARE_SQL} ON f.zone_id = CAST(1 + n.node % 11 AS STRING)",
)
def fare_dimension(t):
    zone = (1 + F.col("node") % 11).cast("string")
    return t["fx_node"].select("node", zone.alias("zone_id")).join(F.broadcast(fare_zones(t.spark)), "zone_id").select("node", "system", "zone_id", "cost")


@query("s08_extract", "SELECT tr_line, it_order, itin_a, itin_b FROM fx_itin")
def extract(t):
    """A full copy under a new path, read back from there."""
    path = f"{shared_folder(t.spark)}/extract-{uuid.uuid4().hex}"
    return readers.snapshot(t["fx_itin"].select("tr_line", "it_order", "itin_a", "itin_b"), path)


@query(
    "s09_all_systems",
    f"""WITH {SPLIT_ITIN}, sy AS (SELECT 'north' AS system UNION ALL SELECT 'south')
       SELECT sy.system, tr_line, it_order, itin_a, itin_b, CAST(dep_time AS DOUBLE) AS dep_time, {rnd("t_meas", 2)} AS t_meas FROM cut CROSS JOIN sy""",
)
def all_systems(t):
    """Two systems with equal line names go through one job, the system being a part of every key."""
    from ..operators.edits import apply_splits

    both = t["fx_mitin"].withColumn("system", F.explode(F.array(F.lit("north"), F.lit("south"))))
    out = apply_splits(both, pieces_of(t), True, t.layout, ("system",))
    return out.select("system", "tr_line", "it_order", "itin_a", "itin_b", F.col("dep_time").cast("double").alias("dep_time"), C.round_half_away("t_meas", 2).alias("t_meas"))
