"""Feed import, coding import and data checks (D1-D12, V, K12, K14)."""

from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import coding as D
from ..operators import feed as S
from ..operators import itinerary as I
from ..operators import qc as Q
from ..operators import runs as R
from ..operators import tables as T
from ..operators.links import link_ends
from ..operators.stores import forget, stored
from ..sources.dims import fare_zones
from .fixpoints import paths_sql
from .registry import query, rnd
from .scalars import _DESCR, _RUN_NO, FARE_SQL

# --- feed ---------------------------------------------------------------------------------------------

_PREFIX_SQL = """CASE WHEN mode = 'C' THEN
   CASE upper(route_id) WHEN 'BLUE' THEN 'cbl' WHEN 'RED' THEN 'crd' WHEN 'YELLOW' THEN 'cye'
        WHEN 'GREEN' THEN CASE WHEN upper(description) LIKE '%ASHLAND%' THEN 'cga' ELSE 'cgc' END END
   WHEN line LIKE '%BNSF^_%' ESCAPE '^' THEN 'mbn' WHEN line LIKE '%MD-W^_%' ESCAPE '^' THEN 'mmw'
   WHEN line LIKE '%ME^_%' ESCAPE '^' THEN 'mme' WHEN line LIKE '%UP-NW^_%' ESCAPE '^' THEN 'mnw'
   WHEN line LIKE '%UP-N^_%' ESCAPE '^' THEN 'mun' WHEN line LIKE '%shore%' THEN 'mss' END"""

_USABLE = """bad AS (SELECT line FROM fx_feed_seg GROUP BY line HAVING count(*) = 1 AND max(CASE WHEN itin_a = itin_b THEN 1 ELSE 0 END) = 1),
 ok AS (SELECT * FROM fx_feed_seg WHERE line NOT IN (SELECT line FROM bad))"""


@query(
    "v01_same_end_single",
    f"WITH {_USABLE} SELECT 'bad_itinerary' AS \"check\", line AS key, CAST(itin_a AS STRING) || ' ' || CAST(itin_b AS STRING) AS detail FROM fx_feed_seg WHERE line IN (SELECT line FROM bad)",
)
def same_end_single(t):
    return Q.same_end_single(S.usable_segments(t["fx_feed_seg"])[1])


def _serials(base: int) -> str:
    return f"""SELECT line, prefix || printf('%03d', {base} + row_number() OVER (PARTITION BY prefix ORDER BY mode, line)) AS tr_line
       FROM (SELECT line, mode, {_PREFIX_SQL} AS prefix FROM fx_feed_run) q"""


@query("w12_line_serials", _serials(400))
def serials(t):
    runs = t["fx_feed_run"]
    prefix = C.line_prefix("mode", F.upper("route_id"), "line", F.upper("description"))
    return S.number_lines(runs.withColumn("prefix", prefix), base=False).select("line", "tr_line")


@query(
    "d01_run_headers",
    f"""WITH {_USABLE}, r AS (SELECT *, {_PREFIX_SQL} AS prefix FROM fx_feed_run WHERE line IN (SELECT line FROM ok))
     SELECT prefix || printf('%03d', row_number() OVER (PARTITION BY prefix ORDER BY mode, line)) AS tr_line, line,
       substr({_DESCR}, 1, 50) AS description, mode, CASE WHEN mode = 'C' THEN 7 ELSE 8 END AS veh_type, 99 AS headway,
       greatest(15.0::DOUBLE, {rnd("speed", 0)}) AS speed, substr(line, 1, 20) AS feedline,
       substr(CASE WHEN mode = 'C' THEN upper(route_id) ELSE {_RUN_NO} END, 1, 10) AS route_id,
       substr(upper(route_long_name), 1, 32) AS longname, substr(upper(direction), 1, 32) AS direction,
       substr(upper(terminal), 1, 32) AS terminal FROM r""",
)
def run_headers(t):
    good, _ = S.usable_segments(t["fx_feed_seg"])
    return S.format_runs(t["fx_feed_run"], good)


FOLD_SQL = """z AS (SELECT *, itin_a = itin_b AS same, it_order - row_number() OVER (PARTITION BY tr_line, itin_a = itin_b ORDER BY it_order) AS g FROM fx_feed_seg),
 e AS (SELECT tr_line, max(it_order) AS lst FROM z WHERE NOT same GROUP BY tr_line),
 st AS (SELECT z.tr_line, min(it_order) AS lo, max(it_order) AS hi, min(dep_time) AS dep, max(arr_time) AS arr, sum(ltime) AS add, max(lst) AS lst
        FROM z JOIN e ON e.tr_line = z.tr_line WHERE same GROUP BY z.tr_line, g),
 mv AS (SELECT tr_line, CASE WHEN hi > lst THEN lo - 1 ELSE hi + 1 END AS it_order, max(CASE WHEN hi <= lst THEN dep END) AS dep,
          max(CASE WHEN hi > lst THEN arr END) AS arr, sum(add) AS add FROM st GROUP BY 1, 2),
 folded AS (SELECT z.line, z.mode, z.tr_line, z.it_order, z.itin_a, z.itin_b, coalesce(mv.dep, z.dep_time) AS dep_time,
          coalesce(mv.arr, z.arr_time) AS arr_time, z.ltime + coalesce(mv.add, 0) AS ltime, z.dw_code, z.zone_id_a, z.zone_id_b
        FROM z LEFT JOIN mv ON mv.tr_line = z.tr_line AND mv.it_order = z.it_order WHERE NOT same)"""


@query("d02_folded_segments", f"WITH {FOLD_SQL} SELECT tr_line, it_order, dep_time, arr_time, {rnd('ltime', 6)} AS ltime FROM folded")
def folded(t):
    out = S.fold_zero_pairs(t["fx_feed_seg"], t.layout)
    return out.select("tr_line", "it_order", "dep_time", "arr_time", C.round_half_away("ltime", 6).alias("ltime"))


def _fare_sql(src: str) -> str:
    return f"""fare AS (SELECT s.*, CASE WHEN fa.cost IS NULL OR fb.cost IS NULL THEN 0.0::DOUBLE
       ELSE {rnd("abs(fa.cost - fb.cost) / 40.0 * 100.0", 2)} END AS zn_fare FROM {src} s
     LEFT JOIN (SELECT * FROM {FARE_SQL}) fa ON fa.zone_id = s.zone_id_a AND s.mode <> 'C' AND fa.system = CASE WHEN line LIKE 'metra%' THEN 'metra' ELSE 'shore' END
     LEFT JOIN (SELECT * FROM {FARE_SQL}) fb ON fb.zone_id = s.zone_id_b AND s.mode <> 'C' AND fb.system = CASE WHEN line LIKE 'metra%' THEN 'metra' ELSE 'shore' END)"""


@query("d03_zone_fares", f"WITH {_fare_sql('fx_feed_seg')} SELECT tr_line, it_order, zn_fare FROM fare")
def zone_fares(t):
    return S.add_zone_fares(t["fx_feed_seg"], fare_zones(t.spark)).select("tr_line", "it_order", "zn_fare")


_PAIRS = """SELECT DISTINCT itin_a AS src, itin_b AS dst FROM fx_feed_seg WHERE itin_a <> itin_b
   AND (itin_a, itin_b) NOT IN (SELECT a, b FROM fx_net)"""
_FILL = f"""WITH RECURSIVE {paths_sql(_PAIRS)}, {FOLD_SQL}, {_fare_sql('folded')},
 pc AS MATERIALIZED (SELECT p.src, p.dst, p.pos AS i, q.node AS newa, p.node AS newb, n.miles AS linkmi, sum(n.miles) OVER (PARTITION BY p.src, p.dst) AS totmi
   FROM path p JOIN path q ON q.src = p.src AND q.dst = p.dst AND q.pos = p.pos - 1 JOIN fx_net n ON n.a = q.node AND n.b = p.node),
 r AS (SELECT f.tr_line, f.it_order AS seg_order, coalesce(i, 0) AS i, coalesce(newa, itin_a) AS itin_a, coalesce(newb, itin_b) AS itin_b,
     CASE WHEN newa IS NULL THEN ltime ELSE {rnd("(arr_time - dep_time) / 60.0 * linkmi / totmi", 1)} END AS ltime,
     CASE WHEN i > 2 THEN 0.0::DOUBLE ELSE zn_fare END AS zn_fare,
     CASE WHEN newa IS NULL THEN dw_code WHEN newb = itin_b THEN 0 ELSE 1 END AS dw_code,
     CASE WHEN newa IS NULL THEN 0 ELSE 1 END AS imputed, dep_time, arr_time
   FROM fare f LEFT JOIN pc ON pc.src = f.itin_a AND pc.dst = f.itin_b),
 o AS (SELECT *, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY seg_order, i) AS INT) AS it_order FROM r),
 c AS (SELECT *, coalesce(lag(imputed) OVER w = imputed AND lag(dep_time) OVER w = dep_time, false) AS same, lag(imputed) OVER w AS pi
        FROM o WINDOW w AS (PARTITION BY tr_line ORDER BY it_order)),
 d AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY tr_line ORDER BY it_order) AS isle FROM c),
 g AS (SELECT *, CASE WHEN imputed = 1 THEN dep_time + sum(ltime * 60) OVER (PARTITION BY tr_line, isle ORDER BY it_order) ELSE arr_time END AS arr FROM d),
 h AS (SELECT *, lag(arr) OVER (PARTITION BY tr_line ORDER BY it_order) AS prev FROM g),
 filled AS (SELECT tr_line, it_order, seg_order, itin_a, itin_b, ltime, zn_fare, dw_code, imputed, arr AS arr_time,
     CASE WHEN (imputed = 1 AND same) OR (NOT same AND pi > imputed AND seg_order > 1) THEN prev ELSE dep_time END AS dep_time FROM h)"""


def filled_segments(t):
    read = stored(t["fx_feed_seg"], "feed")  # folding reads it several times
    segs = S.add_zone_fares(S.fold_zero_pairs(read, t.layout), fare_zones(t.spark))
    filled = S.fill_gaps(segs, t["fx_net"], t.layout, {"C": (30000, 39999), "M": (30000, 49999)})
    forget(read)  # what it fills is written by now
    return filled


@query(
    "d04_filled_gaps",
    f"""{_FILL} SELECT tr_line, it_order, itin_a, itin_b, {rnd("ltime", 6)} AS ltime, zn_fare, dw_code, imputed,
        {rnd("dep_time", 3)} AS dep_time, {rnd("arr_time", 3)} AS arr_time FROM filled""",
)
def filled_gaps(t):
    out = filled_segments(t)
    r3 = {n: C.round_half_away(n, 3) for n in ("dep_time", "arr_time")}
    cols = ["tr_line", "it_order", "itin_a", "itin_b", "ltime", "zn_fare", "dw_code", "imputed", "dep_time", "arr_time"]
    return out.withColumns({**r3, "ltime": C.round_half_away("ltime", 6)}).select(*cols)


@query(
    "d05_departure_after_imputed",
    """WITH z AS (SELECT tr_line, it_order, CASE WHEN it_order BETWEEN 2 AND 3 THEN 1 ELSE 0 END AS imputed, dep_time,
          sum(CASE WHEN it_order BETWEEN 2 AND 3 THEN ltime * 60 ELSE 0 END) OVER (PARTITION BY tr_line) AS spent,
          min(CASE WHEN it_order = 2 THEN dep_time END) OVER (PARTITION BY tr_line) AS d0 FROM fx_feed_seg)
       SELECT tr_line, it_order, floor((d0 + spent) * 1000 + 0.5 + 1e-9) / 1000 AS dep_time FROM z WHERE it_order = 4""",
)
def after_imputed(t):
    from .relational import imputed_rows

    out = I.imputed_clock(imputed_rows(t), t.layout).filter("it_order = 4")
    return out.select("tr_line", "it_order", C.round_half_away("dep_time", 3).alias("dep_time"))


@query(
    "d06_run_statistics",
    f"""WITH s AS (SELECT tr_line, it_order, CASE WHEN dep_time = 0 THEN arr_time ELSE least(dep_time, arr_time) END AS st,
          CASE WHEN dep_time >= 25200 AND (arr_time IS NULL OR arr_time <= 32400) THEN 1.0 ELSE 0.0 END AS am FROM fx_feed_seg),
        f AS (SELECT tr_line, arg_min(st, it_order) AS st FROM s WHERE st <> 0 GROUP BY tr_line),
        a AS (SELECT tr_line, sum(am) / count(*) AS am FROM s GROUP BY tr_line)
        SELECT a.tr_line, coalesce(st, 0) AS start_sec, CAST(floor(coalesce(st, 0) / 3600.0) AS INT) AS strthour, {rnd("am", 2)} AS am_share
        FROM a LEFT JOIN f ON f.tr_line = a.tr_line""",
)
def run_statistics(t):
    return R.run_statistics(t["fx_feed_seg"])


@query(
    "d07_final_itinerary",
    f"""WITH {_fare_sql('fx_feed_seg')} SELECT tr_line, itin_a, itin_b, it_order,
        CASE WHEN lead(it_order) OVER (PARTITION BY tr_line ORDER BY it_order) IS NULL THEN '3' ELSE '0' END AS layover,
        CASE WHEN itin_b = 30048 THEN 1 ELSE dw_code END AS dw_code, zn_fare, ltime AS trv_time, dep_time, arr_time, 0 AS imputed FROM fare""",
)
def final_itinerary(t):
    segs = S.add_zone_fares(t["fx_feed_seg"], fare_zones(t.spark)).withColumn("imputed", F.lit(0))
    return S.final_itinerary(segs, t.layout, no_stop=30048)


@query(
    "k12_hold_segments",
    """SELECT line, it_order, tr_line, itin_a, itin_b, dep_time, arr_time, ltime FROM fx_feed_seg
       WHERE NOT EXISTS (SELECT 1 FROM fx_link WHERE a = itin_a AND b = itin_b)""",
)
def hold(t):
    held = S.split_matched(t["fx_feed_seg"], t["fx_link"])[1]
    return held.select("line", "it_order", "tr_line", "itin_a", "itin_b", "dep_time", "arr_time", "ltime")


# --- coding -------------------------------------------------------------------------------------------

CODED_SQL = f"""h AS (SELECT lower(tr_line) AS tr_line, mode, action, scenario, tod, substr(upper(replace(description, '''', '')), 1, 20) AS description,
    substr(upper(replace(notes, '''', '')), 1, 30) AS notes, coalesce(speed, 0) AS speed FROM fx_fhead WHERE action >= 1),
 s AS (SELECT lower(i.tr_line) AS tr_line, CAST(ord AS INT) AS ord, itin_a, itin_b, dw_code, {rnd("coalesce(trv_time, 0)", 1)} AS trv_time,
    coalesce(zn_fare, 0) AS zn_fare, CASE WHEN dw_code = '1' THEN 0.0::DOUBLE ELSE 0.01::DOUBLE END AS dw_time,
    CASE WHEN layover > 0 THEN CAST(layover AS STRING) ELSE '' END AS lo, h.action
    FROM fx_fitin i LEFT JOIN h ON h.tr_line = lower(i.tr_line) WHERE ord = floor(ord))"""


def coded(t):
    routes = D.read_headers(t["fx_fhead"])
    return routes, D.read_segments(t["fx_fitin"], routes)


@query("d08_coded_segments", f"WITH {CODED_SQL} SELECT tr_line, ord, itin_a, itin_b, dw_code, trv_time, dw_time, lo, action FROM s")
def coded_segments(t):
    return coded(t)[1].select("tr_line", "ord", "itin_a", "itin_b", "dw_code", "trv_time", "dw_time", "lo", "action")


@query("s03_coding_headers", f"WITH {CODED_SQL} SELECT tr_line, mode, action, scenario, tod, description, notes, speed FROM h")
def coded_headers(t):
    return coded(t)[0].select("tr_line", "mode", "action", "scenario", "tod", "description", "notes", "speed")


_RENUM = "n AS (SELECT *, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY ord) AS INT) AS it_order FROM s WHERE action IN (1, 5))"


def on_network(t):
    segs = coded(t)[1].filter(F.col("action").isin(1, 5)).withColumn("it_order", F.col("ord"))
    return I.resequence(segs, t.layout)


@query(
    "d09_terminus_swap",
    f"""WITH {CODED_SQL}, {_RENUM} SELECT tr_line, it_order, CASE WHEN action = 5 AND it_order = 1 THEN TRY_CAST(lo AS INT) ELSE itin_a END AS itin_a,
       CASE WHEN action = 5 AND it_order = 2 THEN TRY_CAST(lo AS INT) ELSE itin_b END AS itin_b,
       CASE WHEN action = 5 AND it_order = 1 THEN CAST(itin_a AS STRING) WHEN action = 5 AND it_order = 2 THEN CAST(itin_b AS STRING) ELSE lo END AS lo,
       CASE WHEN action = 5 THEN itin_a END AS orig_a, CASE WHEN action = 5 THEN itin_b END AS orig_b, CASE WHEN action = 5 THEN lo END AS orig_lo FROM n""",
)
def terminus_swap(t):
    cols = ["tr_line", "it_order", "itin_a", "itin_b", "lo", "orig_a", "orig_b", "orig_lo"]
    return D.swap_terminus(on_network(t)).select(*cols)


_CPAIRS = """SELECT DISTINCT itin_a AS src, itin_b AS dst FROM fx_fitin WHERE itin_a <> itin_b"""
_CFILL = f"""WITH RECURSIVE {paths_sql(_CPAIRS)}, {CODED_SQL},
 pc AS MATERIALIZED (SELECT p.src, p.dst, p.pos AS i, q.node AS newa, p.node AS newb
   FROM path p JOIN path q ON q.src = p.src AND q.dst = p.dst AND q.pos = p.pos - 1),
 f AS (SELECT s.tr_line, s.action, s.ord, coalesce(pc.i, 0) AS i, coalesce(newa, itin_a) AS itin_a, coalesce(newb, itin_b) AS itin_b,
     itin_a AS orig_a, itin_b AS orig_b, dw_code, lo, trv_time FROM s LEFT JOIN pc ON pc.src = s.itin_a AND pc.dst = s.itin_b WHERE action IN (2, 3, 6, 7)),
 p2 AS (SELECT *, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY ord, i) AS INT) AS it_order FROM f),
 ms AS (SELECT p2.*, sum(coalesce(miles, 0)) OVER (PARTITION BY p2.tr_line ORDER BY it_order) AS t_meas, coalesce(miles, 0) AS mi
        FROM p2 LEFT JOIN fx_net n ON n.a = p2.itin_a AND n.b = p2.itin_b)"""
RANGES = {"C": (30000, 39999), "M": (30000, 49999)}


def path_filled(t):
    segs = coded(t)[1].filter(F.col("action").isin(*D.PATH_ACTIONS))
    return D.fill_paths(segs, t["fx_net"], t.layout, RANGES)


@query("d10_future_paths", f"{_CFILL} SELECT tr_line, it_order, itin_a, itin_b, orig_a, orig_b, dw_code, lo FROM p2")
def future_paths(t):
    return path_filled(t).select("tr_line", "it_order", "itin_a", "itin_b", "orig_a", "orig_b", "dw_code", "lo")


@query(
    "d11_coded_form",
    f"""{_CFILL} SELECT tr_line, orig_a AS itin_a, orig_b AS itin_b, dw_code, max(lo) AS layover, {rnd("min(t_meas - mi)", 6)} AS f_meas,
        {rnd("max(t_meas)", 6)} AS t_meas, CAST(0 AS BIGINT) AS it_order, {rnd("avg(trv_time)", 6)} AS trv_time
        FROM ms GROUP BY tr_line, orig_a, orig_b, dw_code""",
)
def coded_form(t):
    rows = path_filled(t).withColumn("orig_lo", F.col("lo"))
    out = D.coded_form(D.measured(rows, t["fx_net"], t.layout))
    return out.withColumns({n: C.round_half_away(n, 6) for n in ("f_meas", "t_meas", "trv_time")})


@query(
    "d12_replaced_lines",
    """SELECT 'route' AS tab, tr_line, count(*) AS n FROM (SELECT tr_line FROM fx_run WHERE o_orderkey % 9 <> 2 UNION ALL
         SELECT tr_line FROM fx_run WHERE o_orderkey % 9 = 2) u GROUP BY tr_line
       UNION ALL SELECT 'itin', tr_line, count(*) FROM (SELECT tr_line FROM fx_itin WHERE CAST(substr(tr_line, 4, 7) AS BIGINT) % 9 <> 2
         UNION ALL SELECT tr_line FROM fx_itin WHERE CAST(substr(tr_line, 4, 7) AS BIGINT) % 9 = 2 AND it_order > 1) u GROUP BY tr_line""",
)
def replaced(t):
    """Every ninth line is imported again, without its first segment."""
    routes = t["fx_run"].select("tr_line", "mode")
    new_routes = t["fx_run"].filter("o_orderkey % 9 = 2").select("tr_line", "mode")
    new_itin = t["fx_itin"].join(new_routes.select("tr_line"), "tr_line", "left_semi").filter("it_order > 1")
    r, i = D.replace_lines(routes, t["fx_itin"], new_routes, new_itin)
    n = F.count(F.lit(1)).alias("n")
    both = r.select(F.lit("route").alias("tab"), "tr_line").unionByName(i.select(F.lit("itin").alias("tab"), "tr_line"))
    return both.groupBy("tab", "tr_line").agg(n)


# --- checks -------------------------------------------------------------------------------------------


def _v(check: str, key: str, detail: str, rest: str) -> str:
    return f'SELECT \'{check}\' AS "check", {key} AS key, {detail} AS detail {rest}'


def _ab(alias: str = "") -> str:
    return f"CAST({alias}itin_a AS STRING) || ' ' || CAST({alias}itin_b AS STRING)"


@query(
    "v02_headers_and_itineraries",
    _v("route_without_itinerary", "tr_line", "''", "FROM fx_run WHERE tr_line NOT IN (SELECT tr_line FROM fx_itin)")
    + " UNION ALL "
    + _v("itinerary_without_header", "tr_line", "''", "FROM (SELECT DISTINCT tr_line FROM fx_itin WHERE tr_line NOT IN (SELECT tr_line FROM fx_run WHERE mode = 'C')) q"),
)
def headers(t):
    cta = t["fx_run"].filter("mode = 'C'")
    return Q.violations(Q.header_without_itinerary(t["fx_run"], t["fx_itin"]), Q.itinerary_without_header(cta, t["fx_itin"]))


@query(
    "v03_not_on_link",
    f"WITH {CODED_SQL} " + _v("not_on_link", "tr_line", _ab(), "FROM s WHERE action NOT IN (2, 3, 6, 7) AND (itin_a, itin_b) NOT IN (SELECT a, b FROM fx_link WHERE miles > 0)"),
)
def not_on_link(t):
    return Q.not_on_link(coded(t)[1], t["fx_link"])


_RULES = {
    "v04": ("junction_stop", "action = 1 AND (itin_b BETWEEN 39001 AND 39999 OR itin_b BETWEEN 49001 AND 49999) AND dw_code = '0'"),
    "v05": ("no_time_reduction", "action = 2 AND trv_time = 0"),
    "v06": ("no_new_station", "action = 3 AND lo = ''"),
    "v07": ("bad_terminus", "action = 5 AND (lo = '' OR ord NOT IN (1, 2, 6))"),
    "v08": ("time_on_action_6", "action = 6 AND trv_time <> 0"),
    "v09": ("no_consolidated_station", "action = 7 AND lo = ''"),
}


def _junctioned(t):
    """Coded segments with every sixth end node moved into the junction range."""
    b = F.when(F.col("itin_b") % 6 == 0, F.col("itin_b") + 9001).otherwise(F.col("itin_b"))
    return coded(t)[1].withColumn("itin_b", b)


_JUNCTIONED = CODED_SQL + ", j AS (SELECT * REPLACE (CASE WHEN itin_b % 6 = 0 THEN itin_b + 9001 ELSE itin_b END AS itin_b) FROM s)"

for _id, (_name, _test) in _RULES.items():
    query(f"{_id}_{_name}", f"WITH {_JUNCTIONED} " + _v(_name, "tr_line", _ab(), f"FROM j WHERE {_test}"))(
        lambda t, name=_name: Q.segment_rule(_junctioned(t), name)
    )


@query(
    "v10_header_rules",
    f"WITH {CODED_SQL} " + _v("no_scenario", "tr_line", "''", "FROM h WHERE scenario = ''") + " UNION ALL " + _v("several_modes", "tr_line", "''", "FROM h WHERE length(mode) > 1"),
)
def header_rules(t):
    return Q.header_rules(coded(t)[0])


@query(
    "v11_too_many_layovers",
    _v("too_many_layovers", "s.scenario || '|' || tr_line", "CAST(count(*) AS STRING)",
       "FROM fx_itin CROSS JOIN (SELECT '1' AS scenario UNION ALL SELECT '3') s WHERE dw_code = '1' GROUP BY s.scenario, tr_line HAVING count(*) > 2"),
)
def layovers(t):
    """Counted for each scenario on its own."""
    rows = t["fx_itin"].withColumn("scenario", F.explode(F.array(F.lit(1), F.lit(3))))
    return Q.too_many_layovers(rows, F.col("dw_code") == "1", by=("scenario",))


_HOLED = "fx_itin WHERE (itin_a * 7 + itin_b + it_order) % 9 <> 0"


@query(
    "v12_itinerary_gaps",
    _v("itinerary_gap", "tr_line", f"CAST(it_order AS STRING) || ' ' || CAST(itin_a AS STRING) || ' ' || CAST(z AS STRING)",
       f"FROM (SELECT *, lag(itin_b) OVER (PARTITION BY tr_line ORDER BY it_order) AS z FROM {_HOLED}) q WHERE z <> itin_a"),
)
def itinerary_gaps(t):
    holed = t["fx_itin"].filter((F.col("itin_a") * 7 + F.col("itin_b") + F.col("it_order")) % 9 != 0)
    return Q.itinerary_gaps(holed, t.layout)


@query(
    "v13_bad_ends",
    _v("bad_segment", "CAST(itin_a AS STRING) || '-' || CAST(itin_b AS STRING)", "''",
       "FROM (SELECT DISTINCT itin_a, itin_b FROM fx_itin WHERE itin_a = itin_b OR itin_a <= 30010 OR itin_b <= 30010) q"),
)
def bad_ends(t):
    return Q.bad_ends(t["fx_itin"], max_zone=30010)


@query(
    "v14_junction_stops",
    _v("stop_at_junction", "tr_line", _ab(), "FROM (SELECT tr_line, itin_a, itin_b + 8950 AS itin_b, dw_code FROM fx_itin) q WHERE itin_b BETWEEN 39001 AND 39999 AND dw_code = '0'"),
)
def junction_stops(t):
    return Q.junction_stops(t["fx_itin"].withColumn("itin_b", F.col("itin_b") + 8950))


_FAULTY = "(SELECT a, b, CASE WHEN a % 11 = 0 THEN 0 ELSE miles END AS miles, CASE WHEN b % 13 = 0 THEN '' ELSE modes1 END AS modes1 FROM fx_link) q"


@query(
    "v15_link_faults",
    _v("link_without_length", "CAST(a AS STRING) || '-' || CAST(b AS STRING)", "''", f"FROM {_FAULTY} WHERE miles = 0") + " UNION ALL "
    + _v("link_without_mode", "CAST(a AS STRING) || '-' || CAST(b AS STRING)", "''", f"FROM {_FAULTY} WHERE modes1 = ''"),
)
def link_faults(t):
    miles = F.when(F.col("a") % 11 == 0, 0.0).otherwise(F.col("miles"))
    modes = F.when(F.col("b") % 13 == 0, "").otherwise(F.col("modes1"))
    return Q.link_faults(t["fx_link"].withColumns({"miles": miles, "modes1": modes}))


_NODES2 = "(SELECT node, CASE WHEN node % 17 = 0 THEN NULL ELSE point_x END AS point_x, point_y FROM fx_node UNION ALL SELECT node, 1, 1 FROM fx_node WHERE node % 19 = 0) q"


@query(
    "v16_node_faults",
    _v("node_without_coordinates", "CAST(node AS STRING)", "''", f"FROM {_NODES2} WHERE point_x IS NULL OR point_y IS NULL") + " UNION ALL "
    + _v("duplicate_node", "CAST(node AS STRING)", "CAST(count(*) AS STRING)", f"FROM {_NODES2} GROUP BY node HAVING count(*) > 1"),
)
def node_faults(t):
    x = F.when(F.col("node") % 17 != 0, F.col("point_x"))
    nodes = t["fx_node"].select("node", x.alias("point_x"), "point_y")
    extra = t["fx_node"].filter("node % 19 = 0").select("node", F.lit(1.0).alias("point_x"), F.lit(1.0).alias("point_y"))
    return Q.node_faults(nodes.unionByName(extra))


@query(
    "v17_several_coordinates",
    _v("several_coordinates", "CAST(node AS STRING)", "CAST(count(*) AS STRING)",
       """FROM (SELECT DISTINCT node, px, py FROM (
            SELECT a AS node, CASE WHEN (a + b) % 50 = 0 THEN x + 10 ELSE x END AS px, y AS py FROM fx_vertex WHERE ord = 1
            UNION ALL SELECT b, x, y FROM fx_vertex WHERE ord = 3) e) q GROUP BY node HAVING count(*) > 1"""),
)
def several_coordinates(t):
    ends = link_ends(t["link_shape"])
    moved = (F.col("which") == "start") & ((F.col("a") + F.col("b")) % 50 == 0)
    return Q.several_coordinates(
        ends.select(
            F.when(F.col("which") == "start", F.col("a")).otherwise(F.col("b")).alias("node"),
            F.when(moved, F.col("point_x") + 10).otherwise(F.col("point_x")).alias("point_x"), "point_y",
        )
    )


@query(
    "v18_extension_orders",
    _v("bad_extension_order", "tr_line", "CAST(o AS STRING)", "FROM (SELECT tr_line, CASE WHEN itin_a % 2 = 0 THEN -it_order ELSE it_order * 300 END AS o FROM fx_itin) q WHERE o > -1 AND o < 1001"),
)
def extension_orders(t):
    o = F.when(F.col("itin_a") % 2 == 0, -F.col("it_order")).otherwise(F.col("it_order") * 300)
    return Q.extension_orders(t["fx_itin"].withColumn("it_order", o))


@query(
    "v19_generic_deleted",
    _v("generic_line_uses_deleted_node", "tr_line", "CAST(it_order AS STRING) || ' ' || CAST(node AS STRING)",
       """FROM (SELECT DISTINCT i.tr_line, i.it_order, d.node FROM (SELECT substr(tr_line, 1, 3) || '***' || substr(tr_line, 4) AS tr_line, it_order, itin_a, itin_b
          FROM fx_itin WHERE dw_code = '1') i JOIN fx_deleted d ON d.node = i.itin_a OR d.node = i.itin_b) q"""),
)
def generic_deleted(t):
    name = F.concat(F.substring("tr_line", 1, 3), F.lit("***"), F.expr("substr(tr_line, 4)"))
    generic = t["fx_itin"].withColumn("tr_line", F.when(F.col("dw_code") == "1", name).otherwise(F.col("tr_line")))
    return Q.generic_uses_deleted(generic, t["fx_deleted"])


@query(
    "v20_dropped_routes",
    _v("dropped_route", "tr_line", "'left'", "FROM (SELECT DISTINCT tr_line FROM fx_itin WHERE tr_line NOT IN (SELECT tr_line FROM fx_run WHERE o_orderkey % 10 <> 3)) q") + " UNION ALL "
    + _v("dropped_route", "tr_line", "'right'", "FROM fx_run WHERE o_orderkey % 10 <> 3 AND tr_line NOT IN (SELECT tr_line FROM fx_itin)"),
)
def dropped_routes(t):
    runs = t["fx_run"].filter(F.col("o_orderkey") % 10 != 3)
    return Q.one_sided_routes(T.reconcile(t["fx_itin"], runs, "tr_line")[1])


@query(
    "k14_violations",
    f'WITH {_JUNCTIONED} SELECT "check", count(*) AS n FROM ('
    + " UNION ALL ".join(_v(n, "tr_line", _ab(), f"FROM j WHERE {w}") for n, w in _RULES.values())
    + " UNION ALL " + _v("no_scenario", "tr_line", "''", "FROM h WHERE scenario = ''")
    + " UNION ALL " + _v("several_modes", "tr_line", "''", "FROM h WHERE length(mode) > 1")
    + ') u GROUP BY "check"',
)
def violations(t):
    found = Q.violations(Q.all_segment_rules(_junctioned(t)), Q.header_rules(coded(t)[0]))
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
