"""Scalar functions, projections and filters (F, P)."""

from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import selection as P
from ..sources.dims import FARES, fare_zones
from .registry import query, rnd


@query(
    "f01_case",
    "SELECT DISTINCT lower(line) AS low, upper(route_id) AS up FROM fx_feed_run",
)
def case(t):
    return t["fx_feed_run"].select(F.lower("line").alias("low"), F.upper("route_id").alias("up")).distinct()


@query(
    "f02_strip_chars",
    "SELECT line, translate(line, '_-X', '') AS stripped, replace(description, ' ', '') AS packed FROM fx_feed_run",
)
def strip(t):
    return t["fx_feed_run"].select(
        "line", C.strip_chars("line", "_-X").alias("stripped"), C.strip_chars("description", " ").alias("packed")
    )


@query(
    "f03_substring",
    """SELECT line, substr(line, 1, 8) AS head, substr(route_long_name, 1, 20) AS cut, CAST(length(line) AS INT) AS n
       FROM fx_feed_run""",
)
def substring(t):
    return t["fx_feed_run"].select(
        "line", C.first_n("line", 8).alias("head"), C.first_n("route_long_name", 20).alias("cut"),
        F.length("line").alias("n"),
    )


@query(
    "f04_token",
    """SELECT line, description,
         list_filter(string_split_regex(line, '[_]+'), lambda x: x <> '')[2] AS second,
         list_filter(string_split_regex(description, '[ -]+'), lambda x: x <> '')[3] AS third FROM fx_feed_run""",
)
def tokens(t):
    return t["fx_feed_run"].select(
        "line", "description", C.token("line", 2, "_").alias("second"), C.token("description", 3, " -").alias("third")
    )


@query(
    "f05_find",
    """SELECT line, CAST(instr(line, 'UP') AS INT) AS at_up, CASE WHEN line LIKE '%shore%' THEN 1 ELSE 0 END AS shore,
         CAST(instr(line, regexp_extract(line, '[0-9]')) AS INT) AS digit_at,
         CAST(length(line) - length(replace(line, '_', '')) AS INT) AS unders FROM fx_feed_run""",
)
def find(t):
    return t["fx_feed_run"].select(
        "line", F.instr("line", "UP").alias("at_up"), F.col("line").contains("shore").cast("int").alias("shore"),
        C.first_digit_pos("line").alias("digit_at"), C.count_char("line", "_").alias("unders"),
    )


@query(
    "f06_replace",
    "SELECT line, replace(line, 'metra', 'rail') AS swapped, printf('%s%03d', 'cbl', o_orderkey) AS padded FROM fx_feed_run",
)
def replace(t):
    return t["fx_feed_run"].select(
        "line", F.replace("line", F.lit("metra"), F.lit("rail")).alias("swapped"),
        C.serial_name(F.lit("cbl"), "o_orderkey").alias("padded"),
    )


@query(
    "f07_format_parse",
    """SELECT tr_line, CASE WHEN c % 12 = 0 THEN '12' ELSE CAST(c % 12 AS STRING) END || ':' ||
         lpad(CAST(m AS STRING), 2, '0') || CASE WHEN c >= 12 THEN ' PM' ELSE ' AM' END AS clock, parsed
       FROM (SELECT tr_line, CAST(floor((start_sec % 86400) / 3600.0) AS INT) AS c,
                    CAST(floor((start_sec % 3600) / 60.0) AS INT) AS m,
                    TRY_CAST(substr(tr_line, 4, 7) AS INT) AS parsed FROM fx_run) q""",
)
def format_parse(t):
    return t["fx_run"].select(
        "tr_line", C.clock_text("start_sec").alias("clock"), F.substring("tr_line", 4, 7).try_cast("int").alias("parsed")
    )


@query(
    "f08_concat",
    "SELECT line, trim(line) || ' ' || trim(direction) || ' -' || terminal AS text FROM fx_feed_run",
)
def concat(t):
    text = F.concat(F.trim("line"), F.lit(" "), F.trim("direction"), F.lit(" -"), F.col("terminal"))
    return t["fx_feed_run"].select("line", text.alias("text"))


@query(
    "f09_arithmetic",
    f"""SELECT tr_line, it_order, itin_a, {rnd("trv_time / 3", 2)} AS r2, {rnd("2 - trv_time", 1)} AS neg,
         CAST(trunc(trv_time) AS INT) AS whole, least(trv_time, 2.5) AS lo, greatest(trv_time, 2.5) AS hi,
         {rnd("sqrt(trv_time)", 4)} AS root FROM fx_itin""",
)
def arithmetic(t):
    x = F.col("trv_time")
    return t["fx_itin"].select(
        "tr_line", "it_order", "itin_a", C.round_half_away(x / 3, 2).alias("r2"),
        C.round_half_away(2 - x, 1).alias("neg"), x.cast("int").alias("whole"),
        F.least(x, F.lit(2.5)).alias("lo"), F.greatest(x, F.lit(2.5)).alias("hi"),
        C.round_half_away(F.sqrt(x), 4).alias("root"),
    )


@query(
    "f10_start_hour",
    """SELECT tr_line, CAST(floor(start_sec / 3600.0) AS INT) AS hour,
         CASE WHEN start_sec % 86400 >= 43200 THEN 'PM' WHEN start_sec IS NOT NULL THEN 'AM' END AS ap FROM fx_run""",
)
def start_hour(t):
    ap = F.when(C.is_pm("start_sec"), "PM").when(F.col("start_sec").isNotNull(), "AM")
    return t["fx_run"].select("tr_line", C.start_hour("start_sec").alias("hour"), ap.alias("ap"))


def _pair_sql(col: str, tod: str) -> str:
    parts = f"string_split({col}, ':')"
    keep = f"list_filter(range(1, len({parts}), 2), lambda i: contains({parts}[i], '{tod}'))"
    return f"""CASE WHEN instr({col}, ':') = 0 THEN TRY_CAST({col} AS DOUBLE)
        ELSE TRY_CAST({parts}[list_aggregate({keep}, 'max') + 1] AS DOUBLE) END"""


@query(
    "f11_period_value",
    f"SELECT id, headway, {_pair_sql('headway', '2')} AS h2, {_pair_sql('headway', '4')} AS h4 FROM fx_future",
)
def period_value(t):
    return t["fx_future"].select(
        "id", "headway", C.period_value("headway", "2").alias("h2"), C.period_value("headway", "4").alias("h4")
    )


@query(
    "f12_scenario_value",
    """SELECT s.scen, n.node, coalesce(max(CASE WHEN k.s <= s.scen THEN
           CASE k.s WHEN 2 THEN n.pspace * 10 ELSE n.pspace * 20 END END)
           FILTER (ftr_pspace <> ''), max(n.pspace))::DOUBLE AS pspace
       FROM fx_node n CROSS JOIN (SELECT 1 AS scen UNION ALL SELECT 3 UNION ALL SELECT 6) s
       CROSS JOIN (SELECT 2 AS s UNION ALL SELECT 5) k GROUP BY s.scen, n.node""",
)
def scenario_value(t):
    scens = F.explode(F.array(F.lit(1), F.lit(3), F.lit(6))).alias("scen")
    nodes = t["fx_node"].select("*", scens)
    value = C.scenario_value("ftr_pspace", F.col("scen"), F.col("pspace").cast("double"))
    return nodes.select("scen", "node", value.alias("pspace"))


@query(
    "f13_line_prefix",
    """SELECT line, CASE WHEN mode = 'C' THEN
         CASE upper(route_id) WHEN 'BLUE' THEN 'cbl' WHEN 'RED' THEN 'crd' WHEN 'YELLOW' THEN 'cye'
              WHEN 'GREEN' THEN CASE WHEN upper(description) LIKE '%ASHLAND%' THEN 'cga' ELSE 'cgc' END END
       WHEN line LIKE '%BNSF^_%' ESCAPE '^' THEN 'mbn' WHEN line LIKE '%MD-W^_%' ESCAPE '^' THEN 'mmw'
       WHEN line LIKE '%ME^_%' ESCAPE '^' THEN 'mme' WHEN line LIKE '%UP-NW^_%' ESCAPE '^' THEN 'mnw'
       WHEN line LIKE '%UP-N^_%' ESCAPE '^' THEN 'mun' WHEN line LIKE '%shore%' THEN 'mss' END AS prefix
       FROM fx_feed_run""",
)
def line_prefix(t):
    prefix = C.line_prefix("mode", F.upper("route_id"), "line", F.upper("description"))
    return t["fx_feed_run"].select("line", prefix.alias("prefix"))


_RUN_NO = """regexp_replace(CASE WHEN line LIKE 'metra%' THEN string_split(line, '_')[2]
   ELSE substr(line, instr(line, regexp_extract(line, '[0-9]'))) END, '[A-Z]', '', 'g')"""


@query("f14_run_number", f"SELECT line, {_RUN_NO} AS run_no FROM fx_feed_run")
def run_number(t):
    return t["fx_feed_run"].select("line", C.run_number("line").alias("run_no"))


_ROAD = """CASE WHEN line LIKE '%BNSF%' THEN 'BNSF' WHEN line LIKE '%MD-W%' THEN 'MD-W' WHEN line LIKE '%ME^_%' ESCAPE '^' THEN 'ME'
  WHEN line LIKE '%UP-NW%' THEN 'UP-NW' WHEN line LIKE '%UP-N%' THEN 'UP-N' WHEN line LIKE '%shore%' THEN 'SS' END"""
_DESCR = f"""CASE WHEN mode = 'C' THEN upper(description) ELSE {_RUN_NO} || ' ' || {_ROAD} || ' -' ||
  replace(string_split(upper(description), '-')[2], ' METRA ', '') END"""


@query("f15_run_description", f"SELECT line, {_DESCR} AS descr FROM fx_feed_run")
def run_description(t):
    descr = C.run_description("mode", C.run_number("line"), C.railroad("line"), F.upper("description"))
    return t["fx_feed_run"].select("line", descr.alias("descr"))


@query(
    "f16_revised_description",
    """SELECT id, CASE WHEN action > 0 AND id % 1000 < 900 THEN
         substr(d, 1, instr(d, ' -') + 1) || 's3a' || CAST(action AS STRING) ||
         substr(d, CAST(instr(d, ' -') + 2 AS BIGINT), greatest(CAST(15 - instr(d, ' -') AS BIGINT), 0)) ELSE d END AS descr
       FROM (SELECT id, action, CAST(id AS STRING) || ' UP-N -' || longname AS d FROM fx_future) q""",
)
def revised_description(t):
    descr = F.concat(F.col("id").cast("string"), F.lit(" UP-N -"), F.col("longname"))
    name = C.serial_name(F.lit("mun"), F.col("id") % 1000)
    return t["fx_future"].select("id", C.revised_description(descr, name, 3, "action").alias("descr"))


_CODE = "CAST(it_order AS STRING)"


@query(
    "f17_dwell_text",
    f"""SELECT tr_line, it_order, 'dwt=' || CASE {_CODE} WHEN '1' THEN '#' WHEN '2' THEN '>' WHEN '3' THEN '<'
         WHEN '4' THEN '+' WHEN '5' THEN '*' ELSE '' END || CASE WHEN it_order = 1 THEN '0' ELSE '0.01' END AS txt
       FROM fx_itin""",
)
def dwell_text(t):
    code = F.col("it_order").cast("string")
    return t["fx_itin"].select("tr_line", "it_order", C.dwell_text(code, C.dwell_time(code)).alias("txt"))


@query(
    "f18_dwell_time",
    "SELECT tr_line, it_order, CASE WHEN dw_code = '1' THEN 0.0::DOUBLE ELSE 0.01::DOUBLE END AS dw_time FROM fx_itin",
)
def dwell_time(t):
    return t["fx_itin"].select("tr_line", "it_order", C.dwell_time("dw_code").alias("dw_time"))


@query("f19_line_group", "SELECT tr_line, substr(tr_line, 1, 3) AS ln FROM fx_run")
def line_group(t):
    return t["fx_run"].select("tr_line", C.line_group("tr_line").alias("ln"))


FARE_SQL = "(VALUES " + ", ".join(f"('{s}', '{z}', {c:.2f}::DOUBLE)" for s, z, c in FARES) + ") AS f(system, zone_id, cost)"


@query(
    "f20_zone_fare",
    f"""SELECT fa.zone_id AS za, fb.zone_id AS zb, n.node, {rnd("abs(fa.cost - fb.cost) / 40.0 * 100.0", 2)} AS fare
       FROM fx_node n JOIN (SELECT * FROM {FARE_SQL}) fa ON fa.system = 'metra' AND fa.zone_id = substr('ABCDEFGHIJKM', CAST(1 + n.node % 12 AS INT), 1)
       JOIN (SELECT * FROM {FARE_SQL}) fb ON fb.system = 'metra' AND fb.zone_id = substr('ABCDEFGHIJKM', CAST(1 + n.node % 5 AS INT), 1)""",
)
def zone_fare(t):
    letters = F.lit("ABCDEFGHIJKM")
    fares = fare_zones(t.spark).filter(F.col("system") == "metra").select("zone_id", "cost")
    nodes = t["fx_node"].select(
        "node", F.substr(letters, 1 + F.col("node") % 12, F.lit(1)).alias("za"),
        F.substr(letters, 1 + F.col("node") % 5, F.lit(1)).alias("zb"),
    )
    a = F.broadcast(fares.toDF("za", "ca"))
    b = F.broadcast(fares.toDF("zb", "cb"))
    return nodes.join(a, "za").join(b, "zb").select("za", "zb", "node", C.zone_fare("ca", "cb").alias("fare"))


@query(
    "f21_path_weight",
    """SELECT a, b, greatest(CAST(floor(round(miles * 100, 6)) AS BIGINT), 1) + CASE WHEN modes1 = 'C' THEN 0 ELSE 500 END AS weight
       FROM fx_link""",
)
def path_weight(t):
    base = F.when(F.col("modes1") == "C", 1).otherwise(0)
    return t["fx_link"].select("a", "b", C.path_weight("miles", base).alias("weight"))


# --- projection and filters -----------------------------------------------------------------------


@query("p01_columns", "SELECT itin_a AS anode, itin_b AS bnode, tr_line, it_order AS ord FROM fx_itin")
def columns(t):
    return P.pick(t["fx_itin"], {"itin_a": "anode", "itin_b": "bnode", "tr_line": "tr_line", "it_order": "ord"})


@query(
    "p02_range_filter",
    "SELECT tr_line, it_order, itin_b FROM fx_itin WHERE itin_b BETWEEN 30010 AND 30050 AND layover IN ('4') AND dw_code NOT IN ('1')",
)
def range_filter(t):
    keep = F.col("itin_b").between(30010, 30050) & F.col("layover").isin("4") & ~F.col("dw_code").isin("1")
    return t["fx_itin"].filter(keep).select("tr_line", "it_order", "itin_b")


@query(
    "p03_contains",
    "SELECT id, scenario, tod FROM fx_future WHERE contains(scenario, '3') AND contains(tod, '1')",
)
def contains(t):
    return t["fx_future"].filter(C.has_code("scenario", "3") & C.has_code("tod", "1")).select("id", "scenario", "tod")


@query(
    "p04_time_of_day",
    """SELECT tr_line, CAST(CASE WHEN strthour IS NULL OR strthour >= 18 OR strthour < 6 THEN 1 WHEN strthour < 9 THEN 2
         WHEN strthour < 16 THEN 3 ELSE 4 END AS INT) AS tod FROM fx_run""",
)
def tod(t):
    return t["fx_run"].select("tr_line", C.time_of_day("strthour").alias("tod"))


@query(
    "p05_period_table",
    """SELECT r.tr_line, p.tod FROM fx_run r JOIN (SELECT 1 AS tod, 20 AS lo, 6 AS hi UNION ALL SELECT 2, 6, 7
         UNION ALL SELECT 3, 7, 9 UNION ALL SELECT 4, 9, 10 UNION ALL SELECT 5, 10, 14 UNION ALL SELECT 6, 14, 16
         UNION ALL SELECT 7, 16, 18 UNION ALL SELECT 8, 18, 20) p
       ON CASE WHEN lo < hi THEN r.strthour >= lo AND r.strthour < hi
               ELSE r.strthour IS NULL OR r.strthour >= lo OR r.strthour < hi END""",
)
def period_table(t):
    return t["fx_run"].select("tr_line", C.time_of_day("strthour", P.EIGHT_PERIODS).alias("tod"))


@query(
    "p06_am_share",
    "SELECT line, it_order, tr_line FROM fx_feed_seg WHERE dep_time >= 25200 AND (arr_time IS NULL OR arr_time <= 32400)",
)
def am_share(t):
    return t["fx_feed_seg"].filter(P.in_am_peak()).select("line", "it_order", "tr_line")


@query(
    "p07_routing",
    """SELECT kind, count(*) AS n FROM (SELECT CASE WHEN itin_a = itin_b THEN 'same' WHEN mode = 'C' THEN 'cta'
         WHEN line LIKE 'metra%' THEN 'metra' ELSE 'shore' END AS kind FROM fx_feed_seg) q GROUP BY kind""",
)
def routing(t):
    rules = [
        ("same", F.col("itin_a") == F.col("itin_b")),
        ("cta", F.col("mode") == "C"),
        ("metra", F.col("line").startswith("metra")),
    ]
    return P.route_rows(t["fx_feed_seg"], rules, "shore").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p08_add_to_selection",
    "SELECT a, b FROM fx_link WHERE miles < 2 OR NOT (contains(modes1, 'C') OR contains(modes1, 'M'))",
)
def selection(t):
    return P.select_any(t["fx_link"], F.col("miles") < 2, ~(C.has_code("modes1", "C") | C.has_code("modes1", "M"))).select("a", "b")


@query(
    "p09_drop_stations",
    """SELECT tr_line, it_order, itin_a, itin_b FROM fx_itin
       WHERE itin_a NOT IN (SELECT node FROM fx_deleted) AND itin_b NOT IN (SELECT node FROM fx_deleted)""",
)
def drop_stations(t):
    from ..operators.itinerary import drop_stations as drop

    return drop(t["fx_itin"], t["fx_deleted"]).select("tr_line", "it_order", "itin_a", "itin_b")


@query(
    "p10_field_update",
    "SELECT a + 1 AS a, b, miles / 2 AS miles, trim(modes1) AS modes1 FROM fx_link",
)
def field_update(t):
    new = {"a": F.col("a") + 1, "miles": F.col("miles") / 2, "modes1": F.trim("modes1")}
    return t["fx_link"].withColumns(new).select("a", "b", "miles", "modes1")


@query(
    "p11_narrow_types",
    """SELECT node, CAST(pspace AS SMALLINT) AS pspace, CAST(pcost AS SMALLINT) AS pcost,
         CAST(label AS STRING) AS label FROM fx_node""",
)
def narrow(t):
    return P.narrow_nodes(t["fx_node"]).select("node", "pspace", "pcost", "label")


@query(
    "p12_constants",
    """SELECT line, 99 AS headway, CASE WHEN mode = 'C' THEN 7 ELSE 8 END AS veh_type, 0 AS imputed FROM fx_feed_run""",
)
def constants(t):
    return P.with_feed_constants(t["fx_feed_run"]).select("line", "headway", "veh_type", "imputed")
