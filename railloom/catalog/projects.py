"""Future project actions."""

from pyspark.sql import functions as F

from ..functions import core as C
from ..operators import actions as A
from ..operators.stores import stored
from .fixtures import _PREFIX as RUN_PREFIX
from .registry import query, rnd

_COLS = "tr_line, it_order, itin_a, itin_b, dw_code, layover, trv_time, dep_time"


def _base(t):
    return t["fx_itin"].select("tr_line", "it_order", "itin_a", "itin_b", "dw_code", "layover", "trv_time", "dep_time")


def shift_sql(src: str, out: str) -> str:
    return f"""{out} AS MATERIALIZED (SELECT i.tr_line, i.it_order, CAST(CASE WHEN s.nd = 1 THEN s.new ELSE i.itin_a END AS INT) AS itin_a,
   CAST(CASE WHEN s.nd = 2 THEN s.new ELSE i.itin_b END AS INT) AS itin_b, i.dw_code, i.layover, i.trv_time, i.dep_time
   FROM {src} i LEFT JOIN fx_shift s ON s.ln = substr(i.tr_line, 1, 3) AND s.itin_a = i.itin_a AND s.itin_b = i.itin_b)"""


def cut_sql(src: str, out: str) -> str:
    return f"""{out}_r AS (SELECT i.*, coalesce(c.reduc, CASE WHEN substr(i.tr_line, 1, 3) IN ('cbl', 'mbn') THEN 0.1::DOUBLE END) AS rate
   FROM {src} i LEFT JOIN fx_cut c ON c.ln = substr(i.tr_line, 1, 3) AND c.itin_a = i.itin_a AND c.itin_b = i.itin_b),
  {out} AS MATERIALIZED (SELECT tr_line, it_order, itin_a, itin_b, dw_code, layover, CASE WHEN rate > 0 THEN CASE WHEN trv_time IS NULL OR trv_time < 0.6
     THEN {rnd("(1 - rate) * trv_time", 2)} ELSE {rnd("(1 - rate) * trv_time", 1)} END ELSE trv_time END AS trv_time, dep_time FROM {out}_r)"""


def station_sql(src: str, out: str, tod: str = "2") -> str:
    share = f"CASE dw_share WHEN '0.5' THEN 0.5 WHEN '23:0' THEN {0.0 if tod in '23' else 'NULL'} ELSE {dict(zip('1234', (0.25, 0.4, 0.4, 1)))[tod]} END"
    return f"""{out}_m AS (SELECT i.*, s.new, s.dw_code AS dw_share, substr(i.tr_line, 1, 3) AS ln FROM {src} i
     LEFT JOIN fx_station s ON s.ln = substr(i.tr_line, 1, 3) AND s.itin_a = i.itin_a AND s.itin_b = i.itin_b),
   {out}_k AS (SELECT *, {share} AS rate, row_number() OVER (PARTITION BY ln, itin_a, itin_b, new ORDER BY dep_time, tr_line, it_order) AS k,
     count(*) OVER (PARTITION BY ln, itin_a, itin_b, new) AS freq FROM {out}_m WHERE new > 0),
   {out}_s AS (SELECT *, floor(freq * rate + 0.5 + 1e-9) AS ns FROM {out}_k),
   {out}_e AS (SELECT *, CASE WHEN ns > 0 THEN floor(freq / ns + 0.5 + 1e-9) END AS ev FROM {out}_s),
   {out}_u AS (SELECT tr_line, it_order, 1 AS half, itin_a, itin_b, dw_code, layover, trv_time, dep_time FROM {out}_m WHERE new IS NULL
     UNION ALL SELECT tr_line, it_order, 1, itin_a, new, CASE WHEN ns > 0 AND k % CAST(ev AS BIGINT) = 0 AND k <= ev * ns THEN '0' ELSE '1' END, '0',
       {rnd("trv_time / 2 + 0.5", 1)}, dep_time FROM {out}_e
     UNION ALL SELECT tr_line, it_order, 2, new, itin_b, dw_code, layover, {rnd("trv_time / 2 + 0.5", 1)}, dep_time FROM {out}_e),
   {out} AS MATERIALIZED (SELECT tr_line, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY it_order, half) AS INT) AS it_order, CAST(itin_a AS INT) AS itin_a,
     CAST(itin_b AS INT) AS itin_b, dw_code, layover, trv_time, dep_time FROM {out}_u)"""


def span_sql(src: str, out: str) -> str:
    return f"""{out}_sk AS (SELECT DISTINCT i.tr_line FROM {src} i WHERE itin_a IN (SELECT new FROM fx_span) OR itin_b IN (SELECT new FROM fx_span)),
   {out}_h AS (SELECT i.tr_line, i.it_order AS p0, s.end_node, s.new, row_number() OVER (PARTITION BY i.tr_line ORDER BY i.it_order) AS r
     FROM {src} i JOIN fx_span s ON s.ln = substr(i.tr_line, 1, 3) AND s.start_node = i.itin_a WHERE i.tr_line NOT IN (SELECT tr_line FROM {out}_sk)),
   {out}_p AS (SELECT h.tr_line, h.p0, h.new, min(i.it_order) AS p1 FROM {out}_h h JOIN {src} i ON i.tr_line = h.tr_line AND i.it_order >= h.p0 AND i.itin_b = h.end_node
     WHERE h.r = 1 GROUP BY h.tr_line, h.p0, h.new),
   {out}_t AS (SELECT p.tr_line, p.p0, p.p1, p.new, sum(i.trv_time) AS total FROM {out}_p p JOIN {src} i ON i.tr_line = p.tr_line AND i.it_order BETWEEN p.p0 AND p.p1
     GROUP BY p.tr_line, p.p0, p.p1, p.new),
   {out}_j AS (SELECT i.*, t.p0, t.p1, t.new, t.total FROM {src} i LEFT JOIN {out}_t t ON t.tr_line = i.tr_line),
   {out}_u AS (SELECT tr_line, it_order, 1 AS half, itin_a, itin_b, dw_code, layover, trv_time, dep_time FROM {out}_j WHERE p0 IS NULL OR it_order < p0 OR it_order > p1
     UNION ALL SELECT tr_line, it_order, 1, itin_a, new, dw_code, layover, {rnd("total / 2 - 0.5", 1)}, dep_time FROM {out}_j WHERE it_order = p0
     UNION ALL SELECT tr_line, it_order, 2, new, itin_b, dw_code, layover, {rnd("total / 2 - 0.5", 1)}, dep_time FROM {out}_j WHERE it_order = p1),
   {out} AS MATERIALIZED (SELECT tr_line, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY it_order, half) AS INT) AS it_order, CAST(itin_a AS INT) AS itin_a,
     CAST(itin_b AS INT) AS itin_b, dw_code, layover, trv_time, dep_time FROM {out}_u)"""


def extend_sql(src: str, out: str) -> str:
    return f"""{out}_e AS (SELECT tr_line, substr(tr_line, 1, 3) AS ln, arg_min(itin_a, it_order) AS fa, arg_max(itin_b, it_order) AS lb FROM {src} GROUP BY tr_line),
   {out}_f AS (SELECT ln, arg_max(itin_b, it_order) AS node FROM fx_extension WHERE it_order < 0 GROUP BY ln),
   {out}_b AS (SELECT ln, arg_min(itin_a, it_order) AS node FROM fx_extension WHERE it_order > 1000 GROUP BY ln),
   {out}_hd AS (SELECT e.tr_line, e.ln FROM {out}_e e JOIN {out}_f f ON f.ln = e.ln AND f.node = e.fa),
   {out}_tl AS (SELECT e.tr_line, e.ln FROM {out}_e e JOIN {out}_b b ON b.ln = e.ln AND b.node = e.lb),
   {out}_u AS (SELECT i.tr_line, 1 AS part, i.it_order, itin_a, itin_b, dw_code, CASE WHEN t.tr_line IS NOT NULL AND TRY_CAST(layover AS DOUBLE) > 0 THEN '0' ELSE layover END AS layover,
       trv_time, dep_time FROM {src} i LEFT JOIN {out}_tl t ON t.tr_line = i.tr_line
     UNION ALL SELECT h.tr_line, 0, x.it_order, x.itin_a, x.itin_b, x.dw_code, x.layover, x.trv_time, NULL FROM {out}_hd h JOIN fx_extension x ON x.ln = h.ln AND x.it_order < 0
     UNION ALL SELECT h.tr_line, 2, x.it_order, x.itin_a, x.itin_b, x.dw_code, x.layover, x.trv_time, NULL FROM {out}_tl h JOIN fx_extension x ON x.ln = h.ln AND x.it_order > 1000),
   {out} AS MATERIALIZED (SELECT tr_line, CAST(row_number() OVER (PARTITION BY tr_line ORDER BY part, it_order) AS INT) AS it_order, itin_a, itin_b, dw_code, layover,
     trv_time, dep_time FROM {out}_u)"""


def _sel(src: str) -> str:
    return f"SELECT tr_line, it_order, itin_a, itin_b, dw_code, layover, {rnd('trv_time', 6)} AS trv_time, dep_time FROM {src}"


def _out(df):
    return df.withColumn("trv_time", C.round_half_away("trv_time", 6))


@query("d23_terminus_shift", f"WITH {shift_sql('fx_itin', 'x')} {_sel('x')}")
def terminus_shift(t):
    return _out(A.shift_terminus(_base(t), t["fx_shift"]))


def whole_lines(t):
    return t["fx_pair"].filter(F.col("ln").isin("cbl", "mbn")).select("ln").distinct()


def cut_rows(t):
    rates = t["fx_cut"].groupBy(
        F.concat("ln", F.when(F.col("itin_a") % 2 == 0, "901").otherwise("902")).alias("tr_line")
    ).agg(F.max("reduc").alias("reduc"))
    return A.cut_pairs(t["fx_cut_vertex"], t["fx_node"], rates, t.layout)


@query("d24_time_cut", f"WITH {cut_sql('fx_itin', 'x')} {_sel('x')}")
def time_cut(t):
    return _out(A.cut_times(_base(t), cut_rows(t), whole_lines(t)))


@query("d25_new_station", f"WITH {station_sql('fx_itin', 'x')} {_sel('x')}")
def new_station(t):
    return _out(A.add_stations(_base(t), t["fx_station"], "2", (), t.layout))


@query(
    "w10_stop_allocation",
    f"WITH {station_sql('fx_itin', 'x', '4')} SELECT tr_line, it_order, ln, itin_a, itin_b, new, CASE WHEN ns > 0 THEN k % CAST(ev AS BIGINT) = 0 AND k <= ev * ns ELSE false END AS stops FROM x_e",
)
def stop_allocation(t):
    on = ["ln", "itin_a", "itin_b"]
    rows = _base(t).withColumn("ln", C.line_group("tr_line")).join(t["fx_station"].withColumnRenamed("dw_code", "share"), on)
    rows = rows.withColumn("rate", A.stop_share("share", "4"))
    out = A.allocate_stops(rows, [*on, "new"], ["dep_time", "tr_line", "it_order"])
    return out.select("tr_line", "it_order", *on, "new", "stops")


@query("d26_consolidated_station", f"WITH {span_sql('fx_itin', 'x')} {_sel('x')}")
def consolidated(t):
    return _out(A.consolidate_stations(_base(t), t["fx_span"], (), t.layout))


@query("w11_span_marking", f"WITH {span_sql('fx_itin', 'x')} SELECT tr_line, new, p0, p1, {rnd('total', 6)} AS total FROM x_t")
def span_marking(t):
    marks = A.mark_spans(_base(t), t["fx_span"], (), t.layout).filter(F.col("new").isNotNull())
    return marks.groupBy("tr_line").agg(
        F.max("new").alias("new"), F.min("it_order").alias("p0"), F.max("it_order").alias("p1"),
        C.round_half_away(F.max("total"), 6).alias("total"),
    )


@query("d27_line_extension", f"WITH {extend_sql('fx_itin', 'x')} {_sel('x')}")
def line_extension(t):
    return _out(A.extend_lines(_base(t), t["fx_extension"], (), t.layout))


_CHAIN = ", ".join([shift_sql("fx_itin", "x5"), cut_sql("x5", "x2"), station_sql("x2", "x3"), span_sql("x3", "x7"), extend_sql("x7", "x4")])


@query("d28_all_actions", f"WITH {_CHAIN} {_sel('x4')}")
def all_actions(t):
    t.keep("fx_itin", "fx_pair", "fx_span")  # every action and its coded rows are read from them
    cuts = stored(cut_rows(t), "cuts")
    return _out(
        A.apply_actions(
            _base(t), shifts=t["fx_shift"], cuts=cuts, whole_lines=whole_lines(t), stations=t["fx_station"],
            spans=t["fx_span"], extensions=t["fx_extension"], tod="2", layout=t.layout,
        )
    )


_CODED_LINE = RUN_PREFIX.format(k="id") + " || '901'"


@query(
    "d28_revised_descriptions",
    f"""WITH f AS (SELECT substr(tr_line, 1, 3) AS ln, arg_min(action, CASE action WHEN 5 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 7 THEN 4 ELSE 5 END) AS act
        FROM (SELECT {_CODED_LINE} AS tr_line, action FROM fx_future WHERE contains(scenario, '3')) q WHERE action IN (5, 2, 3, 7, 4) GROUP BY 1),
      d AS (SELECT r.tr_line, CAST(o_orderkey AS STRING) || ' RR -' || longname AS d, f.act FROM fx_run r LEFT JOIN f ON f.ln = substr(r.tr_line, 1, 3))
      SELECT tr_line, CASE WHEN act > 0 AND CAST(substr(tr_line, 4, 3) AS INT) < 900 THEN substr(d, 1, instr(d, ' -') + 1) || 's3a' || CAST(act AS STRING) ||
        substr(d, CAST(instr(d, ' -') + 2 AS BIGINT), greatest(CAST(15 - instr(d, ' -') AS BIGINT), 0)) ELSE d END AS description FROM d""",
)
def revised(t):
    """All coded projects of the scenario, each under the line group of its number."""
    coded = t["fx_future"].filter(F.contains("scenario", F.lit("3"))).select(F.expr(_CODED_LINE).alias("tr_line"), "action")
    descr = F.concat(F.col("o_orderkey").cast("string"), F.lit(" RR -"), F.col("longname"))
    return A.revise_descriptions(t["fx_run"].select("tr_line", descr.alias("description")), coded, 3)
