"""Line summary queries."""

from pyspark.sql import functions as F

from ..functions.core import round_half_away, time_of_day
from ..operators import summary as S
from .registry import query, rnd

# Runs of the two summarised periods with a headway, and their itineraries with the dwell time.
_RUNS = """r AS (
  SELECT tr_line, mode, longname, CASE WHEN strthour >= 6 AND strthour < 9 THEN 2 ELSE 4 END AS tod,
         CAST(10 + o_orderkey % 21 AS DOUBLE) AS headway
  FROM fx_run WHERE (strthour >= 6 AND strthour < 9) OR (strthour >= 16 AND strthour < 18)),
w AS (SELECT *, CASE WHEN mode = 'C' THEN CASE tod WHEN 2 THEN 180.0 ELSE 120.0 END / headway ELSE 1.0 END AS w FROM r),
i AS (SELECT i.*, w.mode, w.longname, w.tod, w.w, CASE WHEN dw_code = '1' THEN 0.0 ELSE 0.01 END AS dw_time
      FROM fx_itin i JOIN w ON i.tr_line = w.tr_line)"""


def runs_of(t):
    tod = time_of_day("strthour")
    runs = t["fx_run"].select(
        "tr_line", "mode", "longname", tod.alias("tod"), (10 + F.col("o_orderkey") % 21).cast("double").alias("headway")
    )
    return runs.filter(F.col("tod").isin(2, 4))


def itin_of(t):
    heads = runs_of(t).select("tr_line", "mode", "longname", "tod")
    dw = F.when(F.col("dw_code") == "1", 0.0).otherwise(0.01)
    return t["fx_itin"].join(heads, "tr_line").withColumn("dw_time", dw)


def _rounded(df):
    nums = [c for c in S.MEASURES if c in df.columns and c != "stations"]
    return df.withColumns({c: round_half_away(c, 6) for c in nums})


BY = ("tod", "mode", "longname")
_LN = "tod, mode, longname"
_RUNSUM = f"SELECT {_LN}, sum(w) AS runs FROM w GROUP BY {_LN}"
_DIR = f"""SELECT {_LN}, sum(miles) AS dir_lnk_mi FROM (SELECT DISTINCT {_LN}, itin_a, itin_b FROM i) d
  LEFT JOIN fx_link l ON d.itin_a = l.a AND d.itin_b = l.b GROUP BY {_LN}"""
_MI = f"""SELECT {_LN}, sum(w * miles) AS srvc_mi FROM i LEFT JOIN fx_link l ON i.itin_a = l.a AND i.itin_b = l.b
  GROUP BY {_LN}"""
_HRS = f"SELECT {_LN}, sum(w * trv_time) / 60 AS srvc_hrs FROM i GROUP BY {_LN}"
_STA = f"SELECT {_LN}, count(DISTINCT itin_b) AS stations FROM i WHERE dw_time > 0 GROUP BY {_LN}"
_AVG = f"""SELECT s.tod, s.mode, s.longname, s.stops / CASE WHEN s.mode = 'C' THEN s.wr ELSE a.runs END AS avg_stops
  FROM (SELECT {_LN}, sum(n * w) AS stops, sum(w) AS wr
        FROM (SELECT tr_line, {_LN}, w, count(*) AS n FROM i WHERE dw_time > 0 GROUP BY tr_line, {_LN}, w) p
        GROUP BY {_LN}) s
  JOIN ({_RUNSUM}) a USING (tod, mode, longname)"""


def _one(inner: str, col: str) -> str:
    val = col if col == "stations" else f"{rnd(col, 6)} AS {col}"
    return f"WITH {_RUNS} SELECT {_LN}, {val} FROM ({inner}) q"


@query("d35_line_runs", _one(_RUNSUM, "runs"))
def line_runs(t):
    return _rounded(S.runs_per_line(runs_of(t), BY))


@query("d36_directional_miles", _one(_DIR, "dir_lnk_mi"))
def directional(t):
    return _rounded(S.directional_miles(itin_of(t), t["fx_link"], BY))


@query("d37_service_miles", _one(_MI, "srvc_mi"))
def service_miles(t):
    return _rounded(S.service_miles(itin_of(t), t["fx_link"], runs_of(t), BY))


@query("d38_service_hours", _one(_HRS, "srvc_hrs"))
def service_hours(t):
    return _rounded(S.service_hours(itin_of(t), runs_of(t), BY))


@query("d39_stations", _one(_STA, "stations"))
def stations(t):
    return S.stations(itin_of(t), BY)


@query("d40_average_stops", _one(_AVG, "avg_stops"))
def average_stops(t):
    return _rounded(S.average_stops(itin_of(t), runs_of(t), BY))


_ALL = f"""WITH {_RUNS},
m1 AS ({_RUNSUM}), m2 AS ({_DIR}), m3 AS ({_MI}), m4 AS ({_HRS}), m5 AS ({_STA}), m6 AS ({_AVG})
SELECT tod, mode, longname, {rnd("runs", 6)} AS runs, {rnd("dir_lnk_mi", 6)} AS dir_lnk_mi, {rnd("srvc_mi", 6)} AS srvc_mi,
  {rnd("srvc_hrs", 6)} AS srvc_hrs, stations, {rnd("avg_stops", 6)} AS avg_stops
FROM m1 FULL JOIN m2 USING (tod, mode, longname) FULL JOIN m3 USING (tod, mode, longname)
FULL JOIN m4 USING (tod, mode, longname) FULL JOIN m5 USING (tod, mode, longname) FULL JOIN m6 USING (tod, mode, longname)"""


@query("d41_line_summary", _ALL)
def line_summary(t):
    return _rounded(S.line_summary(itin_of(t), t["fx_link"], runs_of(t), BY))


@query("j08_summary_outer_merge", _ALL)
def summary_merge(t):
    """The same table by chained full outer joins on the line key."""
    itin, links, runs = itin_of(t), t["fx_link"], runs_of(t)
    out = S.runs_per_line(runs, BY)
    for part in (
        S.directional_miles(itin, links, BY), S.service_miles(itin, links, runs, BY), S.service_hours(itin, runs, BY),
        S.stations(itin, BY), S.average_stops(itin, runs, BY),
    ):
        out = out.join(part, list(BY), "full_outer")
    return _rounded(out)
