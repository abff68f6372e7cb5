"""The rail tables as views over the star-schema test tables.

Each view is plain SQL that Spark and DuckDB read alike, so a query and its check start from the same
rows. `Tables` gives the views as DataFrames; `with_views` puts the same text in front of a check query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import round_half_away
from ..operators.itinerary import measure
from ..operators.sequence import RUNS, RunLayout, scan
from ..operators.stores import stored

# Columns the views read; declared, never inferred.
BASE = {
    "nation": "n_nationkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_returnflag STRING",
    "events": "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}

_PREFIX = """CASE {k} % 8 WHEN 0 THEN 'cbl' WHEN 1 THEN 'cbr' WHEN 2 THEN 'cga' WHEN 3 THEN 'cor'
 WHEN 4 THEN 'mbn' WHEN 5 THEN 'mme' WHEN 6 THEN 'mun' ELSE 'mss' END"""
_LINE = _PREFIX + " || lpad(CAST({k} AS STRING), 7, '0')"


def _line(k: str) -> str:
    return _LINE.format(k=k)


VIEWS: dict[str, str] = {
    "fx_run": f"""
SELECT o_orderkey, {_line("o_orderkey")} AS tr_line,
       CASE WHEN o_orderkey % 8 < 4 THEN 'C' ELSE 'M' END AS mode,
       o_orderpriority AS longname,
       CAST(o_custkey % 6 AS STRING) AS route_id,
       CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE CAST((o_orderkey * 7919) % 90000 AS INT) END AS start_sec,
       CASE WHEN o_orderkey % 50 = 7 THEN NULL
            ELSE CAST(floor(((o_orderkey * 7919) % 90000) / 3600.0) AS INT) END AS strthour,
       CASE WHEN o_orderkey % 8 < 4 THEN 0 ELSE 99 END AS headway
FROM orders""",
    "fx_itin": f"""
SELECT * FROM (
  SELECT {_line("l_orderkey")} AS tr_line,
         CAST(row_number() OVER w AS INT) AS it_order,
         CAST(30001 + l_suppkey AS INT) AS itin_a,
         CAST(30001 + lead(l_suppkey) OVER w AS INT) AS itin_b,
         CASE WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS dw_code,
         CASE WHEN l_partkey % 11 = 0 THEN '4' ELSE '0' END AS layover,
         CAST(l_quantity AS DOUBLE) / 10 AS trv_time,
         CAST((l_orderkey * 7919) % 90000 AS INT) AS dep_time
  FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)
) t WHERE itin_b IS NOT NULL""",
    "fx_link": """
SELECT itin_a AS a, itin_b AS b, CAST(1 + (itin_a * 31 + itin_b * 17) % 97 AS DOUBLE) / 10 AS miles,
       1 + (itin_a + itin_b) % 2 AS directions,
       CASE WHEN (itin_a + itin_b) % 20 = 0 THEN 'T' ELSE 'C' END AS modes1, 'C' AS modes2
FROM (SELECT DISTINCT itin_a, itin_b FROM fx_itin WHERE itin_a <> itin_b) t
WHERE (itin_a * 31 + itin_b * 17) % 10 <> 0""",
    "fx_net": """
SELECT a, b, CAST(1 + (a * 31 + b * 17) % 97 AS DOUBLE) / 10 AS miles FROM (
  SELECT DISTINCT CAST(30001 + s.s_suppkey AS INT) AS a,
         CAST(30001 + ((s.s_suppkey * k.m + k.c) % n.n) AS INT) AS b
  FROM supplier s CROSS JOIN (SELECT count(*) AS n FROM supplier) n
  CROSS JOIN (SELECT 1 AS m, 1 AS c UNION ALL SELECT 3, 1 UNION ALL SELECT 7, 2) k) t
WHERE a <> b""",
    "fx_node": """
SELECT CAST(30001 + s_suppkey AS INT) AS node, CAST((s_suppkey * 37) % 1009 AS DOUBLE) * 528 AS point_x,
       CAST((s_suppkey * 53) % 1013 AS DOUBLE) * 528 AS point_y, s_nationkey AS pspace, s_nationkey AS pcost,
       CASE WHEN s_nationkey % 3 = 0 THEN ''
            ELSE '2:' || CAST(s_nationkey * 10 AS STRING) || ':5:' || CAST(s_nationkey * 20 AS STRING) END
         AS ftr_pspace,
       '' AS ftr_pcost, s_name AS label
FROM supplier""",
    "fx_future": """
SELECT CAST(c_custkey AS INT) AS id, 'r' || lpad(CAST(c_custkey AS STRING), 6, '0') AS tr_line,
       CASE c_custkey % 4 WHEN 0 THEN '234567' WHEN 1 THEN '4567' WHEN 2 THEN '67' ELSE '' END AS scenario,
       CAST(1 + c_custkey % 7 AS INT) AS action, CASE WHEN c_custkey % 2 = 0 THEN '1234' ELSE '23' END AS tod,
       CASE WHEN c_custkey % 3 = 0 THEN '15' ELSE '1:30:23:12:4:' || CAST(5 + c_nationkey AS STRING) END AS headway,
       CASE WHEN c_custkey % 41 = 0 THEN 'CM' WHEN c_custkey % 2 = 0 THEN 'C' ELSE 'M' END AS mode,
       c_mktsegment AS longname, c_name AS descr
FROM customer""",
    "fx_sig": """
SELECT DISTINCT CAST(user_id % 5 AS INT) AS route_key, user_id AS tr_line,
       event_type || '-' || CAST(CAST(floor(extract(hour FROM ts) / 3.0) AS INT) AS STRING) AS seg
FROM events""",
    # Two end vertices and a bent midpoint per link, ordered 1..3.
    "fx_vertex": """
SELECT l.a, l.b, l.miles, l.directions, l.modes1, l.modes2, p.ord,
       CASE p.ord WHEN 1 THEN n1.point_x WHEN 3 THEN n2.point_x ELSE (n1.point_x + n2.point_x) / 2 + 1056 END AS x,
       CASE p.ord WHEN 1 THEN n1.point_y WHEN 3 THEN n2.point_y ELSE (n1.point_y + n2.point_y) / 2 + 528 END AS y
FROM fx_link l JOIN fx_node n1 ON l.a = n1.node JOIN fx_node n2 ON l.b = n2.node
CROSS JOIN (SELECT 1 AS ord UNION ALL SELECT 2 UNION ALL SELECT 3) p""",
    # Feed run header.
    "fx_feed_run": """
SELECT CASE o_orderkey % 3
         WHEN 0 THEN 'metra_R' || CAST(o_orderkey AS STRING) || 'X_' ||
              CASE o_orderkey % 5 WHEN 0 THEN 'UP-NW_1' WHEN 1 THEN 'UP-N_1' WHEN 2 THEN 'BNSF_2'
                                  WHEN 3 THEN 'ME_1' ELSE 'MD-W_1' END
         WHEN 1 THEN 'cta' || CAST(o_orderkey AS STRING)
         ELSE 'shoreSS' || CAST(o_orderkey AS STRING) END AS line,
       o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'C' ELSE 'M' END AS mode,
       CASE WHEN o_orderkey % 3 <> 1 THEN 'train ' || CAST(o_orderkey AS STRING) || ' - METRA ' || o_orderpriority
            WHEN o_orderkey % 2 = 0 THEN 'Ashland to loop' ELSE 'Cottage to loop' END AS description,
       CASE o_orderkey % 4 WHEN 0 THEN 'Green' WHEN 1 THEN 'Blue' WHEN 2 THEN 'Red' ELSE 'Yellow' END AS route_id,
       'long name of ' || o_orderpriority AS route_long_name, 'inbound' AS direction, 'loop' AS terminal,
       o_totalprice / 10000 AS speed
FROM orders""",
    # Feed segments: same stops as the itinerary, a clock of 300 s per stop, fare zones from the node.
    "fx_feed_seg": """
SELECT r.line, r.mode, i.tr_line, i.it_order, i.itin_a, i.itin_b,
       CASE WHEN i.it_order = 1 AND i.itin_a % 7 = 0 THEN 0 ELSE i.dep_time + (i.it_order - 1) * 300 END AS dep_time,
       CASE WHEN i.it_order = 1 AND i.itin_a % 49 = 0 THEN 0
            ELSE i.dep_time + i.it_order * 300 - 30 END AS arr_time,
       i.trv_time AS ltime, CAST(i.dw_code AS INT) AS dw_code,
       CASE WHEN r.line LIKE 'metra%' THEN substr('ABCDEFGHIJKMX', CAST(1 + i.itin_a % 13 AS INT), 1)
            ELSE CAST(1 + i.itin_a % 11 AS STRING) END AS zone_id_a,
       CASE WHEN r.line LIKE 'metra%' THEN substr('ABCDEFGHIJKMX', CAST(1 + i.itin_b % 13 AS INT), 1)
            ELSE CAST(1 + i.itin_b % 11 AS STRING) END AS zone_id_b
FROM fx_itin i JOIN fx_feed_run r ON CAST(substr(i.tr_line, 4, 7) AS BIGINT) = r.o_orderkey""",
    # Coding sheets: one header per order, every itinerary row; upper-case names, some half orders.
    "fx_fhead": """
SELECT upper(tr_line) AS tr_line, CASE WHEN o_orderkey % 29 = 0 THEN 'CM' ELSE mode END AS mode,
       CAST(1 + o_orderkey % 7 AS INT) AS action, CASE o_orderkey % 4 WHEN 0 THEN '234567' WHEN 1 THEN '4567'
         WHEN 2 THEN '67' ELSE '' END AS scenario, '1234' AS tod, 'o''hare ' || longname || ' line' AS description,
       'notes on ' || longname || ' and more text' AS notes, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 30 END AS speed
FROM fx_run""",
    "fx_fitin": """
SELECT upper(tr_line) AS tr_line, CASE WHEN (itin_a + itin_b) % 31 = 0 THEN CAST(it_order AS DOUBLE) + 0.5e0 ELSE CAST(it_order AS DOUBLE) END AS ord,
       itin_a, itin_b, CASE WHEN itin_b % 3 = 0 THEN CAST(39000 + itin_b % 100 AS INT) END AS layover, dw_code,
       CASE WHEN itin_a % 6 = 0 THEN NULL ELSE trv_time / 3 END AS trv_time, CAST(NULL AS DOUBLE) AS zn_fare
FROM fx_itin""",
    # Future itinerary rows keyed by line group and link, one block per action.
    "fx_pair": """
SELECT DISTINCT substr(tr_line, 1, 3) AS ln, itin_a, itin_b FROM fx_itin WHERE itin_a <> itin_b""",
    "fx_shift": """
SELECT ln, itin_a, itin_b, itin_a + 5000 AS new, 1 + (itin_a + itin_b) % 2 AS nd
FROM fx_pair WHERE (itin_a * 7 + itin_b) % 13 = 0""",
    "fx_cut": """
SELECT ln, itin_a, itin_b, CASE WHEN itin_a % 2 = 0 THEN 0.2e0 ELSE 0.35e0 END AS reduc
FROM fx_pair WHERE (itin_a + itin_b) % 9 = 0""",
    "fx_station": """
SELECT ln, itin_a, itin_b, itin_a + 6000 AS new,
       CASE itin_a % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1:0.25:23:0.4:4:1' ELSE '23:0' END AS dw_code
FROM fx_pair WHERE (itin_a * 3 + itin_b) % 17 = 0""",
    # Drawn features of the travel-time projects: three vertices per pair.
    "fx_cut_vertex": """
SELECT c.ln || CASE WHEN c.itin_a % 2 = 0 THEN '901' ELSE '902' END AS tr_line, CAST(c.itin_a AS BIGINT) * 100000 + c.itin_b AS link, p.seq,
       CASE p.seq WHEN 1 THEN n1.point_x WHEN 3 THEN n2.point_x ELSE (n1.point_x + n2.point_x) / 2 + 7 END AS x,
       CASE p.seq WHEN 1 THEN n1.point_y WHEN 3 THEN n2.point_y ELSE (n1.point_y + n2.point_y) / 2 + 7 END AS y
FROM fx_cut c JOIN fx_node n1 ON c.itin_a = n1.node JOIN fx_node n2 ON c.itin_b = n2.node
CROSS JOIN (SELECT 1 AS seq UNION ALL SELECT 2 UNION ALL SELECT 3) p""",
    # Consolidation spans: one end per line group and start node.
    "fx_span": """
SELECT substr(x.tr_line, 1, 3) AS ln, x.itin_a AS start_node, min(y.itin_b) AS end_node,
       x.itin_a + 7000 AS new
FROM fx_itin x JOIN fx_itin y ON x.tr_line = y.tr_line AND y.it_order = x.it_order + 1
WHERE x.itin_a % 4 = 0 AND y.itin_b <> x.itin_a GROUP BY substr(x.tr_line, 1, 3), x.itin_a""",
    # Line extensions: for each line group the lowest used node gets two segments in front and behind.
    "fx_extension": """
SELECT p.ln, k.it_order, CAST(CASE k.it_order WHEN -2 THEN 48101 WHEN -1 THEN 48102
         WHEN 1001 THEN p.node ELSE 48103 END AS INT) AS itin_a,
       CAST(CASE k.it_order WHEN -2 THEN 48102 WHEN -1 THEN p.node
         WHEN 1001 THEN 48103 ELSE 48104 END AS INT) AS itin_b,
       '0' AS layover, '0' AS dw_code, 2.5e0 AS trv_time, 'p1' AS project
FROM (SELECT ln, min(itin_a) AS node FROM fx_pair GROUP BY ln) p
CROSS JOIN (SELECT -2 AS it_order UNION ALL SELECT -1 UNION ALL SELECT 1001 UNION ALL SELECT 1002) k""",
    # Pieces of split links: two or three per link, temporary node numbers in between.
    "fx_piece": """
SELECT l.a, l.b, k.o, k.n,
       CAST(CASE WHEN k.o = 1 THEN l.a ELSE 90000 + (l.a * 100 + l.b) % 5000 * 2 + k.o - 1 END AS INT) AS tempa,
       CAST(CASE WHEN k.o = k.n THEN l.b ELSE 90000 + (l.a * 100 + l.b) % 5000 * 2 + k.o END AS INT) AS tempb,
       CASE WHEN k.o < k.n THEN floor(l.miles / k.n * 100 + 0.5) / 100
            ELSE floor((l.miles - (k.n - 1) * floor(l.miles / k.n * 100 + 0.5) / 100) * 100 + 0.5) / 100 END AS newmile
FROM fx_link l JOIN (SELECT 2 AS n, 1 AS o UNION ALL SELECT 2, 2 UNION ALL SELECT 3, 1
                     UNION ALL SELECT 3, 2 UNION ALL SELECT 3, 3) k
  ON k.n = CASE WHEN (l.a + l.b) % 3 = 0 THEN 3 ELSE 2 END
WHERE (l.a * 13 + l.b) % 5 = 0 AND l.a < l.b""",
    # Link ends after the edit: split links are drawn in pieces, all others in one.
    "fx_link_end": """
SELECT q.a, q.b, CAST(q.a AS BIGINT) * 10000000 + q.b * 10 + q.o AS orig_fid, q.miles, (q.o + 1) * 100.0e0 AS shape_leng,
       CASE WHEN k.e = 0 THEN 'start' ELSE 'end' END AS which,
       n1.point_x + (n2.point_x - n1.point_x) * (q.o - 1 + k.e) / q.n AS point_x,
       n1.point_y + (n2.point_y - n1.point_y) * (q.o - 1 + k.e) / q.n AS point_y
FROM (SELECT l.a, l.b, l.miles, coalesce(p.o, 1) AS o, coalesce(p.n, 1) AS n
      FROM fx_link l LEFT JOIN fx_piece p ON l.a = p.a AND l.b = p.b) q
JOIN fx_node n1 ON q.a = n1.node JOIN fx_node n2 ON q.b = n2.node
CROSS JOIN (SELECT 0 AS e UNION ALL SELECT 1) k""",
    # Itinerary with measures, fares and a clock of 600 s per segment.
    "fx_mitin": """
SELECT i.tr_line, i.it_order, i.itin_a, i.itin_b, i.dw_code, i.layover, i.trv_time,
       CAST(i.dep_time + (i.it_order - 1) * 600 AS INT) AS dep_time, CAST(i.dep_time + i.it_order * 600 - 120 AS INT) AS arr_time,
       CAST(i.itin_a % 5 AS DOUBLE) AS zn_fare,
       floor((sum(coalesce(l.miles, 0)) OVER w - coalesce(l.miles, 0)) * 100 + 0.5 + 1e-9) / 100 AS f_meas,
       floor(sum(coalesce(l.miles, 0)) OVER w * 100 + 0.5 + 1e-9) / 100 AS t_meas
FROM fx_itin i LEFT JOIN fx_link l ON i.itin_a = l.a AND i.itin_b = l.b
WINDOW w AS (PARTITION BY i.tr_line ORDER BY i.it_order)""",
    "fx_deleted": "SELECT node, label FROM fx_node WHERE node % 7 = 3",
    # People movers: a tenth of the links, open from a scenario on.
    "fx_mover": """
SELECT a AS anode, b AS bnode, CASE WHEN (a + b) % 3 = 0 THEN '34567' WHEN (a + b) % 3 = 1 THEN '1' ELSE '1234567' END
         AS scenario, 'mover' AS notes
FROM fx_link WHERE (a * 5 + b) % 10 = 0""",
    # Diamond-shaped zones on a grid of seven columns over part of the map; zone number = grid position.
    "fx_zone": """
SELECT CAST(n_nationkey * 2 + k.d + 1 AS INT) AS zone, ((n_nationkey * 2 + k.d) % 7) * 80000 + 40000.0 AS cx,
       floor((n_nationkey * 2 + k.d) / 7) * 80000 + 40000.0 AS cy, 44000.0 AS r
FROM nation CROSS JOIN (SELECT 0 AS d UNION ALL SELECT 1) k""",
}

# A row spread over a few constants: a cross join in the check, an explode in Spark.
_SPREAD = re.compile(r"CROSS JOIN \(SELECT (-?\d+) AS (\w+)((?:\s+UNION ALL SELECT -?\d+)+)\) (\w+)")


def _lateral(m: re.Match) -> str:
    values = [m[1], *re.findall(r"SELECT (-?\d+)", m[3])]
    return f"LATERAL VIEW explode(array({', '.join(values)})) {m[4]} AS {m[2]}"


def _sources(sql: str) -> list[str]:
    found = re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql)
    return [n for n in dict.fromkeys(found) if n in VIEWS or n in BASE]


def _needed(sql: str, seen: dict[str, None]) -> dict[str, None]:
    for name in re.findall(r"\bfx_\w+", sql):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            seen[name] = None
    return seen


def with_views(sql: str) -> str:
    """Prefix a check query with the views it reads."""
    views = _needed(sql, {})
    if not views:
        return sql
    head = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in views)
    sql = sql.strip()
    if sql[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {head},\n{sql[14:]}"
    if sql[:5].upper() == "WITH ":
        return f"WITH {head},\n{sql[5:]}"
    return f"WITH {head}\n{sql}"


class Tables:
    """The base tables and rail views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}
        self.layout: RunLayout = RUNS

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in BASE:
                self._frames[name] = self.spark.read.schema(BASE[name]).parquet(f"{self.sf_dir}/{name}.parquet")
            elif name == "fx_itin":
                self._frames[name] = self._itin()
            elif name == "fx_net":
                self._frames[name] = self._net()
            elif name == "fx_mitin":
                self._frames[name] = self._measured_itin()
            elif name == "link_shape":
                self._frames[name] = self._link_shape()
            elif name == "zone_ring":
                self._frames[name] = self._zone_ring()
            else:
                self._frames[name] = self._view(name)
        return self._frames[name]

    def keep(self, *names: str) -> None:
        """Write these views, each once, so that those built on them read them and do not work them out again."""
        for name in names:
            self._frames[name] = stored(self[name], name)

    def _view(self, name: str) -> DataFrame:
        text = _SPREAD.sub(_lateral, VIEWS[name])
        sources = _sources(text)
        for s in sources:
            text = re.sub(rf"\b(FROM|JOIN)\s+{s}\b", rf"\1 {{{s}}}", text)
        return self.spark.sql(text, **{s: self[s] for s in sources})

    def _itin(self) -> DataFrame:
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
        bucket = self.layout.bucket("l_linenumber")
        key = F.col("l_orderkey")
        lines = self["lineitem"].select(
            "l_orderkey", *order, "l_returnflag", "l_quantity"
        )
        numbered = scan(
            lines, ["l_orderkey"], order, bucket=bucket, number="it_order", lead={"next_supp": F.col("l_suppkey")}
        )
        return numbered.filter(F.col("next_supp").isNotNull()).select(
            F.expr(_line("l_orderkey")).alias("tr_line"),
            F.col("it_order").cast("int").alias("it_order"),
            (30001 + F.col("l_suppkey")).cast("int").alias("itin_a"),
            (30001 + F.col("next_supp")).cast("int").alias("itin_b"),
            F.when(F.col("l_returnflag") == "A", "1").otherwise("0").alias("dw_code"),
            F.when(F.col("l_partkey") % 11 == 0, "4").otherwise("0").alias("layover"),
            (F.col("l_quantity").cast("double") / 10).alias("trv_time"),
            ((key * 7919) % 90000).cast("int").alias("dep_time"),
        )

    def _net(self) -> DataFrame:
        """Three links out of every supplier, ends by multiples of its number."""
        n = self["supplier"].count()
        steps = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(c).alias("c")) for m, c in ((1, 1), (3, 1), (7, 2))])
        rows = self["supplier"].select("s_suppkey", F.explode(steps).alias("k"))
        a = (30001 + F.col("s_suppkey")).cast("int")
        b = (30001 + (F.col("s_suppkey") * F.col("k.m") + F.col("k.c")) % n).cast("int")
        links = rows.select(a.alias("a"), b.alias("b")).filter(F.col("a") != F.col("b")).distinct()
        return links.withColumn("miles", (1 + (F.col("a") * 31 + F.col("b") * 17) % 97).cast("double") / 10)

    def _measured_itin(self) -> DataFrame:
        lengths = self["fx_link"].select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b"), "miles")
        rows = self["fx_itin"].join(lengths, ["itin_a", "itin_b"], "left").na.fill(0.0, ["miles"])
        rows = measure(rows, self.layout)
        order = F.col("it_order")
        return rows.select(
            "tr_line", "it_order", "itin_a", "itin_b", "dw_code", "layover", "trv_time",
            (F.col("dep_time") + (order - 1) * 600).alias("dep_time"), (F.col("dep_time") + order * 600 - 120).alias("arr_time"),
            (F.col("itin_a") % 5).cast("double").alias("zn_fare"),
            round_half_away("f_meas", 2).alias("f_meas"), round_half_away("t_meas", 2).alias("t_meas"),
        )

    def _link_shape(self) -> DataFrame:
        """fx_link with its three vertices as an array."""
        ends = self["fx_node"].select("node", "point_x", "point_y")
        a = ends.toDF("a", "ax", "ay")
        b = ends.toDF("b", "bx", "by")

        def point(x, y):
            return F.struct(x.alias("x"), y.alias("y"))

        ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
        mid = point((ax + bx) / 2 + 1056, (ay + by) / 2 + 528)
        shape = F.array(point(ax, ay), mid, point(bx, by))
        joined = self["fx_link"].join(a, "a").join(b, "b")
        return joined.select("a", "b", "miles", "directions", "modes1", "modes2", shape.alias("vertices"))

    def _zone_ring(self) -> DataFrame:
        x, y, r = F.col("cx"), F.col("cy"), F.col("r")

        def point(px, py):
            return F.struct(px.alias("x"), py.alias("y"))

        ring = F.array(point(x - r, y), point(x, y + r), point(x + r, y), point(x, y - r))
        return self["fx_zone"].select("zone", ring.alias("ring"))
