"""The jobs from inputs to files, and the readers and writers around them."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from railloom.catalog.registry import tables
from railloom.operators import tables as T
from railloom.operators.links import two_way_vertices
from railloom.plans.edits import propagate_edits, propagate_future, renumber
from railloom.plans.imports import import_coding, import_feed
from railloom.plans.scenario import build_scenarios, coded_actions, scenario_report, write_scenarios
from railloom.sinks import writers
from railloom.sources import readers
from railloom.sources.dims import fare_zones

RANGES = {"C": (30000, 39999), "M": (30000, 49999)}


def extra():
    return F.lit("downtown -local").alias("description"), F.lit(7).alias("veh_type"), F.lit(55.5).alias("speed")


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return tables(spark, sf_dir)


def test_feed_import(spark, t):
    segs = t["fx_feed_seg"].drop("tr_line", "mode")
    links = t["link_shape"].select("a", "b", "miles", "directions", "modes1", "modes2")
    got = import_feed(t["fx_feed_run"], segs, links, fare_zones(spark), ranges=RANGES, strict=False)
    itin = got.itinerary
    first, last = F.min("it_order"), F.max("it_order")
    sizes = itin.groupBy("tr_line").agg(first.alias("lo"), last.alias("hi"), F.count("*").alias("n"))
    assert sizes.filter("lo <> 1 OR hi <> n").isEmpty()
    lost = itin.select("tr_line").distinct().join(got.routes, "tr_line", "left_anti")
    assert lost.isEmpty()
    assert itin.filter("imputed = 1").count() > 0
    # What is still off the network is reported.
    off = itin.join(links.select(F.col("a").alias("itin_a"), F.col("b").alias("itin_b")), ["itin_a", "itin_b"], "left_anti")
    assert off.isEmpty() == got.violations.filter("check = 'not_on_link'").isEmpty()


def test_coding_import(t):
    links = t["link_shape"].select("a", "b", "miles", "directions", "modes1", "modes2")
    old_routes = t["fx_run"].select("tr_line", "mode")
    old_itin = t["fx_itin"].select("tr_line", "itin_a", "itin_b", "it_order")
    got = import_coding(t["fx_fhead"], t["fx_fitin"], links, old_routes, old_itin, ranges=RANGES, strict=False)
    assert got.routes.groupBy("tr_line").count().filter("count > 1").isEmpty()
    assert {"no_scenario", "junction_stop"} & {r[0] for r in got.violations.select("check").distinct().collect()}
    assert got.itinerary.count() > 0


def test_edit_propagation(t):
    shapes = t["link_shape"].withColumns({"orig_fid": F.col("a") * 10000 + F.col("b") % 10000, "shape_leng": F.lit(1.0)})
    itin = t["fx_mitin"]
    out = propagate_edits(shapes, t["fx_node"], t["fx_run"], itin, strict=False)
    assert out.pieces.isEmpty()
    assert out.itinerary.count() <= itin.count()
    links, again = renumber(t["link_shape"], t["fx_node"], itin)
    assert rows(links.select("a", "b")) == rows(t["link_shape"].select("a", "b"))
    assert again.count() == itin.count()


def test_scenarios_to_files(spark, t, tmp_path):
    links = t["fx_link"]
    coded = t["fx_future"].select("tr_line", "mode", "longname", "headway", "scenario", "tod", "action", *extra())
    runs = t["fx_run"].select("tr_line", "mode", "longname", "headway", "strthour", "start_sec", "route_id", *extra())
    itin = t["fx_itin"].withColumn("zn_fare", F.lit(0.0))
    built = build_scenarios(
        runs, itin, links, t["fx_node"], coded, None, t["fx_mover"], (1, 3), t["zone_ring"],
        actions={
            "stations": t["fx_station"].withColumns({"scenario": F.lit(3), "tod": F.lit(2)}),
            "spans": t["fx_span"].withColumns({"scenario": F.lit(3), "tod": F.lit(4)}),
        },
        max_zone=100, strict=False,
    )
    assert built.violations.filter("check = 'duplicate_node'").isEmpty()
    write_scenarios(built, two_way_vertices(t["link_shape"]), str(tmp_path / "out"), "01JAN24")
    part = tmp_path / "out" / "lines" / "scenario=1" / "tod=2"
    text = "".join(f.read_text() for f in sorted(part.glob("part-*"))).splitlines()
    assert text[0] == "c RAIL TRANSIT BATCHIN FILE FOR SCENARIO 100 TOD 2"
    assert text[3] == "t lines init" and text[4].startswith("a  '")
    assert text[5] == "    path=no" and text[6] == "    dwt=0.01"
    assert all("   7   " in x and "   55.5   'downtown -" in x for x in text if x.startswith("a  '"))
    network = tmp_path / "out" / "network" / "scenario=3" / "tod=4"
    body = "".join(f.read_text() for f in sorted(network.glob("part-*"))).splitlines()
    at = body.index("t links")
    assert body[3] == "t nodes" and body[at - 1] == "" and body[4].startswith("a  ") and len(body) > at + 1
    shape = "".join(f.read_text() for f in sorted((tmp_path / "out" / "link_shapes" / "scenario=1").glob("part-*"))).splitlines()
    assert shape[:3] == ["c RAIL LINK SHAPE FILE FOR SCENARIO 1", "c 01JAN24", "t linkvertices"] and shape[3].startswith("r ")
    assert built.violations.filter("check = 'too_many_layovers'").filter("key NOT LIKE '%|%|%'").isEmpty()
    names = [x.split("'")[1] for x in text if x.startswith("a  '")]
    assert names == sorted(names)
    assert spark.read.csv(str(tmp_path / "out" / "summary"), header=True).count() == built.summary.count()


def test_feed_files(spark, tmp_path):
    path = tmp_path / "seg.csv"
    path.write_text(
        "line,order,a,b,dep,arr,lt,za,zb,skip,shape,d1,d2\n"
        "metra_R1_UP-N_long_name,1,40001,40002,10,20,1.5,A,B,0,s,0,1\n ,2,1,2,3,4,5,A,B,0,s,0,1\n"
    )
    got = rows(readers.read_feed_segments(spark, str(path)).select("line", "it_order", "itin_a", "ltime", "dw_code"))
    assert got == [("metra_R1_UP-N_long_n", 1, 40001, 1.5, 0)]


def test_vertex_text(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("1;2;1;0.5;C;C;1;0.0;0.0\n1;2;1;0.5;C;C;1;3.0;0.0\n1;2;1;0.5;C;C;1;1.0;9.0\n")
    got = readers.as_polylines(readers.read_link_vertices(spark, str(path)), ["a", "b", "miles"]).first()
    assert [tuple(v) for v in got["vertices"]] == [(0.0, 0.0), (3.0, 0.0), (1.0, 9.0)]


def test_table_writers(spark, tmp_path):
    df = spark.createDataFrame([("cta", 1), ("metra", 2)], "system STRING, v INT")
    path = str(tmp_path / "t")
    writers.write_table(df, path, ["system"])
    writers.write_table(df.filter("system = 'cta'").withColumn("v", F.lit(9)), path, ["system"])
    assert rows(spark.read.parquet(path).select("system", "v")) == [("cta", 9), ("metra", 2)]
    copy = readers.snapshot(df, str(tmp_path / "copy"))
    assert rows(copy) == rows(df)
    writers.append_table(df, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 4
    with pytest.raises(ValueError):
        writers.append_table(df.withColumn("x", F.lit(1)), str(tmp_path / "copy"))
    assert T.upsert(df, df, ["system"]).count() == 2


def test_systems_share_a_table(spark, tmp_path):
    for name in ("north", "south"):
        spark.createDataFrame([(name, 1)], "tr_line STRING, v INT").write.parquet(str(tmp_path / name))
    got = readers.read_systems(spark, {n: str(tmp_path / n) for n in ("north", "south")}, "tr_line STRING, v INT")
    assert rows(got.select("system", "tr_line")) == [("north", "north"), ("south", "south")]


def test_systems_with_equal_lines_stay_apart(spark):
    """One link drawn in two pieces, one node gone, and the same line name in two systems."""
    point = lambda x: (float(x), 0.0)
    drawn = [(1, 1, 2, 2.0, 5.0, [point(0), point(10)]), (2, 1, 2, 2.0, 5.0, [point(10), point(20)]), (3, 2, 4, 3.0, 9.0, [point(20), point(40)])]
    links = spark.createDataFrame(drawn, "orig_fid INT, a INT, b INT, miles DOUBLE, shape_leng DOUBLE, vertices ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>")
    links = links.withColumns({"directions": F.lit(1), "modes1": F.lit("M"), "modes2": F.lit("M")})
    nodes = spark.createDataFrame([(1, 0.0), (2, 20.0), (3, 30.0), (4, 40.0)], "node INT, point_x DOUBLE")
    nodes = nodes.select("node", "point_x", F.lit(0.0).alias("point_y"), F.lit(0).alias("pspace"), F.lit(0).alias("pcost"), F.lit("").alias("label"))
    cols = "system STRING, tr_line STRING, it_order INT, itin_a INT, itin_b INT, dw_code STRING, layover STRING, trv_time DOUBLE, dep_time INT, arr_time INT, zn_fare DOUBLE, f_meas DOUBLE, t_meas DOUBLE"
    run = [(1, 1, 2, "0", "0", 10.0, 0, 600, 1.0, 0.0, 2.0), (2, 2, 3, "0", "0", 4.0, 700, 940, 0.0, 2.0, 3.0), (3, 3, 4, "0", "3", 6.0, 1000, 1360, 0.0, 3.0, 5.0)]
    data = [("north", "m1", *r) for r in run] + [("south", "m1", *r) for r in run[:1]]
    itin = spark.createDataFrame(data, cols)
    routes = itin.select("system", "tr_line").distinct()
    out = propagate_edits(links, nodes, routes, itin, strict=False)
    got = rows(out.itinerary.select("system", "it_order", "itin_a", "itin_b", "trv_time", "dep_time", "arr_time"), "system", "it_order")
    assert got == [
        ("north", 1, 1, 90001, 5.0, 0, 300), ("north", 2, 90001, 2, 5.0, 300, 600), ("north", 3, 2, 4, 10.0, 700, 1360),
        ("south", 1, 1, 90001, 5.0, 0, 300), ("south", 2, 90001, 2, 5.0, 300, 600),
    ]
    assert out.violations.filter("check = 'itinerary_gap'").isEmpty()
    with pytest.raises(ValueError):
        propagate_edits(links, nodes, routes.filter("system = 'north'"), itin)


def test_future_lines_follow_the_edits(spark):
    point = lambda x: (float(x), 0.0)
    drawn = [(1, 1, 2, 2.0, 5.0, [point(0), point(10)]), (2, 1, 2, 2.0, 5.0, [point(10), point(20)]), (3, 2, 3, 1.0, 9.0, [point(20), point(30)])]
    links = spark.createDataFrame(drawn, "orig_fid INT, a INT, b INT, miles DOUBLE, shape_leng DOUBLE, vertices ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>")
    links = links.withColumns({"directions": F.lit(1), "modes1": F.lit("M"), "modes2": F.lit("M")})
    nodes = spark.createDataFrame([(1, 0.0), (2, 20.0), (3, 30.0)], "node INT, point_x DOUBLE")
    nodes = nodes.select("node", "point_x", F.lit(0.0).alias("point_y"), F.lit(0).alias("pspace"), F.lit(0).alias("pcost"), F.lit("").alias("label"))
    cols = "tr_line STRING, action INT, it_order INT, itin_a INT, itin_b INT, dw_code STRING, dw_time DOUBLE, layover STRING, trv_time DOUBLE, zn_fare DOUBLE, f_meas DOUBLE, t_meas DOUBLE"
    data = [(f"m{k}", k, 1, 1, 2, "0", 0.01, "", 10.0, 0.0, 0.0, 2.0) for k in (1, 3, 4, 5)]
    itin = spark.createDataFrame(data, cols)
    edited = propagate_edits(links, nodes, itin.select("tr_line").limit(0), itin.limit(0).withColumns({"dep_time": F.lit(0), "arr_time": F.lit(0)}), strict=False)
    stored = spark.createDataFrame([(f"m{k}", s, x, 0.0) for k in (1, 3, 4, 5) for s, x in ((1, 0.0), (2, 10.0), (3, 20.0))], "tr_line STRING, seq INT, x DOUBLE, y DOUBLE")
    orders, shapes = propagate_future(links, nodes, itin, stored, edited)
    got = rows(orders.select("tr_line", "it_order", "itin_a", "itin_b", "trv_time"))
    assert got == [
        ("m1", 1, 1, 90001, 5.0), ("m1", 2, 90001, 2, 5.0), ("m3", 0, 1, 90001, 5.0), ("m3", 0, 90001, 2, 5.0),
        ("m4", -1, 1, 90001, 5.0), ("m4", 1001, 90001, 2, 5.0), ("m5", 1, 1, 90001, 5.0), ("m5", 2, 90001, 2, 5.0),
    ]
    assert rows(shapes.filter("tr_line = 'm1'").select("x", "m")) == [(0.0, 0.0), (10.0, 1.0), (20.0, 2.0)]


def test_coded_projects_become_action_rows(spark):
    routes = spark.createDataFrame(
        [("cbl901", 5, "23", "2", "loop"), ("cbl902", 2, "3", "24", "fast"), ("cbl903", 3, "3", "2", "stop"), ("mun904", 7, "3", "4", "hub"),
         ("mun905", 4, "23", "2", "far"), ("mun906", 1, "2", "1", "new"), ("mun907", 2, "2", "2", "all")],
        "tr_line STRING, action INT, scenario STRING, tod STRING, descr STRING",
    )
    itin = spark.createDataFrame(
        [("cbl901", 2, 11, 12, "77", "0", 0.0), ("cbl902", 1, 12, 13, "", "0", 0.25), ("cbl903", 1, 13, 14, "88", "0.5", 0.0),
         ("mun904", 1, 21, 24, "99", "0", 0.0), ("mun905", -1, 40, 41, "", "0", 3.0), ("mun906", 1, 50, 51, "0", "0", 1.0), ("mun907", 1, 60, 61, "99", "0", 0.1)],
        "tr_line STRING, it_order INT, itin_a INT, itin_b INT, layover STRING, dw_code STRING, trv_time DOUBLE",
    )
    got = {k: rows(v) for k, v in coded_actions(routes, itin, (2, 3)).items()}
    assert got == {
        "shifts": [(2, 2, "cbl", 11, 12, 77, 2), (3, 2, "cbl", 11, 12, 77, 2)],
        "cuts": [(3, 2, "cbl", 12, 13, 0.25), (3, 4, "cbl", 12, 13, 0.25)],
        "stations": [(3, 2, "cbl", 13, 14, 88, "0.5")],
        "spans": [(3, 4, "mun", 21, 24, 99)],
        "extensions": [(2, 2, "mun", "mun905", -1, 40, 41, "0", "0", 3.0), (3, 2, "mun", "mun905", -1, 40, 41, "0", "0", 3.0)],
        "whole_lines": [(2, 2, "mun")],
    }
    movers = spark.createDataFrame([(1, 2, "3", "m")], "anode INT, bnode INT, scenario STRING, notes STRING")
    said = [r["message"] for r in scenario_report(routes, itin, movers, (2, 3)).collect()]
    assert "--> new : added route mun906" in said and "--> stop : added new cbl station at 88 between itin_a = 13 and itin_b = 14" in said
    assert "--> all : reduced mun travel time along entire line by 10 percent" in said
    assert "--> removed scenario = 3 people mover link anode = 1 bnode = 2 from network" in said
