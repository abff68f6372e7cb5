"""The scenario job: future links, the first coded rate of a line, the change report, from frames to files."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from railloom.plans.scenario import build_scenarios, coded_actions, scenario_links, write_scenarios

ROUTES = "tr_line STRING, mode STRING, longname STRING, headway STRING, scenario STRING, tod STRING, action INT, description STRING, veh_type INT, speed DOUBLE"
CODED = "tr_line STRING, it_order INT, itin_a INT, itin_b INT, layover STRING, dw_code STRING, trv_time DOUBLE, zn_fare DOUBLE, dep_time INT"
LINKS = "a INT, b INT, miles DOUBLE, directions INT, modes1 STRING, modes2 STRING, vertices ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>"


def drawn(*xs):
    return [(float(x), 0.0) for x in xs]


@pytest.fixture(scope="module")
def world(spark):
    """A line 40001 - 40002 - 40003 in use, a future piece 40003 - 40004, and a road for transfers."""
    links = [
        (40001, 40002, 1.0, 2, "M", "M", drawn(0, 5000)), (40002, 40003, 1.0, 2, "M", "M", drawn(5000, 10000)),
        (40003, 40004, 1.0, 2, "M", "M", drawn(10000, 12000, 15000)), (40004, 40005, 1.0, 2, "M", "M", drawn(15000, 20000)),
        (101, 40001, 0.1, 2, "T", "T", drawn(-100, 0)),
    ]
    runs = [("mun001", "M", "UP", 99.0, 7, 25200, "un", "base run", 8, 30.0)]
    itin = [("mun001", 1, 40001, 40002, "0", "0", 5.0, 0.0, 25200), ("mun001", 2, 40002, 40003, "3", "0", 5.0, 0.0, 25500)]
    routes = [("mun901", "M", "UP", "30", "3", "2", 1, "far shore", 8, 30.0), ("mun902", "M", "UP", "0", "13", "2", 2, "fast track", 8, 30.0)]
    coded = [
        ("mun901", 1, 40002, 40003, "0", "0", 5.0, 0.0, 26000), ("mun901", 2, 40003, 40004, "3", "0", 5.0, 0.0, 26300),
        ("mun902", 1, 40001, 40002, "0", "0", 0.25, 0.0, 0), ("mun902", 2, 40002, 40003, "0", "0", 0.4, 0.0, 0),
    ]
    nodes = [(n, f"n{n}", 1, 1, "", "", x, 0.0) for n, x in ((40001, 0.0), (40002, 5000.0), (40003, 10000.0), (40004, 15000.0), (40005, 20000.0), (101, -100.0))]
    frames = {
        "links": spark.createDataFrame(links, LINKS), "runs": spark.createDataFrame(runs, "tr_line STRING, mode STRING, longname STRING, headway DOUBLE, strthour INT, start_sec INT, route_id STRING, description STRING, veh_type INT, speed DOUBLE"),
        "itin": spark.createDataFrame(itin, CODED), "routes": spark.createDataFrame(routes, ROUTES), "coded": spark.createDataFrame(coded, CODED),
        "nodes": spark.createDataFrame(nodes, "node INT, label STRING, pspace INT, pcost INT, ftr_pspace STRING, ftr_pcost STRING, point_x DOUBLE, point_y DOUBLE"),
        "movers": spark.createDataFrame([(101, 40001, "1", "people mover")], "anode INT, bnode INT, scenario STRING, notes STRING"),
        # The future line is drawn with vertices of its own.
        "future": spark.createDataFrame([("mun901", drawn(9000, 11000, 14500))], "tr_line STRING, vertices ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>"),
        "cut": spark.createDataFrame([("mun902", 1, 1, 0.0, 0.0), ("mun902", 1, 2, 5000.0, 0.0), ("mun902", 1, 3, 10000.0, 0.0)], "tr_line STRING, link INT, seq INT, x DOUBLE, y DOUBLE"),
    }
    return frames


def test_future_links_belong_to_the_scenarios_of_their_routes(world):
    net = scenario_links(world["links"], world["itin"], world["routes"], world["future"], world["movers"], (1, 3))
    got = {}
    for s, a, b in rows(net.select("scenario", "a", "b")):
        got.setdefault(s, set()).add((a, b))
    base = {(40001, 40002), (40002, 40003)}
    assert got == {1: base | {(101, 40001)}, 3: base | {(40003, 40004)}}  # the mover runs in scenario 1 only
    plain = scenario_links(world["links"], world["itin"], world["routes"], None, world["movers"], (3,))
    assert plain.count() == 4


def test_the_first_coded_rate_holds_for_a_line(world):
    got = coded_actions(world["routes"], world["coded"], (1, 3), world["cut"], world["nodes"])["cuts"]
    assert rows(got.filter("scenario = 1").select("itin_a", "itin_b", "reduc")) == [(40001, 40002, 0.25), (40002, 40003, 0.25)]


def test_job_to_files(spark, world, tmp_path):
    built = build_scenarios(
        world["runs"], world["itin"], world["links"], world["nodes"], world["routes"], world["coded"], world["movers"], (1, 3),
        action_vertices=world["cut"], max_zone=100, strict=False, future_routes=world["future"],
    )
    ends = rows(built.itinerary.filter("tr_line = 'mun901'").select("scenario", "tod", "itin_a", "itin_b"))
    assert ends == [(3, 2, 40002, 40003), (3, 2, 40003, 40004)]
    used = {tuple(r) for r in rows(built.links.select("scenario", "a", "b"))}
    assert (3, 40003, 40004) in used and not any(s == 1 and 40004 in (a, b) for s, a, b in used)
    times = rows(built.itinerary.filter("tr_line = 'mun001' AND tod = 2").select("scenario", "itin_a", "trv_time"))
    assert times == [(1, 40001, 3.8), (1, 40002, 3.8), (3, 40001, 3.8), (3, 40002, 3.8)]
    assert built.violations.filter("check = 'link_without_miles'").isEmpty()
    write_scenarios(built, spark.createDataFrame([], "a INT, b INT, ord INT, x DOUBLE, y DOUBLE"), str(tmp_path / "out"), "01JAN24")
    part = tmp_path / "out" / "report" / "scenario=3" / "tod=2"
    said = "".join(f.read_text() for f in sorted(part.glob("part-*"))).splitlines()
    assert said[:2] == ["### NEW ROUTES 2 ###", "--> far shore : added route mun901"] and said[2] == "### TRAVEL TIME REDUCTIONS 2 ###"
    assert "--> fast track : reduced mun travel time from 40001 to 40002 by 25 percent" in said
    closed = "".join(f.read_text() for f in (tmp_path / "out" / "report" / "scenario=3" / "tod=0").glob("part-*")).splitlines()
    assert closed == ["### O'HARE PEOPLE MOVER EXTENSION ###", "--> removed scenario = 1 people mover link anode = 101 bnode = 40001 from network"]
    assert not (tmp_path / "out" / "report" / "scenario=1" / "tod=0").exists()
