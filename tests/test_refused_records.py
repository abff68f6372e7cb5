"""Records and headers that do not fit their layout, for each reader and for the import jobs."""

import pytest
from helpers import rows

from railloom.plans.imports import import_feed_files
from railloom.sources import readers as T
from railloom.sources.dims import fare_zones

RUN = "line,shape_id,description,mode,route_id,route_long_name,direction,terminal,speed"
SEGMENT = "line,it_order,itin_a,itin_b,dep_time,arr_time,ltime,zone_id_a,zone_id_b,dw_code,shape_id,shape_dist_trav_a,shape_dist_trav_b"
CASES = {
    "runs": (T.FEED_RUNS, RUN, ["ctaR1,s,d,C,Blue,long,in,loop,20.5", "ctaR2,s,d,C,Blue,long,in,loop,fast"]),
    "segments": (T.FEED_SEGMENTS, SEGMENT, ["ctaR1,1,30001,30002,0,60,1.0,A,B,0,s,0,1", "ctaR1,two,30002,30003,60,120,1.0,A,B,0,s,1,2"]),
    "headers": (T.HEADERS, "tr_line,description,mode,veh_type,headway,speed,tod,scenario,action,tip_id,rsp_id,completion_year,notes", ["mun901,d,M,8,30,30,2,3,1,0,r,2030,n", "mun902,d,M,8,30,30,2,3,one,0,r,2030,n"]),
    "itineraries": (T.ITINERARIES, "tr_line,ord,itin_a,itin_b,layover,dw_code,trv_time,zn_fare", ["mun901,1,40001,40002,,0,5,0", "mun901,2,40002,x40003,,0,5,0"]),
    "links": (T.LINK_VERTICES, None, ["1;2;1;0.5;C;C;1;0.0;0.0", "1;2;1;0.5;C;C;1;3.0;north"]),
    "routes": (T.ROUTE_VERTICES, None, ["1;cbl001;0.0;0.0;0.0", "1;cbl001;zero;0.0;0.0"]),
    "actions": (T.ACTION_VERTICES, None, ["1;mun902;2;0.0;0.0", "1;mun902;2;;oops"]),
}


def written(folder, name, header, lines):
    path = folder / f"{name}.csv"
    path.write_text("\n".join(([header] if header else []) + lines) + "\n")
    return str(path)


@pytest.mark.parametrize("name", CASES)
def test_refused_records(spark, tmp_path, name):
    layout, header, lines = CASES[name]
    path = written(tmp_path, name, header, lines)
    assert rows(T.refused(spark, path, layout)) == [("refused_record", f"{name}.csv", lines[1])]
    readers = {
        "runs": T.read_feed_runs, "segments": T.read_feed_segments, "headers": lambda s, p: T.read_coding_sheets(s, p, p)[0],
        "itineraries": lambda s, p: T.read_coding_sheets(s, p, p)[1], "links": T.read_link_vertices, "routes": T.read_route_vertices, "actions": T.read_action_vertices,
    }
    got = readers[name](spark, path)
    assert got.count() == 1 and T.REFUSED not in got.columns
    # One column alone gives the same records.
    assert got.select(got.columns[0]).collect() and got.select(got.columns[0]).count() == 1


def test_short_and_long_records_are_refused(spark, tmp_path):
    lines = ["ctaR1,s,d,C", "ctaR2,s,d,C,Blue,long,in,loop,20.5,more", "ctaR3,,,C,,,,,", ""]
    path = written(tmp_path, "short", RUN, lines)
    assert [r["line"] for r in T.read_feed_runs(spark, path).collect()] == ["ctaR3"]
    assert rows(T.refused(spark, path, T.FEED_RUNS).select("detail")) == [(x,) for x in lines[:2]]


@pytest.mark.parametrize("name", ["runs", "segments", "headers", "itineraries"])
def test_a_wrong_header_ends_the_job(spark, tmp_path, name):
    layout, header, lines = CASES[name]
    names = header.split(",")
    names[2], names[3] = names[3], names[2]
    path = written(tmp_path, name, ",".join(names), lines[:1])
    assert T.records(spark, path, layout).count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        T.records(spark, path, layout, named=True).collect()
    good = written(tmp_path, f"{name}2", header, lines[:1])
    assert T.records(spark, good, layout, named=True).count() == 1


def test_import_job_reports_and_stops(spark, tmp_path):
    links = spark.createDataFrame([(30001, 30002, 1.0, 2, "C", "C"), (30002, 30003, 1.0, 2, "C", "C")], "a INT, b INT, miles DOUBLE, directions INT, modes1 STRING, modes2 STRING")
    runs = written(tmp_path, "runs", RUN, ["ctaR1,s,to loop,C,Blue,long,in,loop,20.5"])
    lines = ["ctaR1,1,30001,30002,0,60,1.0,A,B,0,s,0,1", "ctaR1,2,30002,30003,60,120,1.0,A,B,0,s,1,2"]
    clean = import_feed_files(spark, runs, written(tmp_path, "good", SEGMENT, lines), links, fare_zones(spark), named=True)
    assert rows(clean.itinerary.select("it_order", "itin_a", "itin_b")) == [(1, 30001, 30002), (2, 30002, 30003)]
    bad = written(tmp_path, "bad", SEGMENT, [*lines, "ctaR1,3,30003,30002,120,later,1.0,A,B,0,s,2,3"])
    done = import_feed_files(spark, runs, bad, links, fare_zones(spark), strict=False)
    assert rows(done.violations.filter("check = 'refused_record'").select("key")) == [("bad.csv",)] and done.itinerary.count() == 2
    with pytest.raises(ValueError, match="refused_record"):
        import_feed_files(spark, runs, bad, links, fare_zones(spark))
