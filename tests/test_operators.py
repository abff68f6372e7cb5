"""Operators on hand-made frames: edges, ties and the settled semantics of odd cases."""

import pytest
from helpers import itin, rows
from pyspark.sql import functions as F

from railloom.functions import core as C
from railloom.operators import actions as A
from railloom.operators import edits as E
from railloom.operators import feed as S
from railloom.operators import itinerary as I
from railloom.operators import network as N
from railloom.operators import qc as Q
from railloom.operators import runs as R
from railloom.operators import spatial as X
from railloom.operators import tables as T
from railloom.operators.ordering import sorted_positions


def test_rounding(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (-0.25,), (None,), (2.5,)], "x DOUBLE")
    got = [r[0] for r in df.select(C.round_half_away("x", 2)).collect()]
    assert got == [0.29, 1.01, -0.25, None, 2.5]


def test_periods(spark):
    df = spark.createDataFrame([(None,), (5,), (6,), (9,), (16,), (18,), (24,)], "h INT")
    assert [r[0] for r in df.select(C.time_of_day("h")).collect()] == [1, 1, 2, 3, 4, 1, 1]


def test_coded_values(spark):
    df = spark.createDataFrame([("15",), ("1:30:23:12:2:9",), ("",), ("4:7",)], "s STRING")
    assert [r[0] for r in df.select(C.period_value("s", "2")).collect()] == [15.0, 9.0, None, None]
    steps = spark.createDataFrame([("",), ("2:50",), ("2:50:5:80",), ("5:80:2:50",)], "s STRING")
    got = steps.select(C.scenario_value("s", 3, F.lit(1.0)), C.scenario_value("s", 6, F.lit(1.0)), C.scenario_value("s", 1, F.lit(1.0)))
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1), (50, 50, 1), (50, 80, 1), (50, 80, 1)]


def test_folding_keeps_islands_apart(spark):
    """Two zero-length stretches of one run go to different neighbours; the trailing one goes back."""
    data = [
        ("r", 1, 1, 1, 10, 20, 1.0), ("r", 2, 1, 2, 30, 40, 2.0), ("r", 3, 2, 2, 41, 45, 0.5),
        ("r", 4, 2, 3, 50, 60, 3.0), ("r", 5, 3, 3, 61, 70, 0.25), ("r", 6, 3, 3, 71, 80, 0.25), ("z", 1, 9, 9, 1, 2, 1.0),
    ]
    df = spark.createDataFrame(data, "tr_line STRING, it_order INT, itin_a INT, itin_b INT, dep_time INT, arr_time INT, ltime DOUBLE")
    got = rows(S.fold_zero_pairs(df).select("tr_line", "it_order", "dep_time", "arr_time", "ltime"))
    assert got == [("r", 2, 10, 40, 3.0), ("r", 4, 41, 80, 4.0)]


def test_gap_fill_out_of_reach(spark):
    segs = [("r", "metra_1", "C", 1, 30001, 30003, 0, 600, 10.0, 2.0, 0), ("r", "metra_1", "C", 2, 30003, 30009, 600, 700, 1.0, 1.0, 0)]
    df = spark.createDataFrame(segs, "tr_line STRING, line STRING, mode STRING, it_order INT, itin_a INT, itin_b INT, dep_time INT, arr_time INT, ltime DOUBLE, zn_fare DOUBLE, dw_code INT")
    links = spark.createDataFrame([(30001, 30002, 1.0), (30002, 30003, 3.0)], "a INT, b INT, miles DOUBLE")
    got = S.fill_gaps(df, links).orderBy("it_order").select("it_order", "itin_a", "itin_b", "ltime", "zn_fare", "dw_code", "imputed", "dep_time", "arr_time")
    assert [tuple(r) for r in got.collect()] == [
        (1, 30001, 30002, 2.5, 2.0, 1, 1, 0.0, 150.0), (2, 30002, 30003, 7.5, 0.0, 0, 1, 150.0, 600.0),
        (3, 30003, 30009, 1.0, 1.0, 0, 0, 600.0, 700.0),
    ]


def test_fare_stays_on_first_piece(spark):
    df = spark.createDataFrame([("r", "x", "C", 1, 30001, 30004, 0, 600, 9.0, 5.0, 0)], "tr_line STRING, line STRING, mode STRING, it_order INT, itin_a INT, itin_b INT, dep_time INT, arr_time INT, ltime DOUBLE, zn_fare DOUBLE, dw_code INT")
    links = spark.createDataFrame([(30001, 30002, 1.0), (30002, 30003, 1.0), (30003, 30004, 1.0)], "a INT, b INT, miles DOUBLE")
    got = S.fill_gaps(df, links).orderBy("it_order").select("zn_fare", "dw_code").collect()
    assert [tuple(r) for r in got] == [(5.0, 1), (0.0, 1), (0.0, 0)]


def test_deleted_nodes(spark):
    """Adjacent deleted nodes merge as one stretch; dangling ends go; untouched runs stay as they are."""
    df = itin(spark, ("a", [1, 2, 3, 4, 5], [1, 2, 3, 4], 0), ("b", [2, 1, 5, 3], 1, 0), ("c", [1, 5], 1, 0))
    df = df.withColumns({"f_meas": F.col("it_order") - 1.0, "t_meas": F.col("it_order") * 1.0, "zn_fare": F.lit(1.0), "arr_time": F.lit(9)})
    gone = spark.createDataFrame([(2, "x"), (3, "y")], "node INT, label STRING")
    got = E.delete_nodes(df, gone).select("tr_line", "it_order", "itin_a", "itin_b", "trv_time", "f_meas", "t_meas", "layover", "zn_fare")
    assert rows(got) == [
        ("a", 1, 1, 4, 6.0, 0.0, 3.0, "0", 3.0), ("a", 2, 4, 5, 4.0, 3.0, 4.0, "3", 1.0),
        ("b", 1, 1, 5, 1.0, 0.0, 1.0, "0", 1.0), ("c", 1, 1, 5, 1.0, 0.0, 1.0, "0", 1.0),
    ]


def test_odd_extension_has_no_order(spark):
    df = itin(spark, ("a", [1, 2, 3, 4], 1, 0), ("b", [1, 2, 3, 4, 5], 1, 0)).withColumn("f_meas", F.col("it_order") * 1.0)
    got = rows(I.extension_orders(df).select("tr_line", "itin_a", "it_order"))
    assert got == [("a", 1, None), ("a", 2, None), ("a", 3, None), ("b", 1, -2), ("b", 2, -1), ("b", 3, 1001), ("b", 4, 1002)]


def state_machine(n, rate):
    """One stop whenever the counter reaches the interval and stops are left."""
    half_up = lambda x: int(x + 0.5 + 1e-9)
    stops = half_up(n * rate)
    if stops <= 0:
        return [False] * n
    every, f, i, out = half_up(n / stops), 0, 1, []
    for _ in range(n):
        hit = f < stops and i == every
        out.append(hit)
        f, i = (f + 1, 1) if hit else (f, i + 1)
    return out


def test_stop_allocation_equals_state_machine(spark):
    data, want = [], {}
    for g, (n, rate) in enumerate([(1, 0.5), (7, 0.4), (10, 0.3), (12, 1.0), (9, 0.0), (20, 0.15), (5, 0.9)]):
        for k, stop in enumerate(state_machine(n, rate)):
            data.append((g, k, f"r{k:02d}", 1, rate))
            want[(g, k)] = stop
    df = spark.createDataFrame(data, "g INT, dep_time INT, tr_line STRING, it_order INT, rate DOUBLE")
    got = A.allocate_stops(df, ["g"], ["dep_time", "tr_line", "it_order"])
    assert {(r["g"], r["dep_time"]): r["stops"] for r in got.collect()} == want


def span(spark, *data):
    return spark.createDataFrame(list(data), "ln STRING, start_node INT, end_node INT, new INT")


def nodes_of(df, name):
    got = [(r["itin_a"], r["itin_b"], r["trv_time"]) for r in df.filter(F.col("tr_line") == name).orderBy("it_order").collect()]
    assert all(x[1] == y[0] for x, y in zip(got, got[1:], strict=False))
    return [got[0][0], *[g[1] for g in got]], [g[2] for g in got]


def test_consolidation(spark):
    df = itin(
        spark, ("ccc1", [1, 2, 3, 4, 5], 2, 0), ("ccc2", [2, 4], 3, 0), ("ccc3", [2, 9], 3, 0), ("ccc4", [2, 3, 99, 4], 1, 0),
        ("ccc5", [2, 3, 4, 2, 4], 1, 0),
    )
    out = A.consolidate_stations(df, span(spark, ("ccc", 2, 4, 99)))
    assert nodes_of(out, "ccc1") == ([1, 2, 99, 4, 5], [2.0, 1.5, 1.5, 2.0])
    assert nodes_of(out, "ccc2") == ([2, 99, 4], [1.0, 1.0])  # one segment: both halves are kept
    assert nodes_of(out, "ccc3") == ([2, 9], [3.0])  # no end follows
    assert nodes_of(out, "ccc4") == ([2, 3, 99, 4], [1.0, 1.0, 1.0])  # station already there
    assert nodes_of(out, "ccc5") == ([2, 99, 4, 2, 4], [0.5, 0.5, 1.0, 1.0])  # first pass only
    assert Q.itinerary_gaps(out).isEmpty()


def extension(spark, *data):
    return spark.createDataFrame(
        list(data), "project STRING, ln STRING, it_order INT, itin_a INT, itin_b INT, layover STRING, dw_code STRING, trv_time DOUBLE"
    )


def test_extension(spark):
    """A project with only a back part finds its node by the order sign; the next project sees the first."""
    df = itin(spark, ("ccc1", [1, 2, 3], 1, 0), ("ccc2", [3, 2, 1], 1, 0)).withColumn("layover", F.lit("4"))
    coded = extension(
        spark, ("p1", "ccc", 1001, 3, 7, "", "0", 2.0), ("p2", "ccc", -1, 8, 1, "", "0", 2.0), ("p2", "ccc", 1001, 7, 9, "", "0", 2.0)
    )
    out = A.extend_lines(df, coded)
    assert nodes_of(out, "ccc1")[0] == [8, 1, 2, 3, 7, 9]
    assert nodes_of(out, "ccc2")[0] == [3, 2, 1]
    lay = [r["layover"] for r in out.filter("tr_line = 'ccc1'").orderBy("it_order").collect()]
    assert lay == ["0"] * 5
    assert [r[0] for r in out.filter("tr_line = 'ccc2'").select("layover").distinct().collect()] == ["4"]


def test_new_station_without_share_passes(spark):
    df = itin(spark, ("ccc1", [1, 2, 3], [0.6, 4.0], 10))
    coded = spark.createDataFrame([("ccc", 1, 2, 50, "23:0")], "ln STRING, itin_a INT, itin_b INT, new INT, dw_code STRING")
    out = A.add_stations(df, coded, "2").orderBy("it_order").select("it_order", "itin_a", "itin_b", "dw_code", "trv_time")
    assert [tuple(r) for r in out.collect()] == [(1, 1, 50, "1", 0.8), (2, 50, 2, "0", 0.8), (3, 2, 3, "0", 4.0)]


def test_time_cut(spark):
    df = itin(spark, ("ccc1", [1, 2, 3, 4], [0.5, 0.605, 2.0], 0), ("ddd1", [1, 2], 1.0, 0))
    cuts = spark.createDataFrame([("ccc", 1, 2, 0.2), ("ccc", 2, 3, 0.2)], "ln STRING, itin_a INT, itin_b INT, reduc DOUBLE")
    whole = spark.createDataFrame([("ccc",)], "ln STRING")
    got = rows(A.cut_times(df, cuts, whole).select("tr_line", "it_order", "trv_time"))
    assert got == [("ccc1", 1, 0.4), ("ccc1", 2, 0.5), ("ccc1", 3, 1.8), ("ddd1", 1, 1.0)]


def test_split_clock(spark):
    df = itin(spark, ("a", [1, 2, 3], [3.0, 1.0], 100))
    df = df.withColumns({"f_meas": F.col("it_order") - 1.0, "t_meas": F.col("it_order") * 1.0, "zn_fare": F.lit(2.0), "arr_time": F.lit(280), "layover": F.lit("4")})
    pieces = spark.createDataFrame([(2, 1, 2, 91, 0.25), (2, 1, 91, 1, 0.75)], "a INT, b INT, tempa INT, tempb INT, newmile DOUBLE")
    got = E.apply_splits(df, pieces).orderBy("it_order").select("itin_a", "itin_b", "f_meas", "t_meas", "trv_time", "zn_fare", "layover", "dep_time", "arr_time")
    assert [tuple(r) for r in got.collect()] == [
        (1, 91, 0.0, 0.75, 2.25, 2.0, "0", 100.0, 235.0), (91, 2, 0.75, 1.0, 0.75, 0.0, "4", 235.0, 280.0),
        (2, 3, 1.0, 2.0, 1.0, 2.0, "4", 100.0, 280.0),
    ]


def test_headway_edges(spark):
    """A lone run takes the period, a zero gap too, and gaps over midnight are folded."""
    data = [("g1", "a", 21600, 2), ("g2", "a", 22000, 2), ("g2", "b", 22000, 2), ("g3", "a", 82800, 1), ("g3", "b", 3600, 1)]
    df = spark.createDataFrame(data, "grp STRING, tr_line STRING, start_sec INT, tod INT")
    gaps = R.departure_gaps(df, ["grp", "tod"])
    got = {r["grp"]: (r["hdwy"], r["runs"]) for r in R.group_headways(gaps, ["grp", "tod"]).collect()}
    assert got == {"g1": (180.0, 1), "g2": (180.0, 2), "g3": (120.0, 2)}


def test_period_runs_keep_base(spark):
    base = spark.createDataFrame([("cbl001", "C", 0, None), ("mbn001", "M", 99, 7)], "tr_line STRING, mode STRING, headway INT, strthour INT")
    coded = spark.createDataFrame([("cbl001", "C", "10", "23", "12", 1), ("cxx001", "C", "1:30:2:8", "2", "12", 1), ("cyy001", "C", "5", "2", "1", 5)],
                                  "tr_line STRING, mode STRING, headway STRING, scenario STRING, tod STRING, action INT")
    got = rows(N.tod_runs(base, coded, (1, 2)).select("scenario", "tod", "tr_line", "headway", "acthdwy"))
    assert got == [
        (1, 1, "cbl001", 0.0, None), (1, 2, "mbn001", 99.0, None), (2, 1, "cbl001", 0.0, None), (2, 1, "cxx001", 30.0, 30.0),
        (2, 2, "cbl001", 10.0, 10.0), (2, 2, "cxx001", 8.0, 8.0), (2, 2, "mbn001", 99.0, None),
    ]


def test_positions_across_partitions(spark):
    df = spark.createDataFrame([(i * 7919 % 101, i) for i in range(101)], "v INT, i INT")
    got = sorted_positions(df, ["v", "i"], "pos").collect()
    assert sorted((r["v"], r["pos"]) for r in got) == [(i, i + 1) for i in range(101)]


def test_nearest_node_crosses_cells(spark):
    pts = spark.createDataFrame([("p", 0.49, 0.0), ("q", 5.0, 5.0)], "id STRING, point_x DOUBLE, point_y DOUBLE")
    nodes = spark.createDataFrame([(1, 0.51, 0.0), (2, 0.3, 0.0)], "node INT, point_x DOUBLE, point_y DOUBLE")
    assert rows(X.nearest_node(pts, nodes, ["id"], 0.5)) == [("p", 1)]


def test_zones(spark):
    def ring(*p):
        return [{"x": float(x), "y": float(y)} for x, y in p]

    zones = spark.createDataFrame([(1, ring((0, 0), (0, 10), (10, 10), (10, 0))), (2, ring((20, 0), (25, 10), (30, 0)))], "zone INT, ring ARRAY<STRUCT<x DOUBLE, y DOUBLE>>")
    nodes = spark.createDataFrame([(1, 5.0, 5.0), (2, 25.0, 5.0), (3, 21.0, 8.0)], "node INT, point_x DOUBLE, point_y DOUBLE")
    assert rows(X.node_zones(nodes, zones, 7.0).select("node", "zone")) == [(1, 1), (2, 2), (3, None)]


def test_checks_raise(spark):
    bad = Q.bad_ends(itin(spark, ("a", [5, 5, 9000], 1, 0)))
    with pytest.raises(ValueError, match="bad_segment: 5-5"):
        Q.assert_clean(bad)
    Q.assert_clean(bad.limit(0))


def test_append_needs_equal_schema(spark):
    a, b = spark.range(1), spark.range(1).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="schemas differ"):
        T.require_same_schema(a, b)
