"""States of the actions: what the disk holds when all of them ran."""

from pathlib import Path

from helpers import itin, rows

from railloom.operators import actions as A
from railloom.session import shared_folder


def test_states_between_actions_go(spark):
    """Results are those of the actions one by one; one state of the itineraries is left, before it was every one as raw rows."""
    base = itin(spark, ("cga001", [1, 2, 3, 4, 5], 2, 100), ("cga002", [2, 3, 4], 3, 200), ("mun001", [1, 2, 3], 4, 50))
    shifts = spark.createDataFrame([("cga", 4, 5, 55, 2)], "ln STRING, itin_a INT, itin_b INT, new INT, nd INT")
    cuts = spark.createDataFrame([("mun", 1, 2, 0.5)], "ln STRING, itin_a INT, itin_b INT, reduc DOUBLE")
    stations = spark.createDataFrame([("cga", 2, 3, 77, "1")], "ln STRING, itin_a INT, itin_b INT, new INT, dw_code STRING")
    spans = spark.createDataFrame([("cga", 3, 55, 88)], "ln STRING, start_node INT, end_node INT, new INT")
    more = "project STRING, ln STRING, it_order INT, itin_a INT, itin_b INT, layover STRING, dw_code STRING, trv_time DOUBLE"
    extensions = spark.createDataFrame([("p", "mun", -1, 9, 1, "0", "0", 1.5), ("p", "mun", 1001, 3, 8, "0", "0", 1.0)], more)
    folder = Path(shared_folder(spark).removeprefix("file://"))
    left = lambda: {p.name for p in folder.iterdir() if p.name.split("-")[0] in ("itineraries", "stations", "spans")}
    raw = lambda: {p for p in folder.glob("*/rdd-*")}
    held, kept = left(), raw()
    out = A.apply_actions(base, shifts=shifts, cuts=cuts, stations=stations, spans=spans, extensions=extensions)
    new = left() - held
    assert len(new) == 1 and next(iter(new)).startswith("itineraries-")
    assert len(raw() - kept) == 3  # rows at new stations, projects and their turns; before, two states of the itineraries as well
    want = A.cut_times(A.shift_terminus(base, shifts), cuts, cuts.select("ln").limit(0))
    want = A.extend_lines(A.consolidate_stations(A.add_stations(want, stations, "1"), spans), extensions)
    assert rows(out) == rows(want) and out.count() == 12
    assert A.apply_actions(base) is base
