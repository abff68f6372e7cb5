"""Leaders with common segments: the signatures are read for the sets only, nulls and equal sets count as before."""

from railloom.operators.clustering import cover_pairs, led_runs, similar_runs

SIG = "route_key INT, tr_line INT, seg STRING"


def test_common_segments_come_from_the_sets(spark, tmp_path):
    """The result reads no signature row again; before, it joined them three times."""
    sets = {1: "abcdefgh", 2: "abcdefgh", 3: "abcdefg", 4: "abcx", 5: "abcdefghi", 6: "xyz"}
    rows = [(k, run, seg) for k in (0, 1) for run, segs in sets.items() for seg in segs] + [(0, 7, None), (None, 8, "a"), (0, None, "q")]
    spark.createDataFrame(rows, SIG).write.parquet(f"{tmp_path}/sig")
    sig = spark.read.parquet(f"{tmp_path}/sig")
    out = led_runs(sig)
    assert not [f for f in out.inputFiles() if str(tmp_path) in f]
    want = {(1, 1, 8), (2, 1, 8), (3, 1, 7), (4, 4, 4), (5, 1, 8), (6, 6, 3)}
    assert {tuple(r) for r in out.collect() if r.tr_line is not None} == {(k, *w) for k in (0, 1) for w in want}
    assert similar_runs(sig).columns == ["route_key", "tr_line", "leader"]
    assert {(r.leader, r.tr_line) for r in cover_pairs(sig.filter("route_key = 1")).collect()} == {(1, 2), (1, 3), (2, 3), (1, 5), (2, 5), (3, 5)}
