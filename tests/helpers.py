"""Small frames for the unit tests."""

import math


def rows(df, *order):
    got = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return got if order else sorted(got, key=repr)


def close(a, b, eps=1e-9):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, abs_tol=eps)
    return a == b


ITIN = (
    "tr_line STRING, it_order INT, itin_a INT, itin_b INT, dw_code STRING, layover STRING, trv_time DOUBLE, dep_time INT"
)


def itin(spark, *runs):
    """runs: (name, [nodes], [times] or time, first departure)."""
    data = []
    for name, nodes, times, dep in runs:
        for i, (a, b) in enumerate(zip(nodes, nodes[1:], strict=False)):
            t = times[i] if isinstance(times, list) else times
            data.append((name, i + 1, a, b, "0", "0", float(t), dep))
    return spark.createDataFrame(data, ITIN)
