"""Groups of similar runs.

In run order, a run nobody before it covers becomes a leader; a later run of the same route key joins the
first leader that covers it. A leader of n segments covers a run that shares c of them when
100 (1 + c) / (1 + n) reaches the threshold, so c must be at least t(n).

Pairs are never listed per route key. Runs with equal segment sets count once. A covered run must hold
one of the n - t + 1 rarest segments of its leader, so only these are looked up. And runs are taken in
blocks that grow in size: a block first meets the leaders found so far, and only what they leave over is
compared among itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import durable, replace_state
from .sequence import scan
from .stores import forget, stored
from .tables import cut_by_range


def _profile(rows: DataFrame, key: list[str], threshold: int) -> DataFrame:
    """Per run: number of segments, fingerprint of the set, and the overlap it asks for as a leader."""
    prints = [F.bit_xor(F.xxhash64(F.lit(salt), F.col("seg"))) for salt in ("x", "y", "z")]
    out = rows.groupBy(*key, "run").agg(F.count(F.lit(1)).alias("n"), F.array(*prints).alias("print"))
    need = F.floor((threshold * (1 + F.col("n")) + 99) / 100) - 1
    return out.withColumn("need", F.greatest(need, F.lit(0)))


def _rare_first(rows: DataFrame, key: list[str]) -> DataFrame:
    """Mark the segments by which a leader is looked up, and number the segments of a key in their place, the rarest first."""
    seen = rows.groupBy(*key, "seg").agg(F.count(F.lit(1)).alias("_freq"))
    seen = seen.withColumn("_no", F.row_number().over(W.partitionBy(*key).orderBy("_freq", "seg"))).drop("_freq")
    rows = rows.join(seen, [*key, "seg"]).withColumn("seg", F.col("_no")).drop("_no")
    rank = F.row_number().over(W.partitionBy(*key, "run").orderBy("seg"))
    return rows.withColumn("probe", rank <= F.col("n") - F.greatest("need", F.lit(1)) + 1)


def _sets(rows: DataFrame, key: list[str], run: str, name: str) -> DataFrame:
    """(key.., run, name): the numbers of a run's segments as one array."""
    return rows.groupBy(*key, F.col("run").alias(run)).agg(F.collect_list("seg").alias(name))


def _covers(leaders: DataFrame, runs: DataFrame, key: list[str], earlier_only: bool) -> DataFrame:
    """Pairs (leader, run) where the leader covers the run.

    A pair that shares a probe is told by the arrays of both sides: its segments are no rows again.
    """
    probes = leaders.filter("probe").select(*key, "seg", F.col("run").alias("leader"), "need")
    held = runs.select(*key, "seg", "run", F.col("n").alias("_size"))
    pairs = probes.join(held, [*key, "seg"]).filter(F.col("_size") >= F.col("need"))
    if earlier_only:
        pairs = pairs.filter(F.col("leader") < F.col("run"))
    pairs = pairs.select(*key, "leader", "run", "need").distinct()
    full = pairs.join(_sets(runs, key, "run", "_own"), [*key, "run"]).join(_sets(leaders, key, "leader", "_full"), [*key, "leader"])
    return full.filter(F.size(F.array_intersect("_own", "_full")) >= F.greatest("need", F.lit(1))).select(*key, "leader", "run")


def _decide(runs: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """(key.., run, is_leader): a run leads when every earlier run covering it is known not to lead."""
    covered = edges.select(*key, "run").distinct()
    known = runs.join(covered, [*key, "run"], "left_anti").select(*key, "run", F.lit(1).alias("is_leader"), F.lit(1).alias("fresh"))
    known = durable(known)
    while not known.filter(F.col("fresh") == 1).isEmpty():
        leaders = known.select(*key, F.col("run").alias("leader"), "is_leader")
        tested = edges.join(leaders, [*key, "leader"], "left").groupBy(*key, "run").agg(
            F.max("is_leader").alias("_led"), F.max(F.col("is_leader").isNull().cast("int")).alias("_open")
        )
        settled = tested.filter((F.col("_led") == 1) | (F.col("_open") == 0)).select(
            *key, "run", F.when(F.col("_led") == 1, 0).otherwise(1).alias("is_leader"), F.lit(1).alias("fresh")
        )
        # A settled run stays settled; only runs not seen before stay fresh.
        both = known.withColumn("fresh", F.lit(0)).unionByName(settled)
        folded = both.groupBy(*key, "run").agg(F.max("is_leader").alias("is_leader"), F.min("fresh").alias("fresh"))
        known = replace_state(known, folded)
    return known.drop("fresh")


def cover_pairs(
    signatures: DataFrame, key: Sequence[str] = ("route_key",), run: str = "tr_line", threshold: int = 85
) -> DataFrame:
    """(key.., leader, run): every later run an earlier one covers. The answer itself can be large."""
    key = list(key)
    rows = signatures.select(*key, F.col(run).alias("run"), "seg")
    sized = rows.join(_profile(rows, key, threshold).drop("print"), [*key, "run"])
    marked = durable(_rare_first(sized, key))
    return _covers(marked, marked, key, earlier_only=True).withColumnRenamed("run", run)


def similar_runs(
    signatures: DataFrame,
    key: Sequence[str] = ("route_key",),
    run: str = "tr_line",
    threshold: int = 85,
    block: int = 256,
    growth: int = 16,
) -> DataFrame:
    """(key.., run, leader) from distinct signature rows (key.., run, seg)."""
    return _led(signatures, list(key), run, threshold, block, growth)


def _led(signatures: DataFrame, key: list[str], run: str, threshold: int, block: int = 256, growth: int = 16, common: bool = False) -> DataFrame:
    """(key.., run, leader[, common]): `common` is worked out once for runs with equal segment sets."""
    # Profiles and sets both read the signatures.
    rows = stored(signatures.select(*key, F.col(run).alias("run"), "seg"), "signatures")
    runs = durable(_profile(rows, key, threshold))
    sets = runs.groupBy(*key, "print", "n", "need").agg(F.min("run").alias("run"))
    cut, bucket = cut_by_range(sets, key, ["run"])
    ranked = scan(cut, key, ["run"], bucket=bucket, number="_r")
    steps = F.ceil(F.log(F.greatest(F.col("_r") / block, F.lit(1.0))) / F.log(F.lit(float(growth))) - 1e-9)
    ranked = ranked.withColumn("block", steps.cast("int")).select(*key, "run", "n", "need", "block")
    reps = durable(_rare_first(rows.join(ranked, [*key, "run"]), key))
    forget(rows)
    last = reps.agg(F.max("block")).first()[0]

    leaders, joined = None, None
    for b in range(0 if last is None else last + 1):
        cur = reps.filter(F.col("block") == b)
        if leaders is not None:
            lead_rows = reps.filter(F.col("block") < b).join(leaders, [*key, "run"], "left_semi")
            found = _covers(lead_rows, cur, key, earlier_only=False)
            found = durable(found.groupBy(*key, "run").agg(F.min("leader").alias("leader")))
            joined = found if joined is None else joined.unionByName(found)
            cur = cur.join(found, [*key, "run"], "left_anti")
        edges = durable(_covers(cur, cur, key, earlier_only=True))
        known = _decide(cur.select(*key, "run").distinct(), edges, key)
        led = known.filter("is_leader = 1").select(*key, "run")
        own = edges.join(led.select(*key, F.col("run").alias("leader")), [*key, "leader"], "left_semi")
        own = own.join(led, [*key, "run"], "left_anti").groupBy(*key, "run").agg(F.min("leader").alias("leader"))
        part = own.unionByName(led.withColumn("leader", F.col("run")))
        joined = part if joined is None else joined.unionByName(part)
        leaders = led if leaders is None else durable(leaders.unionByName(led))
    if joined is None:
        none = signatures.select(*key, run, F.col(run).alias("leader"), *([F.lit(0).cast("long").alias("common")] if common else []))
        return none.limit(0)
    if common:
        joined = joined.join(_sets(reps, key, "run", "_own"), [*key, "run"]).join(_sets(reps, key, "leader", "_full"), [*key, "leader"])
        joined = joined.withColumn("common", F.size(F.array_intersect("_own", "_full")).cast("long")).drop("_own", "_full")
    by_set = sets.select(*key, "print", "n", "run").join(joined, [*key, "run"]).drop("run")
    out = runs.select(*key, "run", "print", "n").join(by_set, [*key, "print", "n"])
    return out.select(*key, F.col("run").alias(run), "leader", *(["common"] if common else []))


def led_runs(signatures: DataFrame, key: Sequence[str] = ("route_key",), run: str = "tr_line", threshold: int = 85) -> DataFrame:
    """(key.., run, leader, common): every run with the leader of its group and the number of segments both have.

    One row per run, however many earlier runs cover it; leaders share all their segments with themselves.
    """
    return _led(signatures, list(key), run, threshold, common=True)
