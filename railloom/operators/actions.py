"""Future project actions on scenario itineraries.

Every function takes and returns itineraries; `by` names further keys (scenario, period) that both the
itineraries and the coded rows carry, so one job serves all scenarios and periods. `ln` is the line
group, the first three characters of tr_line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import line_group, period_value, revised_description, round_half_away
from ..session import durable
from .geometry import chain_nodes
from .sequence import RUNS, RunLayout, scan
from .stores import forget, stored
from .tables import cut_by_range, first_per_key, rows_from

# Order in which the actions are applied.
ACTION_ORDER = (5, 2, 3, 7, 4)


def _with_group(itin: DataFrame) -> DataFrame:
    return itin if "ln" in itin.columns else itin.withColumn("ln", line_group("tr_line"))


def _reading(rows: DataFrame, *states: DataFrame) -> DataFrame:
    """`rows` with the stored states it reads, to be forgotten when it is written."""
    rows.reads = states
    return rows


def _next(itin: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """The itineraries after an action, written; what only they were read from goes."""
    new = stored(itin, "itineraries")
    forget(*getattr(itin, "reads", ()), *([] if old is None else [old]))
    return new


def _renumber(rows: DataFrame, by: Sequence[str], order: list[str], layout: RunLayout) -> DataFrame:
    key = [*by, "tr_line"]
    out = scan(rows, key, order, bucket=layout.bucket(order[0]), number="_r")
    return out.withColumn("it_order", F.col("_r").cast("int")).drop("_r")


# --- 5: other terminus --------------------------------------------------------------------------------


def shift_terminus(itin: DataFrame, coded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows (ln, itin_a, itin_b, new, nd): nd 1 replaces the first node of the segment, nd 2 the second."""
    on = [*by, "ln", "itin_a", "itin_b"]
    swap = first_per_key(coded.select(*on, "new", "nd"), on, ["nd", "new"])
    rows = _with_group(itin).join(swap, on, "left")
    a = F.when(F.col("nd") == 1, F.col("new")).otherwise(F.col("itin_a"))
    b = F.when(F.col("nd") == 2, F.col("new")).otherwise(F.col("itin_b"))
    return rows.withColumns({"itin_a": a.cast("int"), "itin_b": b.cast("int")}).select(*itin.columns)


# --- 2: shorter travel time ---------------------------------------------------------------------------


def cut_pairs(
    vertices: DataFrame, nodes: DataFrame, rates: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()
) -> DataFrame:
    """(by.., ln, itin_a, itin_b, reduc): node pairs along the drawn features of the coded lines.

    `vertices` has tr_line, link (feature), seq, x, y; `rates` has by.., tr_line, reduc.
    """
    pairs = chain_nodes(vertices, nodes, ["tr_line", "link"], "seq", layout).join(rates, "tr_line")
    pairs = pairs.select(*by, line_group("tr_line").alias("ln"), "itin_a", "itin_b", "reduc", "tr_line", "link", "seq")
    on = [*by, "ln", "itin_a", "itin_b"]
    return first_per_key(pairs, on, ["tr_line", "link", "seq"]).select(*on, "reduc")


def cut_times(
    itin: DataFrame, cuts: DataFrame, whole_lines: DataFrame, by: Sequence[str] = (), rest_rate: float = 0.1
) -> DataFrame:
    """Shorten the time of matching segments; on `whole_lines` (ln) all other segments by `rest_rate`."""
    on = [*by, "ln", "itin_a", "itin_b"]
    rows = _with_group(itin).join(first_per_key(cuts, on, ["reduc"]), on, "left")
    rows = rows.join(whole_lines.select(*by, "ln").distinct().withColumn("_whole", F.lit(True)), [*by, "ln"], "left")
    rate = F.coalesce("reduc", F.when(F.col("_whole"), F.lit(rest_rate)))
    t = (1 - rate) * F.col("trv_time")
    fine = F.coalesce(F.col("trv_time") < 0.6, F.lit(True))
    cut = F.when(fine, round_half_away(t, 2)).otherwise(round_half_away(t, 1))
    return rows.withColumn("trv_time", F.when(rate > 0, cut).otherwise(F.col("trv_time"))).select(*itin.columns)


# --- 3: new station -----------------------------------------------------------------------------------


def stop_share(dw_code: Column | str, tod: Column | str) -> Column:
    """Share of runs that stop at a new station, a number or a list per period."""
    return period_value(dw_code, tod)


def allocate_stops(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Column `stops`: every `interval`-th row of its group stops until the share is used up.

    `rate` is the share, the same for all rows of a group; without a positive number of stops all pass.
    """
    cut, bucket = cut_by_range(rows, group, order)
    seen = scan(cut, group, order, bucket=bucket, number="_k", size="_freq").drop("_range")
    stops = round_half_away(F.col("_freq") * F.col("rate"), 0)
    seen = seen.withColumn("_stops", stops)
    seen = seen.withColumn("_every", round_half_away(F.try_divide(F.col("_freq"), F.col("_stops")), 0))
    k, every = F.col("_k"), F.col("_every")
    hit = (F.col("_stops") > 0) & (F.pmod(k, F.greatest(every, F.lit(1.0))) == 0) & (k <= every * F.col("_stops"))
    return seen.withColumn("stops", F.coalesce(hit, F.lit(False))).drop("_k", "_freq", "_stops", "_every")


def add_stations(
    itin: DataFrame, coded: DataFrame, tod: str | Column, by: Sequence[str] = (), layout: RunLayout = RUNS
) -> DataFrame:
    """Cut segments at a new station: coded rows (ln, itin_a, itin_b, new, dw_code).

    Both halves take half the time plus half a minute; the first ends at the station without fare or
    layover, and stops by share in order of departure.
    """
    on = [*by, "ln", "itin_a", "itin_b"]
    new = first_per_key(coded.select(*on, "new", F.col("dw_code").alias("share")), on, ["new"])
    all_rows = stored(_with_group(itin).join(new, on, "left"), "stations")
    cut = all_rows.filter(F.col("new") > 0).withColumn("rate", stop_share("share", tod))
    cut = allocate_stops(cut, [*on, "new"], ["dep_time", "tr_line", "it_order"])
    half = round_half_away(F.col("trv_time") / 2 + 0.5, 1)
    first = {
        "half": F.lit(1), "itin_a": F.col("itin_a"), "itin_b": F.col("new"), "layover": F.lit("0"),
        "dw_code": F.when(F.col("stops"), "0").otherwise("1"), "_dwt": F.when(F.col("stops"), 0.01).otherwise(0.0),
    }
    second = {
        "half": F.lit(2), "itin_a": F.col("new"), "itin_b": F.col("itin_b"), "layover": F.col("layover"),
        "dw_code": F.col("dw_code"), "_dwt": F.lit(None).cast("double"),
    }
    parts = rows_from(cut.withColumn("trv_time", half), first, second)
    if "dw_time" in itin.columns:
        parts = parts.withColumn("dw_time", F.coalesce("_dwt", "dw_time"))
    if "zn_fare" in itin.columns:
        parts = parts.withColumn("zn_fare", F.when(F.col("half") == 1, 0.0).otherwise(F.col("zn_fare")))
    kept = all_rows.filter(F.coalesce(F.col("new") <= 0, F.lit(True))).withColumn("half", F.lit(1))
    cols = [*itin.columns, "half"]
    both = kept.select(*cols).unionByName(parts.select(*cols))
    return _reading(_renumber(both, by, ["it_order", "half"], layout).select(*itin.columns), all_rows)


# --- 7: consolidated station --------------------------------------------------------------------------


def mark_spans(itin: DataFrame, coded: DataFrame, by: Sequence[str] = (), layout: RunLayout = RUNS) -> DataFrame:
    """Mark the first coded span each run passes.

    Adds `new` (null outside the span), `at_start`, `at_end` and `total`, the time of the span. Runs that
    already touch a coded station are left alone, and so are runs that never reach the end of the span.
    All steps scan the runs in one order, so they share one shuffle. Rows are written between the joins before.
    """
    key, on = [*by, "tr_line"], [*by, "ln", "itin_a"]
    span = coded.select(*by, "ln", F.col("start_node").alias("itin_a"), F.col("end_node").alias("_end"), F.col("new").alias("_new"))
    rows = _with_group(itin).join(first_per_key(span, on, ["_end", "_new"]), on, "left")
    known = coded.select(*by, "new").distinct()
    old = None
    for end, flag in (("itin_a", "_ka"), ("itin_b", "_kb")):
        before, old = old, stored(rows, "spans")
        rows = old.join(known.withColumnRenamed("new", end).withColumn(flag, F.lit(1)), [*by, end], "left")
        if before is not None:
            forget(before)

    def step(df, **outputs):
        return scan(df, key, ["it_order"], bucket=layout.bucket("it_order"), **outputs)

    hit, touch = F.col("_new").isNotNull(), F.coalesce("_ka", "_kb", F.lit(0))
    rows = step(rows, running={"_hits": F.when(hit, 1).otherwise(0)}, total={"_touch": touch})
    opens = hit & (F.col("_hits") == 1) & (F.col("_touch") == 0)
    rows = step(rows.withColumn("at_start", opens), carry={"_span": F.when(opens, F.struct("_new", "_end"))})
    closes = F.coalesce(F.col("itin_b") == F.col("_span._end"), F.lit(False))
    ends = F.when(closes, 1).otherwise(0)
    rows = step(rows.withColumn("_closes", closes), running={"_ends": ends}, total={"_any": ends})
    inside = F.col("_span").isNotNull() & (F.col("_any") > 0) & ((F.col("_ends") == 0) | (F.col("_closes") & (F.col("_ends") == 1)))
    rows = step(rows.withColumn("_in", inside), total={"total": F.when(inside, F.col("trv_time"))})
    rows = rows.withColumns(
        {
            "new": F.when(F.col("_in"), F.col("_span._new")),
            "at_start": F.col("_in") & F.col("at_start"),
            "at_end": F.col("_in") & F.col("_closes"),
        }
    )
    return _reading(rows.select(*itin.columns, "new", "at_start", "at_end", "total"), old)


def consolidate_stations(itin: DataFrame, coded: DataFrame, by: Sequence[str] = (), layout: RunLayout = RUNS) -> DataFrame:
    """A span of segments from a start to an end node becomes start - station - end.

    Coded rows (ln, start_node, end_node, new). Both new segments take half of the total less half a minute.
    """
    marked = rows = mark_spans(itin, coded, by, layout)
    inside, new = F.col("new").isNotNull(), F.col("new").cast("int")
    rows = rows.filter(~inside | F.col("at_start") | F.col("at_end"))
    half = round_half_away(F.col("total") / 2 - 0.5, 1)

    def part(n: int, a: Column, b: Column, t: Column) -> Column:
        return F.struct(F.lit(n).alias("half"), a.alias("a"), b.alias("b"), t.alias("t"))

    a, b = F.col("itin_a"), F.col("itin_b")
    into, out_of = part(1, a, new, half), part(2, new, b, half)
    parts = (
        F.when(~inside, F.array(part(1, a, b, F.col("trv_time"))))
        .when(F.col("at_start") & F.col("at_end"), F.array(into, out_of))
        .when(F.col("at_start"), F.array(into))
        .otherwise(F.array(out_of))
    )
    rows = rows.withColumn("_v", F.explode(parts))
    rows = rows.withColumns(
        {"half": F.col("_v.half"), "itin_a": F.col("_v.a"), "itin_b": F.col("_v.b"), "trv_time": F.col("_v.t")}
    )
    return _reading(_renumber(rows, by, ["it_order", "half"], layout).select(*itin.columns), *marked.reads)


# --- 4: line extension --------------------------------------------------------------------------------


def extend_lines(itin: DataFrame, coded: DataFrame, by: Sequence[str] = (), layout: RunLayout = RUNS) -> DataFrame:
    """Add coded segments before and behind the runs of a line.

    Coded rows (project, ln, it_order, itin_a, itin_b, layover, dw_code, trv_time): negative orders go in
    front of runs that start at the node they lead to, orders above 1000 behind runs that end at the node
    they leave from. Projects of one line act one after the other, those of different lines together.
    """
    key = [*by, "tr_line"]
    projects = coded.select(*by, "ln", "project").distinct()
    rank = durable(scan(projects, [*by, "ln"], ["project"], number="_turn"))
    coded = durable(coded.join(rank, [*by, "ln", "project"]))  # every turn reads it four times
    turns = rank.agg(F.max("_turn")).first()[0] or 0
    for turn in range(1, turns + 1):
        itin = _extend_once(itin if turn == 1 else durable(itin), coded.filter(F.col("_turn") == turn), by, key, layout)
    return itin


def _extend_once(itin: DataFrame, coded: DataFrame, by, key, layout: RunLayout) -> DataFrame:
    front, back = coded.filter(F.col("it_order") < 0), coded.filter(F.col("it_order") > 1000)
    attach = [*by, "ln"]
    at_front = front.groupBy(*attach).agg(F.max_by("itin_b", "it_order").alias("_front"))
    at_back = back.groupBy(*attach).agg(F.min_by("itin_a", "it_order").alias("_back"))
    rows = _with_group(itin).join(at_front, attach, "left").join(at_back, attach, "left")
    rows = scan(rows, key, ["it_order"], bucket=layout.bucket("it_order"), first="_first", last="_last")
    head = F.coalesce(F.col("_first") & (F.col("itin_a") == F.col("_front")), F.lit(False))
    tail = F.coalesce(F.col("_last") & (F.col("itin_b") == F.col("_back")), F.lit(False))
    rows = rows.withColumns({"_head": head, "_tail": tail})
    ends = F.when(F.col("_tail"), 1).otherwise(0)
    rows = scan(rows, key, ["it_order"], bucket=layout.bucket("it_order"), total={"_tails": ends})
    over = (F.col("_tails") > 0) & (F.coalesce(F.col("layover").try_cast("double"), F.lit(0.0)) > 0)
    rows = rows.withColumn("layover", F.when(over, "0").otherwise(F.col("layover")))
    # An end row also stands for the coded rows to add there; those carry the line as join key, while
    # the row itself carries its own name, so that a busy line does not gather all its segments.
    parts = F.array_compact(F.array(F.when(F.col("_head"), 0), F.lit(1), F.when(F.col("_tail"), 2)))
    rows = rows.withColumn("_part", F.explode(parts))
    own = F.col("_part") == 1
    rows = rows.withColumn("_at_line", F.when(own, F.concat(F.lit("~"), F.col("tr_line"))).otherwise(F.col("ln")))
    new_cols = [c for c in itin.columns if c in coded.columns and c not in (*key, *attach)]
    part = F.when(F.col("it_order") < 0, 0).otherwise(2)
    extra = front.unionByName(back).withColumns({"_part": part, "_at_line": F.col("ln")})
    extra = extra.select(*by, "_part", "_at_line", *[F.col(c).alias(f"_x_{c}") for c in new_cols])
    rows = rows.join(extra, [*by, "_part", "_at_line"], "left")
    blank = F.coalesce(F.col("_x_layover"), F.lit("")) == ""
    rows = rows.withColumn("_x_layover", F.when(blank, "0").otherwise(F.col("_x_layover")))
    values = {c: F.when(own, F.col(c)).otherwise(F.col(f"_x_{c}")) for c in new_cols}
    values.update({c: F.when(own, F.col(c)) for c in itin.columns if c not in (*new_cols, *key, *attach)})
    rows = rows.withColumns(values)
    # One order for all parts: front orders are negative, the back starts behind any run.
    rows = rows.withColumn("_at", F.col("it_order").cast("long") + F.when(F.col("_part") == 2, 1 << 40).otherwise(0))
    return _renumber(rows, by, ["_at"], layout).select(*itin.columns)


# --- all of them --------------------------------------------------------------------------------------


def first_actions(coded_routes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., ln, action) of the action applied first to each line group."""
    rank = F.array_position(F.array(*[F.lit(a) for a in ACTION_ORDER]), F.col("action"))
    rows = coded_routes.withColumns({"ln": line_group("tr_line"), "_rank": rank}).filter(F.col("_rank") > 0)
    best = rows.groupBy(*by, "ln").agg(F.min("_rank").alias("_rank"))
    actions = F.array(*[F.lit(a) for a in ACTION_ORDER])
    return best.select(*by, "ln", F.element_at(actions, F.col("_rank").cast("int")).alias("first_action"))


def revise_descriptions(routes: DataFrame, coded_routes: DataFrame, scenario: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """Mark base runs of changed lines in their description."""
    rows = routes.withColumn("ln", line_group("tr_line")).join(first_actions(coded_routes, by), [*by, "ln"], "left")
    descr = revised_description("description", "tr_line", scenario, F.coalesce("first_action", F.lit(0)))
    return rows.withColumn("description", descr).select(*routes.columns)


def apply_actions(
    itin: DataFrame,
    *,
    shifts: DataFrame | None = None,
    cuts: DataFrame | None = None,
    whole_lines: DataFrame | None = None,
    stations: DataFrame | None = None,
    spans: DataFrame | None = None,
    extensions: DataFrame | None = None,
    tod: str | Column = "1",
    by: Sequence[str] = (),
    layout: RunLayout = RUNS,
) -> DataFrame:
    """All actions in their fixed order; an absent table leaves its action out.

    The itineraries are written between two actions and the state before is deleted, so that the disk holds two states and the shuffle
    of one action, and earlier actions run once.
    """
    old, last = None, None
    whole = whole_lines if whole_lines is not None or cuts is None else cuts.select(*by, "ln").limit(0)
    actions = (
        (shifts, lambda i: shift_terminus(i, shifts, by)),
        (cuts, lambda i: cut_times(i, cuts, whole, by)),
        (stations, lambda i: add_stations(i, stations, tod, by, layout)),
        (spans, lambda i: consolidate_stations(i, spans, by, layout)),
        (extensions, lambda i: extend_lines(i, extensions, by, layout)),
    )
    for coded, action in actions:
        if coded is not None:
            if last is not None:
                itin = old = _next(last(itin), old)
            last = action
    return itin if last is None else last(itin)
