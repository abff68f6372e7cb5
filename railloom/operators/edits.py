"""Carry link and node edits through node tables and itineraries.

`by` names the columns that tell runs of one name apart, such as the route system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.core import is_junction, round_half_away
from ..session import durable
from . import itinerary as I
from .sequence import RUNS, RunLayout, scan
from .spatial import number_points
from .tables import first_per_key, rows_from

FIRST_TEMPORARY = 90001


def split_ends(ends: DataFrame, nodes: DataFrame) -> DataFrame:
    """Link ends with `split` (the pair was drawn in pieces) and `fresh` (a new point inside it)."""
    pieces = ends.groupBy("a", "b").agg((F.count(F.lit(1)) > 2).alias("split"))
    known = nodes.select("point_x", "point_y").distinct().withColumn("_known", F.lit(True))
    marked = ends.join(pieces, ["a", "b"]).join(known, ["point_x", "point_y"], "left")
    return marked.withColumn("fresh", F.col("split") & F.col("_known").isNull()).drop("_known")


def split_pieces(ends: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces (orig_fid, a, b, newmile, tempa, tempb) of split links, and the temporary nodes.

    Miles are shared by drawn length. A new point gets one temporary number for all pieces that meet there.
    """
    # Read four times below, so it is written once.
    marked = durable(split_ends(ends, nodes))
    temp = number_points(marked.filter("fresh"), FIRST_TEMPORARY)
    placed = marked.join(temp, ["point_x", "point_y"], "left")
    start = F.col("which") == "start"
    rows = placed.filter("split").groupBy("orig_fid", "a", "b").agg(
        F.max("miles").alias("miles"), F.max("shape_leng").alias("shape_leng"), F.max("fresh").alias("fresh"),
        F.max(F.when(start, F.col("node"))).alias("_ta"), F.max(F.when(~start, F.col("node"))).alias("_tb"),
    )
    sums = rows.groupBy("a", "b").agg(F.sum("shape_leng").alias("_tot"), F.max("fresh").alias("_any"))
    rows = rows.join(sums, ["a", "b"]).filter("_any")
    share = F.try_divide(F.col("shape_leng"), F.col("_tot")) * F.col("miles")
    pieces = rows.select(
        "orig_fid", "a", "b", round_half_away(share, 2).alias("newmile"),
        F.coalesce("_ta", "a").alias("tempa"), F.coalesce("_tb", "b").alias("tempb"),
    )
    return pieces, temp


def refresh_nodes(ends: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New node table (one row per place, highest number; 0 at new points) and the deleted nodes."""
    marked = split_ends(ends, nodes)
    number = F.when(F.col("fresh"), 0).otherwise(F.when(F.col("which") == "start", F.col("a")).otherwise(F.col("b")))
    places = marked.groupBy("point_x", "point_y").agg(F.max(number).alias("node"))
    old = nodes.withColumnsRenamed({"point_x": "point_x0", "point_y": "point_y0"})
    new = places.join(old, "node", "left").na.fill(0, ["pspace", "pcost"])
    gone = nodes.join(places.select("node"), "node", "left_anti").select("node", "label")
    return new, gone


def order_pieces(pieces: DataFrame) -> DataFrame:
    """Both directions of every split link with the piece number o of n and the miles before it."""
    link = W.partitionBy("a", "b")
    rows = pieces.withColumn("n", F.count(F.lit(1)).over(link))
    rank = F.when(F.col("tempa") == F.col("a"), 1.0).when(F.col("tempb") == F.col("b"), F.col("n").cast("double"))
    rank = F.coalesce(rank, (1 + F.col("n")) / 2)
    rows = rows.withColumn("o", F.row_number().over(link.orderBy(rank, "tempa", "tempb")))
    both = rows_from(
        rows.select("a", "b", "n", "o", "tempa", "tempb", "newmile"),
        {"a": "a", "b": "b", "o": "o", "tempa": "tempa", "tempb": "tempb"},
        {"a": "b", "b": "a", "o": F.col("n") + 1 - F.col("o"), "tempa": "tempb", "tempb": "tempa"},
    )
    so_far = F.sum("newmile").over(link.orderBy("o").rowsBetween(W.unboundedPreceding, -1))
    return both.withColumns({"x": F.coalesce(so_far, F.lit(0.0)), "totmile": F.sum("newmile").over(link)})


def apply_splits(itin: DataFrame, pieces: DataFrame, base: bool = True, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """Replace segments on split links by their pieces.

    Time is shared by length, the fare stays on the first piece, the layover on the last. Base runs
    chain the clock: departures are whole seconds, so rounding each arrival equals adding rounded steps.
    """
    keyed = order_pieces(pieces).withColumnsRenamed({"a": "itin_a", "b": "itin_b"})
    rows = itin.join(keyed, ["itin_a", "itin_b"], "left")
    cut = F.col("n").isNotNull()
    first, last = F.col("o") == 1, F.col("o") == F.col("n")
    trv = F.when(cut, round_half_away(F.col("trv_time") * (F.col("newmile") / F.col("totmile")), 2)).otherwise(F.col("trv_time"))
    f_meas = F.when(cut & ~first, round_half_away(F.col("f_meas") + F.col("x"), 2)).otherwise(F.col("f_meas"))
    rows = rows.withColumns({"_trv": trv, "_f": f_meas, "o": F.coalesce("o", F.lit(0))})
    cleared = F.lit("0" if base else "")
    new = {
        "itin_a": F.when(cut & ~first, F.col("tempa")).otherwise(F.col("itin_a")),
        "itin_b": F.when(cut & ~last, F.col("tempb")).otherwise(F.col("itin_b")),
        "f_meas": F.col("_f"),
        "t_meas": F.when(cut & ~last, round_half_away(F.col("_f") + F.col("newmile"), 2)).otherwise(F.col("t_meas")),
        "trv_time": F.col("_trv"),
        "zn_fare": F.when(cut & ~first, 0.0).otherwise(F.col("zn_fare")),
        "layover": F.when(cut & ~last, cleared).otherwise(F.col("layover")),
    }
    if base:
        # The pieces of one segment are a handful of rows.
        seg = W.partitionBy(*by, "tr_line", "it_order").orderBy("o")
        step = round_half_away(F.col("_trv") * 60, 0)
        spent = F.sum(step).over(seg.rowsBetween(W.unboundedPreceding, W.currentRow))
        rows = rows.withColumns({"_step": step, "_spent": spent})
        new["dep_time"] = F.when(cut, F.col("dep_time") + F.col("_spent") - F.col("_step")).otherwise(F.col("dep_time"))
        new["arr_time"] = F.when(cut & ~last, F.col("dep_time") + F.col("_spent")).otherwise(F.col("arr_time"))
    rows = rows.withColumns(new)
    rows = I.resequence(rows, layout, ("it_order", "o"), by)
    return rows.select(*itin.columns)


def future_orders(itin: DataFrame, layout: RunLayout = RUNS, by: Sequence[str] = ()) -> DataFrame:
    """Segment orders of future lines by action: 1 and 5 count up, 4 counts around its ends, others 0."""
    seen = scan(itin, [*by, "tr_line"], ["f_meas", "it_order"], bucket=layout.bucket("it_order"), number="_r", size="_n")
    half = F.floor(F.col("_n") / 2)
    ends = F.when(F.col("_r") <= half, F.col("_r") - 1 - half).otherwise(1000 + F.col("_r") - half)
    ends = F.when(F.col("_n") % 2 == 0, ends)
    order = F.when(F.col("action").isin(1, 5), F.col("_r")).when(F.col("action") == 4, ends).otherwise(0)
    return seen.withColumn("it_order", order.cast("int")).drop("_r", "_n")


def delete_nodes(itin: DataFrame, deleted: DataFrame, layout: RunLayout = RUNS, future: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Take deleted nodes out of itineraries.

    Segments are joined across every stretch of deleted nodes; what dangles before the first or behind
    the last remaining node is dropped. Touched runs are measured and numbered again and end with
    layover 3 and a stop.
    """
    key = [*by, "tr_line"]
    gone = deleted.select("node").distinct()
    rows = itin
    for end, flag in (("itin_a", "_sa"), ("itin_b", "_sb")):
        rows = rows.join(gone.select(F.col("node").alias(end), F.lit(True).alias(flag)), end, "left")
        rows = rows.withColumn(flag, F.coalesce(flag, F.lit(False)))
    hit = F.when(F.col("_sa") | F.col("_sb"), 1).otherwise(0)
    opens = F.when(~F.col("_sa"), 1).otherwise(0)
    rows = scan(rows, key, ["it_order"], bucket=layout.bucket("it_order"), running={"_g": opens}, total={"_hits": hit})
    rows = rows.filter(F.col("_g") > 0)

    def head(c):
        return F.min_by(c, "it_order").alias(c)

    def tail(c):
        return F.max_by(c, "it_order").alias(c)

    heads = [c for c in ("itin_a", "f_meas", "dep_time") if c in itin.columns]
    sums = [c for c in ("zn_fare", "trv_time") if c in itin.columns]
    tails = [c for c in itin.columns if c not in (*heads, *sums, *key, "it_order")]
    merged = rows.groupBy(*key, "_g").agg(
        F.max("it_order").alias("it_order"), F.max("_hits").alias("_hits"), F.max_by("_sb", "it_order").alias("_open"),
        *[head(c) for c in heads], *[F.sum(c).alias(c) for c in sums], *[tail(c) for c in tails],
    )
    merged = merged.filter(~F.col("_open")).withColumn("_m", F.col("t_meas") - F.col("f_meas"))
    out = scan(
        merged, key, ["it_order"], bucket=layout.bucket("it_order"), number="_r", last="_last", running={"_t": F.col("_m")}
    )
    touched = F.col("_hits") > 0
    ending = touched & F.col("_last") & (F.col("_r") > 1)
    out = out.withColumns(
        {
            "f_meas": F.when(touched, F.col("_t") - F.col("_m")).otherwise(F.col("f_meas")),
            "t_meas": F.when(touched, F.col("_t")).otherwise(F.col("t_meas")),
            "it_order": F.when(touched, F.col("_r")).otherwise(F.col("it_order")).cast("int"),
            "layover": F.when(ending, "3").otherwise(F.col("layover")),
            "dw_code": F.when(ending, "0").otherwise(F.col("dw_code")),
        }
    )
    if future:
        out = out.withColumn("dw_time", F.when(ending, 0.01).otherwise(F.col("dw_time")))
    return out.select(*itin.columns)


def renumber_itinerary(itin: DataFrame, changes: DataFrame) -> DataFrame:
    """Itineraries follow renumbered link ends (a, b, newa, newb) in both directions.

    A segment that ends at a junction passes it, unless the line is generic.
    """
    moved = changes.filter((F.col("a") != F.col("newa")) | (F.col("b") != F.col("newb")))
    both = rows_from(
        moved,
        {"itin_a": "a", "itin_b": "b", "newa": "newa", "newb": "newb", "_back": F.lit(0)},
        {"itin_a": "b", "itin_b": "a", "newa": "newb", "newb": "newa", "_back": F.lit(1)},
    ).select("itin_a", "itin_b", "newa", "newb", "_back")
    both = first_per_key(both, ["itin_a", "itin_b"], ["_back"]).drop("_back")
    rows = itin.join(both, ["itin_a", "itin_b"], "left")
    rows = rows.withColumns(
        {"itin_a": F.coalesce("newa", "itin_a"), "itin_b": F.coalesce("newb", "itin_b")}
    )
    passes = ~F.col("tr_line").contains("*") & is_junction("itin_b")
    rows = rows.withColumn("dw_code", F.when(passes, "1").otherwise(F.col("dw_code")))
    if "dw_time" in itin.columns:
        rows = rows.withColumn("dw_time", F.when(passes, 0.0).otherwise(F.col("dw_time")))
    return rows.select(*itin.columns)


def renumber_links(links: DataFrame, found: DataFrame) -> DataFrame:
    """Link ends with their coincident nodes: newa, newb; `found` has (a, b, which, node)."""
    ends = found.groupBy("a", "b").agg(
        F.max(F.when(F.col("which") == "start", F.col("node"))).alias("_na"),
        F.max(F.when(F.col("which") == "end", F.col("node"))).alias("_nb"),
    )
    rows = links.join(ends, ["a", "b"], "left")
    return rows.withColumns({"newa": F.coalesce("_na", "a"), "newb": F.coalesce("_nb", "b")}).drop("_na", "_nb")
