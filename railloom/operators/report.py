"""Change report: one sentence per applied edit, ordered by scenario, period and section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import line_group, number_text

# Sections in report order.
SECTIONS = (
    (1, "### O'HARE PEOPLE MOVER EXTENSION ###"), (2, "### NEW ROUTES {tod} ###"), (3, "### CBD TERMINUS SHIFT {tod} ###"),
    (4, "### TRAVEL TIME REDUCTIONS {tod} ###"), (5, "### NEW STATIONS {tod} ###"),
    (6, "### NEW CONSOLIDATED STATIONS {tod} ###"), (7, "### LINE EXTENSIONS {tod} ###"),
)


def _text(*parts: Column | str) -> Column:
    """Literal texts as str, values as columns; values carry a blank behind them."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(".")) for p in parts]
    return F.concat(*cols)


def _rows(df: DataFrame, section: int, message: Column, tod: Column | None = None) -> DataFrame:
    tod = F.lit(0) if tod is None else tod
    return df.select("scenario", tod.cast("int").alias("tod"), F.lit(section).alias("section"), message.alias("message"))


def mover_report(closed: DataFrame) -> DataFrame:
    msg = _text("--> removed scenario = ", F.col("open_in"), " people mover link anode = ", F.col("a"), " bnode = ", F.col("b"), " from network")
    return _rows(closed, 1, msg)


def new_route_report(routes: DataFrame) -> DataFrame:
    return _rows(routes, 2, _text("--> ", F.col("descr"), " : added route ", F.col("tr_line")), F.col("tod"))


def shift_report(routes: DataFrame) -> DataFrame:
    return _rows(routes, 3, _text("--> ", F.col("descr"), " : shifted ", line_group("tr_line"), " CBD terminus"), F.col("tod"))


def time_report(rows: DataFrame) -> DataFrame:
    """Segments get their own sentence, a line cut as a whole (layover 99) one."""
    ln, pct = line_group("tr_line"), number_text(F.col("trv_time") * 100)
    one = _text("--> ", F.col("descr"), " : reduced ", ln, " travel time from ", F.col("itin_a"), " to ", F.col("itin_b"), " by ", pct, " percent")
    whole = _text("--> ", F.col("descr"), " : reduced ", ln, " travel time along entire line by ", pct, " percent")
    is_whole = F.coalesce(F.col("layover") == "99", F.lit(False))
    parts = _rows(rows.filter(~is_whole), 4, one, F.col("tod"))
    return parts.unionByName(_rows(rows.filter(is_whole), 4, whole, F.col("tod")).distinct())


def station_report(rows: DataFrame) -> DataFrame:
    msg = _text("--> ", F.col("descr"), " : added new ", F.col("ln"), " station at ", F.col("new"), " between itin_a = ", F.col("itin_a"), " and itin_b = ", F.col("itin_b"))
    return _rows(rows, 5, msg, F.col("tod"))


def consolidation_report(rows: DataFrame) -> DataFrame:
    msg = _text(
        "--> ", F.col("descr"), " : consolidated ", F.col("ln"), " stations between itin_a = ", F.col("start_node"),
        " and itin_b = ", F.col("end_node"), " into new station at ", F.col("new"),
    )
    return _rows(rows, 6, msg, F.col("tod"))


def extension_report(routes: DataFrame) -> DataFrame:
    return _rows(routes, 7, _text("--> ", F.col("descr"), " : extended ", line_group("tr_line")), F.col("tod"))


def section_titles(report: DataFrame) -> DataFrame:
    """Title rows of the sections that occur."""
    keys = report.select("scenario", "tod", "section").distinct()
    title = F.element_at(F.create_map(*[x for n, s in SECTIONS for x in (F.lit(n), F.lit(s))]), F.col("section"))
    return keys.withColumn("message", F.replace(title, F.lit("{tod}"), F.col("tod").cast("string")))


def change_report(*parts: DataFrame) -> DataFrame:
    """(scenario, tod, section, seq, message): titles are seq 0, sentences 1."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    titled = section_titles(rows).withColumn("seq", F.lit(0)).unionByName(rows.withColumn("seq", F.lit(1)))
    return titled.select("scenario", "tod", "section", "seq", "message")
