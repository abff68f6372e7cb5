"""Column functions with the missing-value and rounding rules of the network tables.

A missing number sorts below every value, so `missing < v` holds. Rounding is half away from zero
and forgives the last binary digits (0.285 -> 0.29).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period of day, first hour, hour after the last, length in minutes.
PERIODS = ((1, 18, 6, 720), (2, 6, 9, 180), (3, 9, 16, 420), (4, 16, 18, 120))
MAX_ZONE = 3649
DROP_NODE = 48007
NO_STOP_NODE = 48006
PEAK_START = 25200
PEAK_END = 32400


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: Column | str, digits: int) -> Column:
    c, unit = as_col(c), float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(unit) + F.lit(0.5) + F.lit(1e-9)) / F.lit(unit) + F.lit(0.0)


def lt_missing(c: Column | str, v) -> Column:
    return F.coalesce(as_col(c) < v, F.lit(True))


def le_missing(c: Column | str, v) -> Column:
    return F.coalesce(as_col(c) <= v, F.lit(True))


def zero_if_missing(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


# --- text ---------------------------------------------------------------------------------------


def strip_chars(c: Column | str, chars: str) -> Column:
    """Remove every character of `chars`."""
    return F.translate(as_col(c), chars, "")


def token(c: Column | str, n: int | Column, delims: str) -> Column:
    """n-th token; runs of delimiters count as one and none at the ends; missing when absent."""
    cls = "[" + "".join("\\" + d for d in delims) + "]+"
    parts = F.filter(F.split(as_col(c), cls), lambda t: t != "")
    n = F.lit(n) if isinstance(n, int) else n
    return F.try_element_at(parts, n)


def first_n(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def count_char(c: Column | str, ch: str) -> Column:
    c = as_col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def first_digit_pos(c: Column | str) -> Column:
    return F.regexp_instr(as_col(c), F.lit("[0-9]"))


def has_code(c: Column | str, code: str | Column) -> Column:
    """Set membership in a digit string such as '1234'."""
    return F.coalesce(as_col(c).contains(code), F.lit(False))


def clock_text(seconds: Column | str) -> Column:
    """h:mm AM/PM of a second of day that may run past midnight."""
    s = F.pmod(as_col(seconds), F.lit(86400))
    hour = F.floor(s / 3600)
    h12 = F.when(F.pmod(hour, F.lit(12)) == 0, 12).otherwise(F.pmod(hour, F.lit(12)))
    minute = F.floor(F.pmod(s, F.lit(3600)) / 60)
    return F.concat(
        h12.cast("string"),
        F.lit(":"),
        F.lpad(minute.cast("string"), 2, "0"),
        F.when(hour >= 12, " PM").otherwise(" AM"),
    )


def start_hour(seconds: Column | str) -> Column:
    return F.floor(as_col(seconds) / 3600).cast("int")


def is_pm(seconds: Column | str) -> Column:
    return F.pmod(as_col(seconds), F.lit(86400)) >= 43200


# --- coded strings ------------------------------------------------------------------------------


def _pairs(c: Column) -> Column:
    parts = F.split(c, ":")
    starts = F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2))
    return F.transform(
        starts,
        lambda i: F.struct(
            F.try_element_at(parts, i).alias("k"),
            F.try_element_at(parts, i + F.lit(1)).try_cast("double").alias("v"),
        ),
    )


def period_value(c: Column | str, tod: str | Column) -> Column:
    """'p:v:p:v' keyed by digit sets of periods, last match wins; a plain number holds always."""
    c = as_col(c)
    code = F.lit(tod) if isinstance(tod, str) else tod.cast("string")
    hits = F.filter(_pairs(c), lambda p: p["k"].contains(code))
    return F.when(F.instr(c, ":") == 0, c.try_cast("double")).otherwise(F.try_element_at(hits, F.lit(-1))["v"])


def scenario_value(c: Column | str, scenario: int | Column, default: Column) -> Column:
    """'s:v:s:v' step function: value of the largest s (above 0) not after the scenario."""
    c = as_col(c)
    scen = F.lit(scenario) if isinstance(scenario, int) else scenario
    steps = F.transform(_pairs(c), lambda p: F.struct(p["k"].try_cast("int").alias("s"), p["v"].alias("v")))
    hits = F.filter(steps, lambda p: (p["s"] <= scen) & (p["s"] > 0))
    best = F.aggregate(
        hits,
        F.struct(F.lit(0).alias("s"), F.lit(None).cast("double").alias("v")),
        lambda acc, p: F.when(p["s"] > acc["s"], p).otherwise(acc),
    )
    found = F.instr(c, ":") > 0
    return F.when(found & (best["s"] > 0), best["v"]).otherwise(default)


# --- line names ---------------------------------------------------------------------------------

# Colour of the route and its line prefix.
COLOUR_PREFIX = (
    ("BLUE", "cbl"), ("BROWN", "cbr"), ("ORANGE", "cor"), ("PINK", "cpk"),
    ("PURPLE", "cpr"), ("RED", "crd"), ("YELLOW", "cye"),
)
# Fixed values, tested in this order: text in the feed line name, line prefix, railroad.
RAILROAD_PREFIX = (
    ("BNSF_", "mbn", "BNSF"), ("HC_", "mhc", "HC"), ("MD-N_", "mmn", "MD-N"), ("MD-W_", "mmw", "MD-W"),
    ("ME_", "mme", "ME"), ("NCS_", "mnc", "NCS"), ("RI_", "mri", "RI"), ("SWS_", "msw", "SWS"),
    ("UP-NW_", "mnw", "UP-NW"), ("UP-N_", "mun", "UP-N"), ("UP-W_", "muw", "UP-W"), ("shore", "mss", "SS"),
)


def _first_match(tests: list[tuple[Column, Column]]) -> Column:
    (c0, v0), rest = tests[0], tests[1:]
    return reduce(lambda acc, t: acc.when(*t), rest, F.when(c0, v0))


def line_prefix(mode: Column | str, route_id: Column | str, line: Column | str, description: Column | str) -> Column:
    mode, route_id, line, description = map(as_col, (mode, route_id, line, description))
    cta = [(route_id == colour, F.lit(p)) for colour, p in COLOUR_PREFIX]
    cta.append(((route_id == "GREEN") & description.contains("ASHLAND"), F.lit("cga")))
    cta.append((route_id == "GREEN", F.lit("cgc")))
    metra = [(line.contains(text), F.lit(p)) for text, p, _ in RAILROAD_PREFIX]
    return F.when(mode == "C", _first_match(cta)).when(mode == "M", _first_match(metra))


def railroad(line: Column | str) -> Column:
    line = as_col(line)
    return _first_match([(line.contains(text), F.lit(name)) for text, _, name in RAILROAD_PREFIX])


def run_number(line: Column | str) -> Column:
    line = as_col(line)
    from_digit = F.substr(line, F.greatest(first_digit_pos(line), F.lit(1)))
    raw = F.when(F.startswith(line, F.lit("metra")), token(line, 2, "_")).otherwise(from_digit)
    return F.regexp_replace(raw, "[A-Z]", "")


def run_description(mode, number: Column, road: Column, description: Column | str) -> Column:
    description = as_col(description)
    tail = F.replace(token(description, 2, "-"), F.lit(" METRA "), F.lit(""))
    metra = F.concat(F.trim(number), F.lit(" "), F.trim(road), F.lit(" -"), F.coalesce(F.rtrim(tail), F.lit("")))
    return F.when(as_col(mode) == "C", description).otherwise(metra)


def line_group(tr_line: Column | str) -> Column:
    return F.substring(as_col(tr_line), 1, 3)


def serial_name(prefix: Column | str, serial: Column | str) -> Column:
    return F.format_string("%s%03d", as_col(prefix), as_col(serial).cast("long"))


def revised_description(descr, tr_line, scenario, action: Column | str) -> Column:
    """Put s<scenario>a<action> behind ' -' for base runs; serials from 900 are new runs."""
    descr, action = as_col(descr), as_col(action)
    scen = F.lit(scenario) if isinstance(scenario, int) else scenario
    i = F.instr(descr, " -")
    tag = F.concat(F.lit("s"), scen.cast("string"), F.lit("a"), action.cast("string"))
    tail = F.substring(descr, i + 2, F.greatest(F.lit(15) - i, F.lit(0)))
    changed = F.concat(F.substring(descr, F.lit(1), i + 1), tag, tail)
    serial = F.substring(as_col(tr_line), 4, 3).try_cast("int")
    return F.when((action > 0) & (serial < 900), changed).otherwise(descr)


# --- coded numbers ------------------------------------------------------------------------------

# Dwell code and the sign before the dwell time.
DWELL_SIGN = (("1", "#"), ("2", ">"), ("3", "<"), ("4", "+"), ("5", "*"))


def dwell_time(dw_code: Column | str) -> Column:
    return F.when(as_col(dw_code) == "1", 0.0).otherwise(0.01)


def dwell_text(dw_code: Column | str, dw_time: Column | str) -> Column:
    code = as_col(dw_code)
    sign = F.coalesce(_first_match([(code == k, F.lit(s)) for k, s in DWELL_SIGN]), F.lit(""))
    return F.concat(F.lit("dwt="), sign, number_text(dw_time))


def number_text(c: Column | str) -> Column:
    """Shortest text of a number of at most two decimals: 0, 2.5, 0.01."""
    c = as_col(c).cast("double")
    text = F.format_string("%.2f", c)
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), "\\.$", "")


def zone_fare(cost_a: Column | str, cost_b: Column | str) -> Column:
    a, b = as_col(cost_a), as_col(cost_b)
    return F.coalesce(round_half_away(F.abs(a - b) / F.lit(40.0) * F.lit(100.0), 2), F.lit(0.0))


def path_weight(miles: Column | str, base: Column | None = None) -> Column:
    w = F.floor(F.round(as_col(miles) * 100, 6)).cast("long")
    if base is not None:
        w = w + F.when(base == 1, 0).otherwise(500)
    return F.greatest(w, F.lit(1).cast("long"))


def is_junction(node: Column | str) -> Column:
    node = as_col(node)
    return node.between(39001, 39999) | node.between(49001, 49999)


def time_of_day(hour: Column | str, periods=PERIODS) -> Column:
    """Period of a start hour; a period whose end lies before its start wraps midnight and takes missing."""
    hour = as_col(hour)
    tests = []
    for tod, lo, hi, _ in periods:
        test = (hour >= lo) & (hour < hi) if lo < hi else F.coalesce((hour >= lo) | (hour < hi), F.lit(True))
        tests.append((test, F.lit(tod)))
    return _first_match(tests)


def period_minutes(tod: Column | str, periods=PERIODS) -> Column:
    tod = as_col(tod)
    return _first_match([(tod == p, F.lit(float(m))) for p, _, _, m in periods])
