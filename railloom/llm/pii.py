"""Personal data and information-theoretic sanitisation.

Emails, addresses of machines, card and phone numbers are found by pattern. Corpus co-occurrence then says how far the words
of texts that hold such an entity give it away: a term t leaves -log2 p(c | t) bits of doubt about entity c, which is
IC(c) - PMI(t; c), with p from the numbers of texts that hold t and c and that hold t. Terms that leave little doubt are generalised,
those that leave next to none are removed, wherever they stand in the corpus. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, keyed, numbered, settled, stash, table

# The patterns of the four kinds. A match of the first two can only begin where its run of characters does or the
# last match ended, which the lookbehind says, so that long runs are not tried at every place; ++ keeps long matches off the stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
SUPPORT = 3  # different texts in which a term must stand together with an entity
SALTS = 16
DOUBT_BITS = 1.0  # a term that leaves no more doubt than this is generalised
GONE_BITS = 0.2  # and one that leaves no more than this is removed
_SPAN = "array<struct<start:long,rank:int,end:long,kind:string,value:string>>"
_WORD = r"[\p{L}\p{N}]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    n = F.length(_digits(value))
    return n.between(9, 15) if kind == "phone" else F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)


def _located(found: Column, gaps: Column, keep, make, kind: str) -> Column:
    """Matches with their places: `gaps` are the lengths of what stands before each match since the last one."""

    def add(acc, step):
        start = acc["at"] + step["gap"]
        end = start + F.length(step["value"])
        spans = F.when(keep(step["value"]), F.concat(acc["spans"], F.array(make(start, end, step["value"])))).otherwise(acc["spans"])
        return F.struct(end.cast("long").alias("at"), spans.cast(kind).alias("spans"))

    steps = F.transform(found, lambda v, i: F.struct(F.element_at(gaps, i + 1).alias("gap"), v.alias("value")))
    return F.aggregate(steps, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("spans")), add, lambda acc: acc["spans"])


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds `base`: spans (start, rank, end, kind, value) of `text` in code points, by start, then kind. Null: no spans."""
    body = F.coalesce(F.col(text), F.lit(""))
    for kind, pattern in PATTERNS.items():
        there = F.contains(body, F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
        found = F.when(there, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        df = df.withColumn(f"_m_{kind}", found)
        gaps = F.when(F.size(f"_m_{kind}") > 0, F.transform(F.split(body, pattern, -1), F.length)).otherwise(F.array().cast("array<int>"))
        df = df.withColumn(f"_g_{kind}", gaps)
    own = []
    for rank, kind in enumerate(PATTERNS):

        def make(start, end, value, rank=rank, kind=kind):
            return F.struct(start.cast("long").alias("start"), F.lit(rank).alias("rank"), end.cast("long").alias("end"), F.lit(kind).alias("kind"), value.alias("value"))

        own.append(_located(F.col(f"_m_{kind}"), F.col(f"_g_{kind}"), lambda v, kind=kind: _holds(kind, v), make, _SPAN))
    return df.withColumn("base", F.array_sort(F.concat(*own))).drop(*(f"_{x}_{k}" for k in PATTERNS for x in "mg"))


def _entities() -> Column:
    """The names of the base spans."""
    name = lambda s: F.concat_ws(":", s["kind"], F.when(s["kind"].isin("card", "phone"), _digits(s["value"])).otherwise(F.lower(s["value"])))
    return F.array_distinct(F.transform("base", name))


def _outside(text: str) -> Column:
    """The text with blanks over its base spans, so that places stay what they are."""

    def add(acc, s):
        # Spans may overlap; what is blank stays so.
        start = F.greatest(s["start"], acc["at"])
        kept = F.substring(F.col(text), (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int"))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - start, F.lit(0)).cast("int"))
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.concat(acc["out"], kept, blank).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.length(text)))
    whole = F.aggregate("base", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), add, rest)
    return F.when(F.size("base") > 0, whole).otherwise(F.coalesce(F.col(text), F.lit("")))


def disclosures(found: DataFrame) -> DataFrame:
    """term, doubt (bits) of the terms that give an entity away, from one row per text: `entities`, `terms` (distinct), `body` (a hash of the text).

    Copies of one text count as one support, so that a repeated document discloses nothing by itself.
    """
    with_ = found.filter(F.size("entities") > 0).select("body", F.explode("entities").alias("entity"), "terms")
    here = with_.select("body", "entity", F.explode("terms").alias("term")).groupBy("entity", "term", "body").agg(F.count("*").alias("n"))
    pairs = here.groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count("*").alias("support")).filter(F.col("support") >= SUPPORT)
    all_ = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("alone"))
    doubt = -F.log2(F.least(F.col("together") / F.col("alone"), F.lit(1.0)))
    close = pairs.join(all_, "term").select("term", doubt.alias("doubt")).filter(F.col("doubt") <= DOUBT_BITS)
    return close.groupBy("term").agg(F.min("doubt").alias("doubt"))


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """rid, doc_id, base, added (spans of disclosing terms with their doubt in bits) for each row of a stored table.

    Entities and terms are counted together over whole texts, and a term that gives an entity away is found wherever it stands, also
    in texts without the entity. rid tells rows apart that share an id or have none. Null and empty texts have no spans; repeated
    rows get the same spans; an empty table gives no rows; other columns are left out. Added spans never overlap base spans.
    """
    rows = keyed(docs, doc_id=doc_id, text=text)
    terms = F.array_distinct(F.transform(F.regexp_extract_all(_outside("text"), F.lit(_WORD), F.lit(0)), F.lower))
    found = stash(base_spans(rows, "text").select("rid", "doc_id", "base", _entities().alias("entities"), terms.alias("terms"), F.xxhash64("text").alias("body")), "spans")
    telling = stash(disclosures(found), "terms")
    # Salted, as a term may stand in a great part of the texts.
    salted = telling.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = stash(found.select("rid", F.explode("terms").alias("term")).withColumn("salt", F.pmod("rid", F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"]).select("rid", "term", "doubt"), "met")
    hit = rows.select("rid", "text").join(met.select("rid").distinct(), "rid").join(found.select("rid", "base"), "rid").select("rid", _outside("text").alias("outside"))
    # Places are running sums over a text's words, and words meet their terms by a join: both in proportion to the text.
    words = F.arrays_zip(F.regexp_extract_all("outside", F.lit(_WORD), F.lit(0)).alias("word"), F.transform(F.split("outside", _WORD, -1), F.length).alias("gap"))
    each = hit.select("rid", F.posexplode(words).alias("k", "w")).filter("w.word IS NOT NULL").select("rid", "k", F.lower("w.word").alias("term"), F.length("w.word").cast("long").alias("n"), "w.gap")
    ends = each.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("rid").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    added = F.struct((F.col("end") - F.col("n")).alias("start"), "end", "doubt")
    per_row = ends.join(met, ["rid", "term"]).groupBy("rid").agg(F.array_sort(F.collect_list(added)).alias("added"))
    return found.select("rid", "doc_id", "base").join(per_row, "rid", "left").select("rid", "doc_id", "base", F.coalesce("added", F.array()).alias("added"))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs`, a stored table, with spans replaced in its text column: base spans by their kind, terms by their shape or nothing.

    All columns and rows are kept; null texts stay null. Of spans that overlap the first holds.
    """
    docs = settled(docs)
    spans = find_spans(docs, doc_id, text)
    rid, cut = fresh(docs, "_rid"), fresh(docs, "_spans")
    body = F.col(f"`{text}`")
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.concat(F.lit("<"), F.upper(b["kind"]), F.lit(">")).alias("label"), F.lit(False).alias("term")))
    added = F.transform("added", lambda a: F.struct(a["start"].alias("start"), a["end"].alias("end"), F.when(a["doubt"] <= GONE_BITS, "").alias("label"), F.lit(True).alias("term")))
    chosen = spans.filter((F.size("base") > 0) | (F.size("added") > 0)).select(F.col("rid").alias(rid), F.array_sort(F.concat(base, added)).alias(cut))
    joined = numbered(docs, rid).join(chosen, rid, "left")

    def shape(word):
        return F.when(F.regexp_like(word, F.lit(r"^\p{N}+$")), "<NUMBER>").when(F.regexp_like(word, F.lit(r"^\p{Lu}")), "<NAME>").otherwise("<TERM>")

    def piece(start, end):
        return F.substring(body, (start + 1).cast("int"), (end - start).cast("int"))

    def add(acc, s):
        label = F.coalesce(s["label"], shape(piece(s["start"], s["end"])))
        grown = F.struct(s["end"].cast("long").alias("at"), F.concat(acc["out"], piece(acc["at"], s["start"]), label).alias("out"))
        return F.when(s["start"] >= acc["at"], grown).otherwise(acc)

    clean = F.aggregate(cut, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), add, lambda acc: F.concat(acc["out"], piece(acc["at"], F.length(body).cast("long"))))
    fixed = F.when(F.size(cut) > 0, clean).otherwise(body)
    return joined.withColumn(cut, F.coalesce(cut, F.array())).select(*(fixed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))


def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    terms = F.transform("added", lambda a: F.struct(a["start"].alias("start"), F.lit(len(PATTERNS)).alias("rank"), a["end"].alias("end"), F.lit("term").alias("kind"), F.lit("").alias("value")))
    counted = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("base", terms.cast(_SPAN)))
    return found.select(
        "doc_id",
        *(counted(k) for k in PATTERNS),
        F.sha2(F.array_join(F.transform("base", said), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(every, said), ",").alias("spans"),
    )
