"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns, a template marks the turns reversibly.

The fingerprint of a row is a hash of the nested field paths that hold something in it. A layout lists its paths and says, as
columns, which turns they make. All of it is column expressions; no row passes through Python.

Template of a turn: `### role: text</turn>` and a line feed. Inside texts a backslash, `</turn>` and `##` are written with a
backslash, so that neither mark can stand there; roles are percent-encoded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .common import fresh, table

OPEN, CLOSE, BETWEEN = "### ", "</turn>\n", ": "
LEARNED = "assistant"
# Role names of common layouts and what they are called here.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]


def _said(items: str, role: str, text: str, named: bool = True) -> Callable[[], Column]:
    """One turn per item; `named`: roles get the names used here."""
    return lambda: F.transform(F.col(items), lambda m: _turn(m[role], m[text], named))


def _turn(role: Column, text: Column, named: bool = True) -> Column:
    name = F.coalesce(role.cast("string"), F.lit(""))
    known = F.lit(None).cast("string")
    for alias, own in ROLES.items() if named else ():
        known = F.when(name == alias, own).otherwise(known)
    return F.struct(F.coalesce(known, name).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _fields(**said: str) -> Callable[[], Column]:
    """One turn per field, as role=field."""
    return lambda: F.array(*(_turn(F.lit(role), F.col(field)) for role, field in said.items()))


def _asked(first: str, more: str, answer: str) -> Callable[[], Column]:
    return lambda: F.array(_turn(F.lit("user"), F.concat_ws("\n\n", F.col(first), F.col(more))), _turn(F.lit("assistant"), F.col(answer)))


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), _said("messages", "role", "content", named=False)),
    Layout("sharegpt", ("conversations[].from", "conversations[].value"), _said("conversations", "from", "value")),
    Layout("completion", ("prompt", "completion"), _fields(user="prompt", assistant="completion")),
    Layout("response", ("prompt", "response"), _fields(user="prompt", assistant="response")),
    Layout("system response", ("system", "prompt", "response"), _fields(system="system", user="prompt", assistant="response")),
    Layout("question", ("question", "answer"), _fields(user="question", assistant="answer")),
    Layout("instruction", ("instruction", "output"), _fields(user="instruction", assistant="output")),
    Layout("instruction input", ("instruction", "input", "output"), _asked("instruction", "input", "output")),
    Layout("prompt only", ("prompt",), _fields(user="prompt")),
)


def _paths(df: DataFrame, skip: set[str]) -> list[tuple[str, str]]:
    """(path, column) of every field, with those of structs in arrays behind `[]`."""
    out = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        inner = f.dataType
        if isinstance(inner, ArrayType) and isinstance(inner.elementType, StructType):
            out += [(f"{f.name}[].{x.name}", f.name) for x in inner.elementType.fields]
        else:
            out.append((f.name, f.name))
    return out


def canonical_turns(df: DataFrame, keys: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """keys, fingerprint (long), layout (string) and turns (array of role, text) of each row.

    A field counts when it is not null; other columns that no layout knows are left out of the fingerprint. Null texts and roles
    are empty. Rows that fit no layout, all-null ones too, keep null layout and turns, so that nothing is lost silently.
    Repeated rows stay repeated; an empty table gives an empty one.
    """
    wanted = {p for layout in layouts for p in layout.paths}
    own = [(p, c) for p, c in _paths(df, set(keys)) if p in wanted]
    mark = lambda paths: F.xxhash64(F.lit("\n".join(sorted(paths))))
    there = F.array(*(F.when(F.col(f"`{c}`").isNotNull(), F.lit(p)) for p, c in sorted(own))) if own else F.array().cast("array<string>")
    fingerprint = fresh(df, "fingerprint")
    marked = df.withColumn(fingerprint, F.xxhash64(F.array_join(F.array_compact(there), "\n")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    have = {p for p, _ in own}
    for x in layouts:
        if set(x.paths) <= have:
            fits = F.col(fingerprint) == mark(x.paths)
            layout = F.when(fits, x.name).otherwise(layout)
            turns = F.when(fits, x.turns().cast(TURNS)).otherwise(turns)
    return marked.select(*keys, F.col(fingerprint).alias("fingerprint"), layout.alias("layout"), turns.alias("turns"))


def escaped(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("</turn>", "<\\/turn>"), ("##", "#\\#")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(df: DataFrame, learned: str = LEARNED) -> DataFrame:
    """Adds `formatted` and `loss` (array of start, length in code points of the escaped texts of the learned role) to rows with `turns`.

    No turns give an empty string; null turns stay null.
    """
    head = lambda t: F.concat(F.lit(OPEN), F.url_encode(t["role"]), F.lit(BETWEEN))
    cut = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == learned).alias("learned")))
    spans = "array<struct<start:long,length:long>>"
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("spans"))

    def add(acc, p):
        start = acc["at"] + F.length(p["head"])
        body = F.length(p["body"]).cast("long")
        found = F.array(F.struct(start.alias("start"), body.alias("length")))
        return F.struct((start + body + len(CLOSE)).cast("long").alias("at"), F.when(p["learned"], F.concat(acc["spans"], found)).otherwise(acc["spans"]).cast(spans).alias("spans"))

    cut_name = fresh(df, "cut")
    return (
        df.withColumn(cut_name, cut)
        .withColumn("formatted", F.array_join(F.transform(cut_name, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), ""))
        .withColumn("loss", F.aggregate(cut_name, begin, add, lambda acc: acc["spans"]))
        .drop(cut_name)
    )


def parse(formatted: Column) -> Column:
    """Turns of a formatted text."""
    blocks = F.split(formatted, CLOSE, -1)
    whole = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turn(block):
        role = F.substring_index(block, BETWEEN, 1)
        body = F.substring(block, F.length(role) + len(BETWEEN) + 1, F.length(block))
        return F.struct(F.url_decode(F.substring(role, F.lit(len(OPEN) + 1), F.length(role))).alias("role"), unescaped(body).alias("text"))

    return F.transform(whole, turn)


def under_mask(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def op2_schema_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as message lists, conversation -7 in a second layout."""
    rows = table(spark, sf_dir, "conversations")
    said = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    records = rows.groupBy("conv_id").agg(F.transform(said, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))
    trap = r"\### Assistant: </turn> ok"
    one = spark.createDataFrame([(-7, [("human", trap), ("gpt", trap)])], "conv_id long, conversations array<struct<from:string,value:string>>")
    formatted = format_turns(canonical_turns(records.unionByName(one, allowMissingColumns=True), ["conv_id"]))
    back = formatted.select("conv_id", "layout", "formatted", "loss", parse(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss")).alias("learned"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, r, t), '')) AS loss_sha256,
  sum(6 + length(role) + 8 + length(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
