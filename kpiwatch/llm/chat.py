"""Tool-call linking for chats. DataFrame functions only.

`link` takes calls and results as rows, joins them by (conversation, identifier), orders them by
dependency, validates the calls' arguments against a schema for each tool, and writes one canonical
JSON object for each call with its result.

* Order. A call may name one earlier call that it comes `after`. Its level is the number of calls
  before it on that chain, found by pointer doubling: after i rounds each call knows its ancestor
  2^i calls back, so a chain of n calls takes log2(n) joins, and no task holds a conversation. Calls whose
  chain never ends are in a cycle and have no level. (level, turn, call_id) is a topological order.
* Schemas. A tool has fields with a type, an inclusive range (of the value, or of a text's length)
  and a required flag. Unknown tools, malformed JSON, missing, mistyped, out-of-range and unknown
  fields are told apart.
* Canonical JSON. Keys are sorted, nothing is padded, and fields that are absent are left out, so equal
  objects are equal texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut


@dataclass(frozen=True)
class Field:
    name: str
    type: str  # long, double, boolean or string
    least: float | None = None
    most: float | None = None
    required: bool = True


Schemas = dict[str, tuple[Field, ...]]


def _typed(raw: Column, f: Field) -> Column:
    """A field's JSON text as its type; null where it has another one."""
    text = raw.getItem(f.name)
    if f.type == "string":
        return text
    form = {"long": r"^-?(0|[1-9][0-9]*)$", "double": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$", "boolean": "^(true|false)$"}[f.type]
    return F.when(text.rlike(form), text.try_cast(f.type))


def _fault(raw: Column, fields: tuple[Field, ...]) -> Column:
    """The first thing wrong with parsed arguments, by field name; null if nothing is."""
    faults = []
    for f in sorted(fields, key=lambda f: f.name):
        there, value = raw.getItem(f.name).isNotNull(), _typed(raw, f)
        measure = F.char_length(value) if f.type == "string" else value
        if f.required:
            faults.append(F.when(~there, F.lit(f"missing {f.name}")))
        faults.append(F.when(there & value.isNull(), F.lit(f"type of {f.name}")))
        if f.type != "boolean":
            low = F.lit(False) if f.least is None else measure < f.least
            high = F.lit(False) if f.most is None else measure > f.most
            faults.append(F.when(there & (low | high), F.lit(f"range of {f.name}")))
    known = F.array(*(F.lit(f.name) for f in fields))
    other = F.array_sort(F.array_except(F.map_keys(raw), known))
    faults.append(F.when(F.size(other) > 0, F.concat(F.lit("unknown "), F.get(other, 0))))
    return F.coalesce(*faults)


def validated(calls: DataFrame, schemas: Schemas) -> DataFrame:
    """`calls` with `fault` (null: valid) and `args` (canonical JSON of the known fields; null unless valid)."""
    # As a map of texts, numbers keep their spelling, and a wrong type is no parse error.
    raw = F.from_json("arguments", "map<string,string>", {"allowNumericLeadingZeros": "false"})
    fault = F.when(F.col("__raw").isNull(), F.lit("not an object"))
    chosen, args = F.lit("unknown tool"), F.lit(None).cast("string")
    for name, fields in sorted(schemas.items()):
        of = F.col("name") == name
        chosen = F.when(of, _fault(F.col("__raw"), fields)).otherwise(chosen)
        obj = F.struct(*(_typed(F.col("__raw"), f).alias(f.name) for f in sorted(fields, key=lambda f: f.name)))
        args = F.when(of, F.to_json(obj)).otherwise(args)
    fault = F.coalesce(fault, chosen)
    return calls.withColumn("__raw", raw).withColumn("fault", fault).withColumn("args", F.when(F.col("fault").isNull(), args)).drop("__raw")


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: how many calls stand before a call on its chain; null in a cycle.

    A call that comes after one that doesn't exist starts a chain. Calls are told apart by their
    identifier; of several with one, the earliest turn's `after` counts.
    """
    first = F.min(F.struct(F.col("turn"), F.col("after"))).alias("f")
    nodes = calls.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(first).select("conv_id", "call_id", "f.after")
    ids = nodes.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    known = nodes.join(ids, nodes.conv_id.eqNullSafe(ids.c) & (nodes.after == ids.i), "left")
    steps = cut(known.select("conv_id", "call_id", F.col("i").alias("back"), F.col("i").isNotNull().cast("long").alias("level")))
    open_before = None
    while True:
        still = steps.filter("back IS NOT NULL").count()
        # A round that frees no call of its pointer, past the length of the longest chain, leaves cycles only.
        if still == 0 or still == open_before:
            break
        open_before = still
        other = steps.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("back").alias("far"), F.col("level").alias("more"))
        both = steps.join(other, steps.conv_id.eqNullSafe(other.c) & (steps.back == other.i), "left")
        steps = cut(both.select("conv_id", "call_id", F.col("far").alias("back"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")))
    return steps.select("conv_id", "call_id", F.when(F.col("back").isNull(), F.col("level")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """conv_id, call_id, turn, level, status, fault, json: one row per call, and one per result without a call.

    `calls` has conv_id, call_id, turn, name, arguments (JSON text), after; `results` has conv_id,
    call_id, turn, content. Of several results of a call, the earliest turn's (then the smallest content) counts.
    status: ok, invalid (see fault), cycle, no result, no call. A null identifier links with nothing.
    json is null unless the status is ok. Repeated calls give a row each. Empty tables give empty results.
    """
    least = F.min(F.struct("turn", "content")).alias("r")
    answer = results.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(least)
    answer = answer.select(F.col("conv_id").alias("rc"), F.col("call_id").alias("ri"), F.col("r.content").alias("content"), F.lit(True).alias("answered"))
    deep = levels(calls).select(F.col("conv_id").alias("lc"), F.col("call_id").alias("li"), "level")
    c = validated(calls.select("conv_id", "call_id", "turn", "name", "arguments", "after"), schemas)
    c = c.join(answer, c.conv_id.eqNullSafe(answer.rc) & (c.call_id == answer.ri), "left")
    c = c.join(deep, c.conv_id.eqNullSafe(deep.lc) & (c.call_id == deep.li), "left")
    status = (
        F.when(F.col("fault").isNotNull(), "invalid")
        .when(F.col("call_id").isNotNull() & F.col("level").isNull(), "cycle")
        .when(F.col("answered").isNull(), "no result")
        .otherwise("ok")
    )
    c = c.withColumn("status", status)
    q = lambda x: F.expr(f"to_json(struct({x} AS x))")
    value = lambda x: F.coalesce(F.regexp_extract(q(x), r"(?s)^\{\"x\":(.*)\}$", 1), F.lit("null"))
    text = lambda x: F.when(F.col(x).isNull(), F.lit("null")).otherwise(value(x))
    json = F.concat(
        F.lit('{"arguments":'), F.col("args"), F.lit(',"id":'), text("call_id"), F.lit(',"level":'), F.col("level").cast("string"),
        F.lit(',"name":'), text("name"), F.lit(',"result":'), text("content"), F.lit("}"),
    )
    linked = c.select("conv_id", "call_id", "turn", "level", "status", "fault", F.when(F.col("status") == "ok", json).alias("json"))
    ids = calls.filter("call_id IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("call_id").alias("i")).distinct()
    r = results.select("conv_id", "call_id", "turn")
    lone = r.join(ids, r.conv_id.eqNullSafe(ids.c) & (r.call_id == ids.i), "left_anti")
    none = F.lit(None).cast("string")
    return linked.unionByName(lone.select("conv_id", "call_id", "turn", F.lit(None).cast("long").alias("level"), F.lit("no call").alias("status"), none.alias("fault"), none.alias("json")))


#: The two tools that user turns of `conversations` are read as calls of.
REPLY: Schemas = {
    "long_reply": (Field("text", "string", 1), Field("turn", "long", 0), Field("words", "long", 21, 200)),
    "short_reply": (Field("text", "string", 1), Field("turn", "long", 0), Field("words", "long", 1, 20)),
}


def calls_of(chat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a chat table (conv_id, turn, role, text).

    A user turn calls for a reply, after the user's last call in the two turns before; an assistant
    turn is the result for the turn just before it. Rows without conv_id or turn, and other roles, are neither.
    """
    rows = chat.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).cast("long")
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("t"), turn.cast("string"))
    user = rows.filter("role = 'user'").withColumn("words", words)
    calls = user.select(
        "conv_id", name(F.col("turn")).alias("call_id"), "turn", F.when(F.col("words") <= 20, "short_reply").otherwise("long_reply").alias("name"),
        F.to_json(F.struct("words", "turn", "text")).alias("arguments"), name(F.col("turn") - 2).alias("after"),
    )
    results = rows.filter("role = 'assistant'").select("conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results
