"""Tool-call linking: join calls with results, order them by their dependencies, validate arguments, write canonical JSON.

Calls and results meet in a hash join on (conversation, call id), so one huge conversation spreads over all tasks. A
dependency on an earlier call is kept by the order of turns alone; only references to the same or a later turn need
work. The turns such references span, merged where they overlap, are *knots*; a call outside every knot stays at its turn,
and each knot is ordered by itself by level (longest path from a call without open dependencies), then turn. Knots of more than
``knot_limit`` calls are ordered by rounds of joins instead of in one task, with the same result. Running maxima and positions
within a conversation are computed by blocks of turns, so no task needs a whole conversation.
"""

from __future__ import annotations

import json
import math
import re
import sys

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowprism.llm.common import batches, cut, join_checked, table

#: Turns in a block, and calls of a knot that one task may order.
TURNS, KNOT_LIMIT = 4096, 20_000
#: Assumed width of a conversation and call id when their size is checked for a broadcast.
ID_BYTES = 128


_LONE = re.compile("[\ud800-\udfff]")


def _escaped(text: str) -> str:
    """Lone surrogates, which UTF-8 cannot hold, as JSON escapes."""
    return _LONE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical(x) -> str:
    """JSON with sorted keys (by UTF-16 units), no blanks, shortest numbers and no needless escapes (lone surrogates are escaped)."""
    if isinstance(x, dict):
        keys = sorted(x, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(_escaped(json.dumps(k, ensure_ascii=False)) + ":" + canonical(x[k]) for k in keys) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(canonical, x)) + "]"
    if isinstance(x, float):
        if not math.isfinite(x):
            raise ValueError("not a JSON number")
        if x.is_integer() and abs(x) < 1e21:
            return str(int(x))
        m, _, e = repr(x).partition("e")
        return f"{m}e{int(e):+d}" if e else m
    return _escaped(json.dumps(x, ensure_ascii=False))


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(x, kind: str) -> bool:
    if kind in ("integer", "number"):
        return not isinstance(x, bool) and (isinstance(x, int) or isinstance(x, float) and (kind == "number" or x.is_integer()))
    return isinstance(x, _TYPES[kind])


def violations(x, schema: dict, at: str = "$") -> list[str]:
    """What of ``schema`` (type, enum, const, minimum, maximum, minLength, maxLength, properties, required,
    additionalProperties, items, minItems, maxItems) ``x`` breaks, as "path keyword"."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(x, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at} type"]
    out = []
    if "enum" in schema and not any(type(x) is type(v) and x == v for v in schema["enum"]):
        out.append(f"{at} enum")
    if "const" in schema and not (type(x) is type(schema["const"]) and x == schema["const"]):
        out.append(f"{at} const")
    if _is(x, "number"):
        out += [f"{at} {k}" for k, bad in (("minimum", x < schema.get("minimum", x)), ("maximum", x > schema.get("maximum", x))) if bad]
    for kind, low, high in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(x, kind):
            out += [f"{at} {k}" for k, bad in ((low, len(x) < schema.get(low, 0)), (high, len(x) > schema.get(high, len(x)))) if bad]
    if isinstance(x, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{_escaped(k)} required" for k in schema.get("required", []) if k not in x]
        for k in sorted(x):
            rule = known.get(k, schema.get("additionalProperties", True))
            if rule is False:
                out.append(f"{at}.{_escaped(k)} additionalProperties")
            elif isinstance(rule, dict):
                out += violations(x[k], rule, f"{at}.{_escaped(k)}")
    if isinstance(x, list) and isinstance(schema.get("items"), dict):
        for i, v in enumerate(x):
            out += violations(v, schema["items"], f"{at}[{i}]")
    return out


def _no_constant(name: str):
    raise ValueError(name)


class _Repeated(ValueError):
    pass


def _once(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise _Repeated
    return out


def check_arguments(name: str | None, arguments: str | None, schemas: dict) -> tuple[str | None, list[str]]:
    """(canonical arguments or None, errors) of one call.

    Text that is no JSON, or an object that holds a key twice (no canonical form keeps both values), has no canonical form and
    stays as it is; lone surrogates are kept as escapes and reported; whole numbers have no limit of digits.
    """
    sys.set_int_max_str_digits(0)
    try:
        x = json.loads(arguments or "", parse_constant=_no_constant, object_pairs_hook=_once)
        text = canonical(x)
    except _Repeated:
        return None, ["$ repeated key"]
    except (ValueError, RecursionError):
        return None, ["$ json"]
    errors = violations(x, schemas[name]) if name in schemas else ["$ tool"]
    return text, errors + ["$ surrogate"] * bool(re.search(r"\\ud[89a-f]", text) and _has_lone(x))


def _has_lone(x) -> bool:
    if isinstance(x, dict):
        return any(_has_lone(k) or _has_lone(v) for k, v in x.items())
    return any(map(_has_lone, x)) if isinstance(x, list) else isinstance(x, str) and bool(_LONE.search(x))


def _running_max(df: DataFrame, key: str, order: list[Column], block: str, value: str, out: str) -> DataFrame:
    """``out``: the largest ``value`` of the rows up to this one in its conversation; within blocks, then over blocks."""
    tops = df.groupBy(key, block).agg(F.max(value).alias("_top"))
    earlier = tops.select(key, block, F.max("_top").over(Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    w = Window.partitionBy(key, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(earlier, [key, block]).withColumn(out, F.greatest(F.max(value).over(w), "_earlier")).drop("_earlier")


def _levels(part: pd.DataFrame) -> pd.DataFrame:
    """Levels of one knot's calls: longest path of dependencies within it; -1 for calls on or behind a cycle."""
    ids = part["call_id"].tolist()
    here = set(ids)
    needs = {c: {d for d in (ds if ds is not None else ()) if d in here} for c, ds in zip(ids, part["needs"])}
    used = {}
    for c, ds in needs.items():
        for d in ds:
            used.setdefault(d, []).append(c)
    open_ = {c: len(ds) for c, ds in needs.items()}
    level, todo = {c: 0 for c in ids if not open_[c]}, [c for c in ids if not open_[c]]
    for c in todo:
        for u in used.get(c, ()):
            open_[u] -= 1
            level[u] = max(level.get(u, 0), level[c] + 1)
            if not open_[u]:
                todo.append(u)
    done = set(todo)
    return pd.DataFrame({"conv": part["conv"], "call_id": ids, "level": [level[c] if c in done else -1 for c in ids]})


def _levels_by_rounds(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """The same for (conv, knot, call_id) of any size: each round takes the calls whose dependencies are all taken."""
    same = needs.join(calls.select("conv", F.col("call_id").alias("need"), "knot"), ["conv", "need"]) \
        .join(calls.select("conv", "call_id", F.col("knot").alias("own")), ["conv", "call_id"]).filter("knot = own").select("conv", "call_id", "need")
    edges, left, out, level = cut(same), cut(calls.select("conv", "call_id")), None, 0
    while left.head(1):
        blocked = edges.select("conv", "call_id").distinct()
        ready = cut(left.join(blocked, ["conv", "call_id"], "left_anti"))
        if not ready.head(1):
            rest = left.select("conv", "call_id", F.lit(-1).alias("level"))
            return rest if out is None else out.union(rest)
        found = ready.select("conv", "call_id", F.lit(level).alias("level"))
        out = found if out is None else out.union(found)
        left = cut(left.join(ready, ["conv", "call_id"], "left_anti"))
        edges = cut(edges.join(ready.select("conv", F.col("call_id").alias("need")), ["conv", "need"], "left_anti"))
        level += 1
    return out if out is not None else left.select("conv", "call_id", F.lit(0).alias("level"))


def ordered(calls: DataFrame, needs: DataFrame, knot_limit: int = KNOT_LIMIT) -> DataFrame:
    """(conv, call_id, turn; distinct ids) and (conv, call_id, need) -> calls with ``at``, ``level``: sorting a conversation by
    (at, level = -1, level, turn, call_id) puts every call behind those it needs; level -1 marks cycles."""
    calls = calls.withColumn("block", F.floor(F.col("turn") / TURNS))
    spans = (needs.join(calls.select("conv", "call_id", F.col("turn").alias("start")), ["conv", "call_id"])
             .join(calls.select("conv", F.col("call_id").alias("need"), F.col("turn").alias("end")), ["conv", "need"])
             .filter("end >= start").groupBy("conv", "start").agg(F.max("end").alias("end")).withColumn("block", F.floor(F.col("start") / TURNS)))
    spans = cut(spans)
    if not spans.head(1):
        return calls.select("conv", "call_id", "turn", F.col("turn").alias("at"), F.lit(0).alias("level"))
    # a span opens a knot unless an earlier one reaches it
    seen = _running_max(spans.withColumn("reach", F.lag("end").over(Window.partitionBy("conv", "block").orderBy("start"))),
                        "conv", [F.col("start")], "block", "reach", "_within")
    tops = spans.groupBy("conv", "block").agg(F.max("end").alias("_top"))
    before = tops.select("conv", "block", F.max("_top").over(Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    opened = seen.join(before, ["conv", "block"]).withColumn("opens", F.coalesce(F.col("start") > F.greatest("_within", "_before"), F.lit(True)))
    events = (calls.select("conv", "block", "call_id", "turn", F.lit(None).cast("long").alias("end"), F.lit(None).cast("long").alias("open"), F.lit(1).alias("kind"))
              .unionByName(opened.select("conv", "block", F.lit(None).cast("string").alias("call_id"), F.col("start").alias("turn"), "end",
                                         F.when(F.col("opens"), F.col("start")).alias("open"), F.lit(0).alias("kind"))))
    order = [F.col("turn"), F.col("kind")]
    events = _running_max(events, "conv", order, "block", "end", "reach")
    events = _running_max(events, "conv", order, "block", "open", "knot").filter("kind = 1")
    placed = cut(events.select("conv", "call_id", "turn", F.when(F.col("reach") >= F.col("turn"), F.col("knot")).alias("knot")))
    loose = placed.filter("knot is null").select("conv", "call_id", "turn", F.col("turn").alias("at"), F.lit(0).alias("level"))
    tied = placed.filter("knot is not null")
    sizes = tied.groupBy("conv", "knot").count()
    tied = cut(tied.join(sizes, ["conv", "knot"]))
    small = tied.filter(F.col("count") <= knot_limit).join(needs, ["conv", "call_id"], "left") \
        .groupBy("conv", "knot", "call_id").agg(F.collect_set("need").alias("needs"))
    levels = small.groupBy("conv", "knot").applyInPandas(_levels, f"conv {calls.schema['conv'].dataType.simpleString()}, call_id string, level int")
    large = tied.filter(F.col("count") > knot_limit)
    if large.head(1):
        levels = levels.union(_levels_by_rounds(large, needs))
    return loose.unionByName(tied.join(levels, ["conv", "call_id"]).select("conv", "call_id", "turn", F.col("knot").alias("at"), "level"))


#: Columns of ``link``, and the errors of the rows that only ``link_all`` gives.
LINKED = ["conv", "call_id", "turn", "result_turn", "position", "name", "valid", "errors", "message", "raw"]
LATER, NULL_KEY = "later result", "null key"


def link(calls: DataFrame, results: DataFrame, schemas: dict, knot_limit: int = KNOT_LIMIT) -> DataFrame:
    """``link_all`` without its rows of "later result" and "null key": one row for each call and each result id without a call."""
    out = link_all(calls, results, schemas, knot_limit)
    return out.filter(~F.arrays_overlap("errors", F.array(F.lit(LATER), F.lit(NULL_KEY))))


def link_all(calls: DataFrame, results: DataFrame, schemas: dict, knot_limit: int = KNOT_LIMIT) -> DataFrame:
    """One row for each call and each result that is not in its call's row; every input row's content is in one of them.

    ``calls``: conv, turn (long), call_id, name, arguments (JSON text), needs (array of call ids); ``results``: conv, turn, call_id,
    content. Other columns are not read. Gives conv, call_id, turn, result_turn, position (from 0 without gaps, in dependency
    order within the conversation), name, valid, errors (array, sorted), message (canonical JSON with arguments, id, name,
    position and result, of a result alone with id and result; null without valid JSON) and raw (where a call has no message:
    the same with the arguments' text as a string).
    Errors: "no result", "repeated result" (the earliest counts, the others follow in rows of their own: "later result"),
    "repeated id" (the earliest call owns an id; later ones get no position and no result), "unknown need", "cycle" (on or
    behind one; such calls stand last in their knot), "no call" (a result alone), "null key" (a call or result without a
    conversation, turn or call id, which cannot be linked), and of arguments "$ json", "$ tool" or the broken schema
    keyword. Empty tables give an empty table.
    """
    keyed = "conv is not null and turn is not null and call_id is not null"
    calls = calls.select("conv", F.col("turn").cast("long").alias("turn"), "call_id", "name", "arguments", "needs")
    results = results.select("conv", F.col("turn").cast("long").alias("turn"), "call_id", "content")

    def run(b):
        texts, raws, errors = [], [], []
        for name, arguments in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
            t, e = check_arguments(name, arguments, schemas)
            texts.append(t)
            raws.append(arguments if t is None else None)
            errors.append(e)
        return pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(texts, pa.string()), pa.array(raws, pa.string()), b.column(5), pa.array(errors, pa.list_(pa.string()))],
                                          ["conv", "turn", "call_id", "name", "args", "raw", "needs", "faults"])

    kind = calls.schema["conv"].dataType.simpleString()
    check_type = f"conv {kind}, turn long, call_id string, name string, args string, raw string, needs array<string>, faults array<string>"
    checked = calls.filter(keyed).mapInArrow(batches(run), check_type)
    lost_calls, lost_results = calls.filter(f"not ({keyed})").mapInArrow(batches(run), check_type), results.filter(f"not ({keyed})")
    results = results.filter(keyed)
    first = Window.partitionBy("conv", "call_id").orderBy("turn", F.col("name").asc_nulls_last(), F.col("args").asc_nulls_last(), F.col("raw").asc_nulls_last())
    checked = cut(checked.withColumn("n", F.row_number().over(first)))
    owners = checked.filter("n = 1")
    needs = cut(owners.select("conv", "call_id", F.explode(F.array_distinct("needs")).alias("need")).filter("need is not null"))
    known = needs.join(owners.select("conv", F.col("call_id").alias("need"), F.lit(True).alias("known")), ["conv", "need"], "left")
    lacking = known.filter("known is null").select("conv", "call_id").distinct().withColumn("lacks", F.lit(True))
    answers = results.groupBy("conv", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("answers"))
    place = ordered(owners.select("conv", "call_id", "turn"), needs, knot_limit)
    full = (owners.drop("n", "turn").join(place, ["conv", "call_id"]).join(lacking, ["conv", "call_id"], "left")
            .join(answers, ["conv", "call_id"], "full_outer"))

    def fault(cond: Column, text: str) -> Column:
        return F.when(cond, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))

    alone = F.col("turn").isNull()
    full = full.withColumn("errors", F.array_sort(F.concat(
        F.coalesce("faults", F.array().cast("array<string>")), fault(alone, "no call"), fault(F.col("r").isNull(), "no result"), fault(F.col("answers") > 1, "repeated result"),
        fault(F.col("lacks").isNotNull(), "unknown need"), fault(F.col("level") == -1, "cycle"))))
    full = cut(full.withColumn("block", F.floor(F.col("at") / TURNS)))
    placed = full.filter(~alone)
    counts = placed.groupBy("conv", "block").count()
    starts = counts.select("conv", "block", (F.sum("count").over(Window.partitionBy("conv").orderBy("block")) - F.col("count")).alias("start"))
    w = Window.partitionBy("conv", "block").orderBy("at", (F.col("level") == -1), "level", "turn", "call_id")
    placed = placed.join(starts, ["conv", "block"]).withColumn("position", F.col("start") + F.row_number().over(w) - 1)

    # results of an id behind its first; their content moves only where an id has several
    several = cut(results.groupBy("conv", "call_id").count().filter("count > 1").drop("count"))
    same = join_checked(results, several, ["conv", "call_id"], "left_semi", ID_BYTES).groupBy("conv", "call_id", "turn", "content").count()
    firsts = same.groupBy("conv", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    copies = F.col("count") - F.struct("turn", "content").eqNullSafe(F.col("r")).cast("long")
    later = same.join(firsts, ["conv", "call_id"]).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))

    def row(df: DataFrame, is_call: bool, errors: Column, **own: Column) -> DataFrame:
        own = {"turn": F.lit(None), "result_turn": F.lit(None), "position": F.lit(None), "name": F.lit(None), "args": F.lit(None), "raw": F.lit(None), "content": F.lit(None)} | own
        types = {"turn": "long", "result_turn": "long", "position": "long"}
        return df.select("conv", "call_id", *(c.cast(types.get(n, "string")).alias(n) for n, c in own.items()), errors.alias("errors"), F.lit(is_call).alias("is_call"))

    call = {n: F.col(n) for n in ("turn", "name", "args", "raw")}
    rows = row(placed, True, F.col("errors"), **call, result_turn=F.col("r.turn"), position=F.col("position"), content=F.col("r.content"))
    for more in (row(full.filter(alone), False, F.col("errors"), result_turn=F.col("r.turn"), content=F.col("r.content")),
                 row(checked.filter("n > 1"), True, F.array_sort(F.concat("faults", F.array(F.lit("repeated id")))), **call),
                 row(later, False, F.array(F.lit(LATER)), result_turn=F.col("turn"), content=F.col("content")),
                 row(lost_calls, True, F.array_sort(F.concat("faults", F.array(F.lit(NULL_KEY)))), **call),
                 row(lost_results, False, F.array(F.lit(NULL_KEY)), result_turn=F.col("turn"), content=F.col("content"))):
        rows = rows.unionByName(more)

    def write(b):
        messages, raws = [], []
        for i, name, position, args, raw, content, is_call in zip(*(b.column(c).to_pylist() for c in ("call_id", "name", "position", "args", "raw", "content", "is_call"))):
            rest = canonical({"id": i, "name": name, "position": position, "result": content} if is_call else {"id": i, "result": content})
            messages.append(rest if not is_call else None if args is None else rest.replace("{", '{"arguments":' + args + ",", 1))
            raws.append(rest.replace("{", '{"arguments":' + canonical(raw) + ",", 1) if is_call and args is None else None)
        kept = ["conv", "call_id", "turn", "result_turn", "position", "name", "errors"]
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(messages, pa.string()), pa.array(raws, pa.string())], [*kept, "message", "raw"])

    out = rows.mapInArrow(batches(write), f"conv {kind}, call_id string, turn long, result_turn long, position long, name string, errors array<string>, message string, raw string")
    return out.withColumn("valid", F.size("errors") == 0).select(LINKED)


#: The tools of the query, by name.
SCHEMAS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}}},
    "summarise": {"type": "object", "required": ["text", "style"],
                  "properties": {"text": {"type": "string"}, "style": {"enum": ["short", "long"]}, "tags": {"type": "array", "items": {"type": "string"}}}},
    "measure": {"type": "object", "required": ["values"], "properties": {"values": {"type": "array", "minItems": 1, "items": {"type": "number"}}}},
}


#: Turns that ``traffic`` takes for results.
_ANSWER = "role = 'user' and turn > 0"


def traffic(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from a conversation table (conv_id, turn, role, text), by hashes of conversation and turn.

    Every assistant turn is a call on its whole text that needs the call two turns before; some refer two turns ahead
    instead, some carry invalid arguments or JSON without its last brace. Every user turn is the result of the turn before
    it, but for the first one; all other turns are in ``context``.
    """
    def call_id(turn: str) -> Column:
        return F.expr(f"concat('call_', substr(md5(concat(conv_id, ':', {turn})), 1, 16))")

    def chance(turn: str) -> Column:
        return F.expr(f"pmod(xxhash64('chance', conv_id, cast({turn} as bigint)), 48)")

    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    n = F.size(F.split("text", " "))
    c = chance("turn")
    tool = F.when(c % 3 == 0, "search").when(c % 3 == 1, "summarise").when(c == 47, "unheard_of").otherwise("measure")
    body = (F.when(c % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.pmod(n, F.lit(60)).alias("limit"))))
            .when(c % 3 == 1, F.to_json(F.struct(F.when(c == 46, "odd").when(n > 40, "long").otherwise("short").alias("style"), F.col("text").alias("text"))))
            .otherwise(F.to_json(F.struct(F.array(n.cast("double"), F.length("text") / 8).alias("values"), F.col("text").alias("text")))))
    ahead, behind = F.array(call_id("turn + 2")), F.array(call_id("turn - 2"))
    calls = turns.filter("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), "turn", call_id("turn").alias("call_id"), tool.alias("name"),
        F.when(c == 45, F.left(body, F.length(body) - 1)).otherwise(body).alias("arguments"),
        F.when(c < 3, ahead).when((F.col("turn") < 2) | (chance("turn - 2") < 2), F.array().cast("array<string>")).otherwise(behind).alias("needs"))
    results = turns.filter(_ANSWER).select(F.col("conv_id").alias("conv"), "turn", call_id("turn - 1").alias("call_id"), F.col("text").alias("content"))
    return calls, results


def context(turns: DataFrame) -> DataFrame:
    """(conv, context_turn, errors, message) of the turns that are neither call nor result in ``traffic``: system and first user turns."""
    def run(b):
        rows = zip(*(c.to_pylist() for c in b.columns[1:]))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([canonical({"role": r, "text": t}) for _, r, t in rows], pa.string())],
                                          ["conv", "context_turn", "message"])

    other = turns.filter(f"not coalesce(role = 'assistant' or {_ANSWER}, false)")
    other = other.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    return (other.mapInArrow(batches(run), f"conv {other.schema['conv'].dataType.simpleString()}, context_turn long, message string")
            .withColumn("errors", F.array(F.lit("neither call nor result"))).withColumn("valid", F.lit(False)))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the calls and results of every conversation, linked; its other turns with their number as ``context_turn``."""
    turns = table(spark, sf_dir, "conversations")
    calls, results = traffic(turns)
    return link_all(calls, results, SCHEMAS).unionByName(context(turns), allowMissingColumns=True).withColumnRenamed("conv", "conv_id")
