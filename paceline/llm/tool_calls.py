"""Chat formatting: tool calls linked to their results, checked, ordered and written as canonical JSON.

Calls and results are messages of a conversation that carry an identifier. They are joined by it, the
calls of a conversation are put in topological order (a call comes after the calls whose results its
arguments refer to), arguments are validated against the tool's schema, and the linked conversation
is written as JSON with sorted keys and no spare white space, so that equal content is equal text.

Calls that refer back are in order as they stand, so only conversations with a reference to a later
call are worked on. A call takes its place behind the last call it waits for. Slabs of a conversation
settle the calls whose needs are settled, as far as they get, and learn of the other slabs between
rounds, by joins over written tables; a long conversation is never gathered. What no round settles is
in or behind a cycle.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paceline.operators.ordered import positions
from paceline.session import staged

#: Calls of a conversation that a task puts in order at a time, and calls in one written text.
SLAB_CALLS = 10_000

#: Refers to the result of another call of the conversation inside an argument.
REFERENCE = re.compile(r"^\$\{([^{}]+)\}$")
_KINDS = {
    "string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None),
}


def plain(value: object) -> object:
    """The value with whole floats as integers, as JSON knows numbers only."""
    if isinstance(value, float):
        return int(value) if math.isfinite(value) and value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def canonical(value: object) -> str:
    """JSON with sorted keys, no spare blanks and no escapes beyond the needed; whole floats as integers."""
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parsed(text: str | None) -> tuple[object, str | None]:
    """(value, error) of a JSON text; duplicate keys, NaN and infinities are errors."""

    def unique(pairs: list[tuple[str, object]]) -> dict:
        if len(dict(pairs)) < len(pairs):
            raise ValueError("duplicate key")
        return dict(pairs)

    def refused(name: str) -> float:
        raise ValueError(f"{name} is not JSON")

    try:
        value = plain(json.loads(text or "", object_pairs_hook=unique, parse_constant=refused))
        canonical(value)
    except (ValueError, RecursionError) as wrong:
        return None, f"not JSON: {str(wrong)[:80]}"
    return value, None


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks the schema: type, enum, required, properties, items and numeric or length bounds.

    A reference to another call's result stands for a value of any type.
    """
    if isinstance(value, str) and REFERENCE.match(value):
        return []
    kinds = schema.get("type", list(_KINDS))
    kinds = [kinds] if isinstance(kinds, str) else kinds
    fits = [k for k in kinds if isinstance(value, _KINDS[k]) and not (isinstance(value, bool) and k in ("integer", "number"))]
    if not fits:
        return [f"{at}: is not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and canonical(value) not in [canonical(x) for x in schema["enum"]]:
        out.append(f"{at}: is none of the allowed values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            out.append(f"{at}: is out of range")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        out.append(f"{at}: has a wrong length")
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{k}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: is missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties", True) is False:
            out += [f"{at}.{k}: is not known" for k in sorted(value) if k not in known]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
    return out


def references(value: object) -> set[str]:
    """Identifiers of the calls whose results ``value`` refers to."""
    if isinstance(value, str):
        found = REFERENCE.match(value)
        return {found[1]} if found else set()
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return set().union(*(references(x) for x in inner)) if inner else set()


Place = tuple[tuple, int]


def settle(places: dict[str, tuple], needs: dict[str, set[str]], known: dict[str, Place]) -> dict[str, Place]:
    """Places in the order of all calls that can be settled: (place of the last call waited for or the own, steps behind it).

    ``places`` are the calls of a slab, ``needs`` what they refer to, ``known`` what is settled already
    (calls of other slabs too). Calls in or behind a cycle, or behind an unsettled call, are left out.
    """
    known, waiting, behind = dict(known), {}, {}
    for k in places:
        if k not in known:
            waiting[k] = {x for x in needs.get(k, ()) if x not in known}
            for x in waiting[k]:
                behind.setdefault(x, []).append(k)
    ready = [k for k, v in waiting.items() if not v]
    while ready:
        k = ready.pop()
        known[k] = max([(places[k], 0), *[(known[x][0], known[x][1] + 1) for x in needs.get(k, ())]])
        for x in behind.get(k, ()):
            waiting[x].discard(k)
            if not waiting[x]:
                ready.append(x)
    return {k: known[k] for k in places if k in known}


def ordered_calls(linked: DataFrame, slab_calls: int = SLAB_CALLS) -> DataFrame:
    """Linked calls with ``cyclic`` and their place in topological order: ``last`` (turn and identifier), ``steps``.

    A call without later references stands at its own turn (the call's, or else the result's; calls
    without either come first, ties go by identifier). Another comes right behind the last call that it
    waits for, directly or not. Calls in or behind a cycle are ``cyclic`` and have null places; a call
    that refers to itself is cyclic too but keeps its place.
    """
    turn = F.coalesce(F.col("call_turn"), F.col("result_turn")).cast("long")
    calls = staged(linked.withColumn("at", F.struct(F.coalesce(turn, F.lit(-1).cast("long")).alias("t"), F.col("call_id").cast("string").alias("c"))), "placed-calls")
    there = calls.select("conv_id", F.col("call_id").alias("x"), F.col("at").alias("x_at"))
    edges = staged(calls.select("conv_id", "call_id", "at", F.explode(F.array_distinct("needs")).alias("x")).join(there, ["conv_id", "x"]), "references")
    itself = edges.where("call_id = x").select("conv_id", "call_id", F.lit(True).alias("_self"))
    late = edges.where("x_at > at").select("conv_id").distinct()
    own = F.col("at").alias("last"), F.lit(0).alias("steps")
    marked = calls.join(itself, ["conv_id", "call_id"], "left").withColumn("cyclic", F.coalesce("_self", F.lit(False))).drop("_self")
    if late.isEmpty():
        return marked.select("*", *own)
    late = staged(late, "late-references")
    nodes = positions(calls.join(late, "conv_id", "left_semi").select("conv_id", "call_id", "at"), ["conv_id"], [F.col("at")])
    nodes = staged(nodes.select("conv_id", "call_id", "at", F.floor((F.col("pos") - 1) / slab_calls).alias("slab")), "order-slabs")
    needs = staged(edges.where("call_id <> x").join(late, "conv_id", "left_semi").select("conv_id", "call_id", "x"), "order-needs")
    state = nodes.select("conv_id", "call_id", F.lit(None).cast("struct<t:bigint,c:string>").alias("last"), F.lit(None).cast("int").alias("steps"))
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}

    def work(rows: pa.Table) -> pa.Table:
        read = {c: rows.column(c).to_pylist() for c in ("call_id", "at", "last", "steps", "x", "x_last", "x_steps")}
        place = lambda v, n: ((v["t"], v["c"]), n)
        places, wants, known = {}, {}, {}
        for k, at, last, steps, x, x_last, x_steps in zip(*read.values(), strict=True):
            places[k] = (at["t"], at["c"])
            if last is not None:
                known[k] = place(last, steps)
            if x is not None:
                wants.setdefault(k, set()).add(x)
                if x_last is not None:
                    known[x] = place(x_last, x_steps)
        done = settle(places, wants, known)
        keys, values = list(places), [done.get(k) for k in places]
        last = [None if v is None else {"t": v[0][0], "c": v[0][1]} for v in values]
        return pa.table({
            "conv_id": pa.array([rows.column("conv_id")[0].as_py()] * len(keys), rows.schema.field("conv_id").type), "call_id": pa.array(keys, rows.schema.field("call_id").type),
            "last": pa.array(last, pa.struct([("t", pa.int64()), ("c", pa.string())])), "steps": pa.array([None if v is None else v[1] for v in values], pa.int32())})

    open_calls = None
    while True:
        other = state.select("conv_id", F.col("call_id").alias("x"), F.col("last").alias("x_last"), F.col("steps").alias("x_steps"))
        wants = needs.join(other, ["conv_id", "x"])
        rows = nodes.join(state, ["conv_id", "call_id"]).join(wants, ["conv_id", "call_id"], "left")
        state = staged(rows.groupBy("conv_id", "slab").applyInArrow(
            work, f"conv_id {kinds['conv_id']}, call_id {kinds['call_id']}, last struct<t:bigint,c:string>, steps int"), "order-state")
        left = state.where("last IS NULL").count()
        if left in (0, open_calls):
            break
        open_calls = left
    placed = marked.join(state.withColumn("_late", F.lit(True)), ["conv_id", "call_id"], "left")
    mine = F.coalesce("_late", F.lit(False))
    columns = [c for c in marked.columns if c != "cyclic"]
    return placed.select(
        *columns, (F.col("cyclic") | (mine & F.col("last").isNull())).alias("cyclic"), F.when(mine, F.col("last")).otherwise(F.col("at")).alias("last"),
        F.when(mine, F.col("steps")).otherwise(F.lit(0)).alias("steps"))


def linked_calls(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """Calls with their result and verdict, one row per identifier of a conversation.

    ``calls``: ``conv_id``, ``turn``, ``call_id``, ``tool``, ``arguments`` (JSON text). ``results``:
    ``conv_id``, ``turn``, ``call_id``, ``content``. ``tools``: ``tool``, ``schema`` (JSON text).
    Returns ``conv_id``, ``call_id``, ``call_turn``, ``result_turn``, ``tool``, ``arguments``
    (canonical), ``content``, ``status`` and ``needs`` (identifiers in the arguments).

    Status: ``ok``, ``no result``, ``no call`` (a result alone), ``result before call``,
    ``unknown tool``, ``bad arguments: …`` with the first violation. Of several calls or results
    with one identifier the earliest turn counts, the least content on a tie; rows without a
    conversation or identifier are left out. The join is on both, so a long conversation is spread.
    """
    first = ["conv_id", "call_id"]
    there = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    asked = calls.where(there).groupBy(*first).agg(F.min(F.struct("turn", "tool", "arguments")).alias("c"))
    given = results.where(there).groupBy(*first).agg(F.min(F.struct("turn", "content")).alias("r"))
    known = tools.where("tool is not null").groupBy("tool").agg(F.min("schema").alias("schema"))
    both = asked.join(given, first, "full_outer").select(
        *first, F.col("c.turn").alias("call_turn"), F.col("r.turn").alias("result_turn"), F.col("c.tool").alias("tool"),
        F.col("c.arguments").alias("arguments"), F.col("r.content").alias("content"), F.col("c").isNotNull().alias("asked"),
        F.col("r").isNotNull().alias("given"),
    ).join(known, "tool", "left")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        schemas: dict[str, dict] = {}
        for rows in batches:
            status, written, needs = [], [], []
            for r in rows.itertuples():
                value, wrong = parsed(r.arguments) if r.asked else (None, None)
                if r.asked and not isinstance(r.schema, str):
                    wrong = "unknown tool"
                elif r.asked and wrong:
                    wrong = f"bad arguments: {wrong}"
                elif r.asked:
                    if r.schema not in schemas:
                        schemas[r.schema] = json.loads(r.schema)
                    breaks = violations(value, schemas[r.schema])
                    wrong = f"bad arguments: {breaks[0]}" if breaks else None
                if not wrong:
                    late = r.asked and r.given and pd.notna(r.result_turn) and pd.notna(r.call_turn) and r.result_turn < r.call_turn
                    wrong = "no call" if not r.asked else "no result" if not r.given else "result before call" if late else "ok"
                status.append(wrong)
                written.append(canonical(value) if r.asked and not (parsed(r.arguments)[1]) else r.arguments)
                needs.append(sorted(references(value)))
            yield pd.DataFrame({
                "conv_id": rows["conv_id"], "call_id": rows["call_id"], "call_turn": rows["call_turn"], "result_turn": rows["result_turn"],
                "tool": rows["tool"], "arguments": written, "content": rows["content"], "status": status, "needs": needs,
            })

    kind = {f.name: f.dataType.simpleString() for f in both.schema}
    schema = (f"conv_id {kind['conv_id']}, call_id {kind['call_id']}, call_turn {kind['call_turn']}, result_turn {kind['result_turn']}, "
              "tool string, arguments string, content string, status string, needs array<string>")
    return both.mapInPandas(judge, schema)


def formatted(linked: DataFrame, most_rows: int = SLAB_CALLS) -> DataFrame:
    """One row per conversation part: the linked calls in topological order as one canonical JSON text.

    Returns ``conv_id``, ``part``, ``calls``, ``linked`` (calls with status ok), ``cyclic`` (calls in or
    behind a cycle of references) and ``json``. Cyclic calls come last, by their turns. The ordered calls
    of a conversation are cut into parts of ``most_rows``, so that none grows into one unbounded text;
    the order is that of the whole conversation at every size. References to identifiers that the
    conversation does not have count for nothing. An empty table gives an empty result.
    """
    ordered = ordered_calls(linked)
    behind = F.col("last").isNull()
    order = [behind, F.coalesce("last", "at"), F.coalesce("steps", F.lit(0)), F.col("at")]
    put = positions(ordered, ["conv_id"], order).withColumn("part", F.floor((F.col("pos") - 1) / most_rows).cast("long"))
    call = F.struct("pos", "call_id", "tool", "arguments", "content", "status", "cyclic")
    parts = put.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(call)).alias("rows"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            calls, done, cyclic, texts = [], [], [], []
            for rows in batch.column("rows").to_pylist():
                out = []
                for r in rows:
                    value, wrong = parsed(r["arguments"]) if r["arguments"] is not None else (None, None)
                    out.append({"arguments": r["arguments"] if wrong else value, "id": r["call_id"], "result": r["content"],
                                "status": r["status"], "tool": r["tool"]})
                calls.append(len(rows))
                done.append(sum(r["status"] == "ok" for r in rows))
                cyclic.append(sum(r["cyclic"] for r in rows))
                texts.append(canonical(out))
            numbers = [pa.array(x, pa.int64()) for x in (calls, done, cyclic)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("part"), *numbers, pa.array(texts, pa.string())],
                ["conv_id", "part", "calls", "linked", "cyclic", "json"],
            )

    kind = linked.schema["conv_id"].dataType.simpleString()
    return parts.mapInArrow(write, f"conv_id {kind}, part bigint, calls bigint, linked bigint, cyclic bigint, json string")


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversation turns read as tool use: each question is a call, the next turn's answer its result.

    A turn that is not an assistant's (null role included) calls ``user`` or ``system`` with its text,
    its turn number and, from the third turn on, a reference to the call two turns before. An
    assistant turn is the result for the turn before it. Identifiers name the turn.
    """
    name = lambda turn: F.concat(F.lit("t"), turn.cast("string"))
    asks = ~F.coalesce(F.col("role") == "assistant", F.lit(False))
    arguments = F.to_json(F.struct(
        F.coalesce("text", F.lit("")).alias("text"), F.col("turn").alias("turn"),
        F.when(F.col("turn") >= 2, F.concat(F.lit("${"), name(F.col("turn") - 2), F.lit("}"))).alias("after"),
    ))
    calls = turns.where(asks).select(
        "conv_id", "turn", name(F.col("turn")).alias("call_id"), F.coalesce("role", F.lit("user")).alias("tool"), arguments.alias("arguments")
    )
    results = turns.where(~asks).select(
        "conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.coalesce("text", F.lit("")).alias("content")
    )
    return calls, results


#: Schemas of the tools that ``calls_of_turns`` calls.
TURN_TOOLS = [
    (tool, canonical({
        "type": "object", "required": ["text", "turn"], "additionalProperties": False,
        "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "after": {"type": "string"}},
    }))
    for tool in ("system", "user")
]
