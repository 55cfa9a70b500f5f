"""Chat formatting: tool calls and their results, linked, ordered, validated and serialised.

Calls and results meet in a hash join on (conversation, identifier).  The topological place of a call is its
depth: the longest way from a call that waits for none.  It is found in rounds over the edges, as Kahn's peeling does
it, but chains are contracted: an edge to a call that waits for one other call only moves on to that one.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Schemas of the tools: argument names and types, and which of them must be there.
SCHEMAS = {"reply": {"properties": {"role": "string", "text": "string", "turn": "integer"}, "required": ["text", "turn"]}}
_TYPES = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "object": (dict,), "array": (list,), "null": (type(None),)}


def canonical(value) -> str:
    """JSON with sorted keys and no blanks; text stays as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def problems(name: str | None, arguments, schemas: dict) -> str:
    """What is wrong with the arguments, comma-joined; empty if nothing is."""
    schema = schemas.get(name or "")
    if schema is None:
        return "unknown tool"
    if not isinstance(arguments, dict):
        return "arguments are no object"
    bad = [f"missing {k}" for k in sorted(schema.get("required", ())) if k not in arguments]
    for k, v in sorted(arguments.items()):
        want = schema.get("properties", {}).get(k)
        if want is None:
            bad.append(f"unknown {k}")
        elif not isinstance(v, _TYPES[want]) or isinstance(v, bool) and want != "boolean":
            bad.append(f"{k} is no {want}")
    return ",".join(bad)


def _load(text):
    try:
        return json.loads(text), True
    except (TypeError, ValueError, RecursionError):
        return text, False


def depths(edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, cycle) of the calls in ``edges`` (conv_id, call_id, to: a call of ``edges`` that must come first, null for none).

    ``depth`` is the number of edges of the longest way to a call without one; null, and ``cycle`` true, for calls on a
    circle and those that wait for one.  No field but ``to`` is null; repeated edges are harmless; an empty table gives an empty one.

    In a round an edge to a call whose depth is known ends there, and one to a call with one open edge takes that edge's
    place behind it; edges of one call to the same end are then one, with the greatest length.  A chain, or a ladder of calls
    that fork and meet again, takes rounds as the logarithm of its length; where several open calls meet, a level takes a round.
    An edge as long as its conversation has calls is on a circle and stays, and the rounds end when none moves."""
    key = ["conv_id", "call_id"]
    e = C.written(edges.selectExpr(*key, "to", "CASE WHEN to IS NULL THEN 0L ELSE 1L END AS w").distinct(), "chat-edges")
    most = e.groupBy(*key).agg(F.lit(1)).groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    while True:
        # of each call: its open edges, and whether one of them is at least as long as what has ended
        state = C.written(e.groupBy(*key).agg(F.count("to").alias("open"), F.max("to").alias("up"), F.expr("max(w) FILTER (WHERE to IS NOT NULL)").alias("far"),
                                              F.expr("max(w) FILTER (WHERE to IS NULL)").alias("depth")), "chat-state")
        through = state.where("open = 0 OR open = 1 AND far >= coalesce(depth, 0L)").selectExpr(
            "conv_id", "call_id AS to", "up", "CASE WHEN open = 0 THEN depth ELSE far END AS more")
        on = f"more IS NOT NULL AND to != call_id AND w + more < {most}"
        step = e.where("to IS NOT NULL").join(through, ["conv_id", "to"], "left").selectExpr(
            *key, f"CASE WHEN {on} THEN up ELSE to END AS to", f"CASE WHEN {on} THEN w + more ELSE w END AS w", f"{on} AS moved")
        e = C.written(step.unionByName(e.where("to IS NULL").selectExpr(*key, "to", "w", "false AS moved"))
                      .groupBy(*key, "to").agg(F.max("w").alias("w"), F.max("moved").alias("moved")), "chat-edges")
        if not e.where("moved").limit(1).count():
            return state.selectExpr(*key, "CASE WHEN open = 0 THEN depth END AS depth", "open > 0 AS cycle")


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row per call, and one per result without a call, by conversation in topological order (depth, null last; then turn, call_id).

    ``calls``: conv_id, call_id, turn, name, arguments (JSON), after (the call_ids that must come first, an array; or one
    call_id, or null).  ``results``: conv_id, call_id, turn, content.  Returned: conv_id, call_id, turn, name, depth (0: no call
    must come first, else one more than the greatest of those; null: none, as a circle comes first or there is no call), n_results, status (ok, invalid,
    no_result, no_call, cycle; the first that fits, in the order no_call, cycle, invalid, no_result), error, json (canonical; of the
    first result by turn, then content).

    Null ids match nothing: such calls have no result and such results no call.  What ``after`` names and is no call of the
    conversation, nulls too, is left out.  Calls repeated under one id are all returned; the first by turn, then arguments, stands
    for them in the order.  Other columns are not read; empty tables give what the other one has.
    """
    key = ["conv_id", "call_id"]
    kind = dict(calls.dtypes)["after"]
    calls = calls.select(*key, "turn", "name", "arguments", F.col("after") if kind.startswith("array") else F.array("after").alias("after"))
    # the sides of the joins are written, so that Spark splits the rows of an identifier, or of none, that very many share
    got = C.written(results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*key)
                    .agg(F.min(F.struct("turn", "content")).alias("first"), F.count("*").alias("n_results")), "chat-results")
    one = C.written(calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*key)
                    .agg(F.min(F.struct("turn", "arguments", "after")).alias("c")).select(*key, F.col("c.after").alias("after")), "chat-calls")
    lost = results.join(one.select(*key), key, "left_anti").select(
        *key, "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.col("content"), F.lit(1).cast("bigint").alias("n_results"), F.lit(None).cast("bigint").alias("depth"), F.lit("no_call").alias("status"))

    known = one.select("conv_id", F.col("call_id").alias("to"), F.lit(True).alias("there"))
    edges = one.select(*key, F.explode_outer("after").alias("to")).join(known, ["conv_id", "to"], "left")
    depth = depths(edges.select(*key, F.expr("CASE WHEN there THEN to END").alias("to")))
    here = (calls.join(got, key, "left").join(depth, key, "left").select(
        *key, "turn", "name", "arguments", F.col("first.content").alias("content"), F.expr("coalesce(n_results, 0L)").alias("n_results"),
        F.expr("CASE WHEN cycle THEN NULL ELSE coalesce(depth, 0L) END").alias("depth"), F.expr("CASE WHEN cycle THEN 'cycle' END").alias("status")))

    text = T.StringType()
    made = T.StructType([T.StructField("error", text), T.StructField("json", text)])

    @F.pandas_udf(made)
    def serialised(name: pd.Series, arguments: pd.Series, call_id: pd.Series, content: pd.Series, status: pd.Series) -> pd.DataFrame:
        rows = []
        for n, a, c, r, s in zip(name, arguments, call_id, content, status):
            value, fine = _load(a)
            error = "" if s == "no_call" else problems(n, value, schemas) if fine else "arguments are no JSON"
            rows.append((error, canonical({"id": c, "name": n, "arguments": value, "result": _load(r)[0]})))
        return pd.DataFrame(rows, columns=["error", "json"])

    placed = here.unionByName(lost).orderBy("conv_id", F.asc_nulls_last("depth"), "turn", "call_id")
    d = placed.withColumn("s", serialised("name", "arguments", "call_id", "content", "status"))
    return d.select(*key, "turn", "name", "depth", "n_results", F.expr(
        "CASE WHEN status IS NOT NULL THEN status WHEN s.error != '' THEN 'invalid' WHEN n_results = 0 THEN 'no_result' ELSE 'ok' END").alias("status"),
        F.col("s.error").alias("error"), F.col("s.json").alias("json"))


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: a turn of a system or user is a call ``reply`` with the turn as its
    arguments, to be made after the call two turns back if there is one; an assistant's turn is the
    result of the turn before it."""
    t = turns.select("conv_id", "turn", "role", "text")
    ident = "concat(conv_id, ':', {})".format
    asks = t.where("role != 'assistant' OR role IS NULL")
    args = F.to_json(F.struct("role", "text", "turn"))
    calls = asks.select("conv_id", F.expr(ident("turn")).alias("call_id"), "turn", F.lit("reply").alias("name"), args.alias("arguments"),
                        F.expr(f"CASE WHEN turn >= 2 THEN {ident('turn - 2')} END").alias("after"))
    results = t.where("role = 'assistant'").select("conv_id", F.expr(ident("turn - 1")).alias("call_id"), "turn", F.to_json(F.struct("text")).alias("content"))
    return calls, results
