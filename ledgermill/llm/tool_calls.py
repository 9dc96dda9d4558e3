"""Tool-call linking in conversations, with built-in functions only.

Messages are (conv_id, turn, role, text). An assistant message may hold ``{"tool_calls": [{"id", "name",
"arguments", "depends_on"}]}``, a tool message ``{"tool_call_id", "content"}``. Calls and results meet in a
shuffled hash join on (conv_id, id), built from one row an id. Calls are ordered topologically: a dependency on an earlier turn holds by
turn; inside a message levels are raised along dependencies until they stand, and a call whose level
reaches the number of calls lies on or behind a cycle. Arguments are checked against the tools' schemas,
and each call becomes canonical JSON: keys sorted, no white space, fields of the call that are null left out.

Defined cases: messages with null conv_id, turn or text, or text that is no such JSON, hold no calls and
no results; the first result (by turn, then content) of an id answers it, others are counted; an id that
occurs more than once in a conversation is ``duplicate_id`` and each occurrence is linked; a result that
does not come after its call, or without a call, links nothing; very long texts and contents are kept whole;
columns of other names are ignored; an empty table gives no rows; a parameter that is given as null is a ``type:``
error and stays null in the arguments; arguments that repeat a key are no JSON object, so each required parameter is
a ``type:`` error and the canonical call has no arguments. Levels cost the square of the calls in one
message, never of a conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>>"
RESULT = "struct<tool_call_id:string,content:string>"
#: tool -> parameter -> (JSON type, required)
Tools = dict[str, dict[str, tuple[str, bool]]]
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}


def _levels(calls: Column) -> Column:
    """Level of each call of one message: 1 + the highest level among its dependencies in the message."""
    ids = F.transform(calls, lambda c: c["id"])

    def raised(levels: Column, ids: Column, calls: Column) -> Column:
        def of(c: Column) -> Column:
            inside = F.filter(F.coalesce(c["depends_on"], F.array().cast("array<string>")), lambda d: F.array_contains(ids, d))
            return F.coalesce(F.array_max(F.transform(inside, lambda d: F.get(levels, (F.array_position(ids, d) - 1).cast("int")) + 1)), F.lit(0))

        return F.transform(calls, of)

    bound = F.struct(ids.alias("ids"), calls.alias("calls"))
    start = F.transform(calls, lambda c: F.lit(0))
    return F.get(F.transform(F.array(bound), lambda b: F.aggregate(F.sequence(F.lit(1), F.size(b["calls"])), start, lambda levels, _: raised(levels, b["ids"], b["calls"]))), F.lit(0))


def calls_of(messages: DataFrame) -> DataFrame:
    """One row a call: conv_id, turn, number (as listed), n_calls, id, name, arguments, depends_on, inner (ids of its message), level, position."""
    kept = messages.where((F.col("role") == "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("text").contains("tool_calls"))
    parsed = kept.select("conv_id", "turn", F.filter(F.from_json("text", CALLS)["tool_calls"], lambda c: c.isNotNull() & c["id"].isNotNull()).alias("calls")).where(F.size("calls") > 0)
    levelled = parsed.withColumn("levels", _levels(F.col("calls")))
    order = F.transform(F.array_sort(F.transform("levels", lambda x, i: F.struct(x.alias("x"), i.alias("i")))), lambda s: s["i"])
    placed = levelled.withColumn("order", order).select("conv_id", "turn", "levels", "order", F.size("calls").alias("n_calls"), F.transform("calls", lambda c: c["id"]).alias("inner"), F.posexplode("calls").alias("number", "call"))
    return placed.select("conv_id", "turn", "number", "n_calls", "call.*", "inner", F.get("levels", F.col("number")).alias("level"), (F.array_position("order", F.col("number")) - 1).cast("int").alias("position"))


def results_of(messages: DataFrame) -> DataFrame:
    """conv_id, id, the first result's turn and content, and the number of results."""
    kept = messages.where((F.col("role") == "tool") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("text").contains("tool_call_id"))
    parsed = kept.select("conv_id", "turn", F.from_json("text", RESULT).alias("r")).where(F.col("r.tool_call_id").isNotNull())
    first = F.min(F.struct("turn", "r.content"))
    return parsed.groupBy("conv_id", F.col("r.tool_call_id").alias("id")).agg(first.alias("first"), F.count("*").alias("n_results")).select("conv_id", "id", F.col("first.turn").alias("result_turn"), F.col("first.content").alias("result"), "n_results")


def argument_errors(name: Column, arguments: Column, tools: Tools) -> Column:
    """Errors of the arguments (JSON text) against the schema of the named tool, as an array of strings."""
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)

    def of(parameters: dict[str, tuple[str, bool]]) -> Column:
        found = []
        for parameter, (kind, required) in sorted(parameters.items()):
            has = F.array_contains(keys, parameter)
            typed = F.schema_of_variant(F.try_variant_get(value, f"$.{parameter}", "variant")).rlike(TYPES[kind])
            found.append(F.when(~has, F.lit(f"missing:{parameter}") if required else F.lit(None)).when(~F.coalesce(typed, F.lit(False)), F.lit(f"type:{parameter}")))
        extra = F.transform(F.array_sort(F.array_except(keys, F.array(*map(F.lit, parameters)).cast("array<string>"))), lambda k: F.concat(F.lit("unexpected:"), k))
        return F.concat(F.array_compact(F.array(*found).cast("array<string>")), extra)

    known = reduce(lambda column, x: column.when(name == x[0], of(x[1])), sorted(tools.items()), F.when(name.isNull() | ~name.isin(*tools), F.array(F.lit("unknown_tool"))))
    return F.when(keys.isNull(), F.array(F.lit("not_an_object"))).otherwise(known)


def link_tool_calls(messages: DataFrame, tools: Tools) -> DataFrame:
    """conv_id, turn, position, id, name, level, result_turn, n_results, errors, canonical of every call."""
    calls = calls_of(messages.select("conv_id", "turn", "role", "text"))
    # First turn and number of occurrences of each id.
    known = calls.groupBy("conv_id", "id").agg(F.min("turn").alias("first_turn"), F.count("*").alias("n_same"))
    row = F.struct("turn", "number").alias("at")
    asked = calls.select("conv_id", "id", row, F.explode(F.array_except("depends_on", "inner")).alias("dep"))
    seen = asked.join(known.select("conv_id", F.col("id").alias("dep"), "first_turn").hint("shuffle_hash"), ["conv_id", "dep"], "left")
    outer = seen.withColumn("error", F.when(F.col("first_turn").isNull(), F.concat(F.lit("unknown_dependency:"), "dep")).when(F.col("first_turn") >= F.col("at.turn"), F.concat(F.lit("later_dependency:"), "dep")))
    outer = outer.where(F.col("error").isNotNull()).groupBy("conv_id", "id", "at").agg(F.array_sort(F.collect_set("error")).alias("order_errors"))
    linked = (
        calls.withColumn("at", row)
        .join(known.hint("shuffle_hash"), ["conv_id", "id"])
        .join(outer.hint("shuffle_hash"), ["conv_id", "id", "at"], "left")
        .join(results_of(messages.select("conv_id", "turn", "role", "text")).hint("shuffle_hash"), ["conv_id", "id"], "left")
    )
    after = F.coalesce(F.col("result_turn") > F.col("turn"), F.lit(False))
    own = F.array_compact(F.array(F.when(F.col("n_same") > 1, F.lit("duplicate_id")), F.when(F.col("level") >= F.col("n_calls"), F.lit("cycle")), F.when(F.col("result_turn").isNotNull() & ~after, F.lit("result_before_call"))))
    errors = F.concat(own, F.coalesce("order_errors", F.array().cast("array<string>")), argument_errors(F.col("name"), F.col("arguments"), tools))
    canonical = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("id"), F.col("name"), F.when(after, F.col("result")).alias("result")))
    return linked.select("conv_id", "turn", "position", "id", "name", "level", F.when(after, F.col("result_turn")).alias("result_turn"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), errors.alias("errors"), canonical.alias("canonical"))


#: The tools that turns stand for in op2.
TURN_TOOLS: Tools = {
    "answer": {"prompt": ("string", True), "chars": ("integer", True), "style": ("string", False)},
    "search": {"query": ("string", True), "k": ("integer", True)},
}


def turns_as_calls(turns: DataFrame) -> DataFrame:
    """Plain turns as tool messages. A user turn asks for an answer, which depends on a search listed after it and on the
    answer two turns before, which may not be there; every fifth turn's search depends on that answer in turn, a cycle. The
    search's k is a number for texts of even length and text for others, every third length's answer has a style. A system
    turn calls a tool that is not declared. An assistant turn is the result of the answer of the turn before."""
    n, named = F.length("text"), lambda turn, name: F.concat_ws("-", turn, F.lit(name))
    none = F.array().cast("array<string>")
    call = lambda name, arguments, depends: F.struct(named(F.col("turn"), name).alias("id"), F.lit(name).alias("name"), arguments.alias("arguments"), depends.alias("depends_on"))
    user = F.array(
        call(
            "answer",
            F.to_json(F.struct(F.col("text").alias("prompt"), n.alias("chars"), F.when(n % 3 == 0, "brief").alias("style"))),
            F.concat(F.array(named(F.col("turn"), "search")), F.when(F.col("turn") >= 2, F.array(named(F.col("turn") - 2, "answer"))).otherwise(none)),
        ),
        call(
            "search",
            F.when(n % 2 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.lit(5).alias("k")))).otherwise(F.to_json(F.struct(F.col("text").alias("query"), F.lit("5").alias("k")))),
            F.when(F.col("turn") % 5 == 4, F.array(named(F.col("turn"), "answer"))).otherwise(none),
        ),
    )
    system = F.array(call("configure", F.to_json(F.struct(F.col("text").alias("text"))), none))
    # The arguments are put in as JSON, not as a string.
    as_calls = lambda calls: F.concat(F.lit('{"tool_calls":['), F.array_join(F.transform(calls, lambda c: F.concat(F.lit('{"id":"'), c["id"], F.lit('","name":"'), c["name"], F.lit('","arguments":'), c["arguments"], F.lit(',"depends_on":'), F.to_json(c["depends_on"]), F.lit("}"))), ","), F.lit("]}"))
    result = F.to_json(F.struct(named(F.col("turn") - 1, "answer").alias("tool_call_id"), F.col("text").alias("content")))
    text = F.when(F.col("role") == "user", as_calls(user)).when(F.col("role") == "system", as_calls(system)).when(F.col("role") == "assistant", result)
    return turns.select("conv_id", "turn", F.when(F.col("role") == "assistant", "tool").otherwise("assistant").alias("role"), text.alias("text"))


def op2_tool_calls(spark, sf_dir: str) -> DataFrame:
    """All turns of all conversations as linked, checked and canonical calls."""
    linked = link_tool_calls(turns_as_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet")), TURN_TOOLS)
    return linked.withColumn("errors", F.array_join("errors", ","))


OP2_SQL = """
WITH t AS (
  SELECT *, turn % 5 = 4 AS looped FROM conversations WHERE text IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL
), calls AS (
  SELECT conv_id, turn, CASE WHEN looped THEN 0 ELSE 1 END AS position, turn || '-answer' AS id, 'answer' AS name, CASE WHEN looped THEN 2 ELSE 1 END AS level,
         '{"chars":' || length(text) || ',"prompt":' || CAST(to_json(text) AS VARCHAR) || CASE WHEN length(text) % 3 = 0 THEN ',"style":"brief"' ELSE '' END || '}' AS arguments,
         looped, NULL AS wrong, CASE WHEN turn >= 2 THEN (turn - 2) || '-answer' END AS earlier
  FROM t WHERE role = 'user'
  UNION ALL
  SELECT conv_id, turn, CASE WHEN looped THEN 1 ELSE 0 END, turn || '-search', 'search', CASE WHEN looped THEN 2 ELSE 0 END,
         '{"k":' || CASE WHEN length(text) % 2 = 0 THEN '5' ELSE '"5"' END || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}', looped, CASE WHEN length(text) % 2 <> 0 THEN 'type:k' END, NULL
  FROM t WHERE role = 'user'
  UNION ALL
  SELECT conv_id, turn, 0, turn || '-configure', 'configure', 0, '{"text":' || CAST(to_json(text) AS VARCHAR) || '}', false, 'unknown_tool', NULL
  FROM t WHERE role = 'system'
), results AS (
  SELECT conv_id, (turn - 1) || '-answer' AS id, min(turn) AS result_turn, min(text) AS result, count(*) AS n_results
  FROM t WHERE role = 'assistant' GROUP BY ALL
), same AS (SELECT conv_id, id, count(*) AS n_same FROM calls GROUP BY ALL)
SELECT c.conv_id, c.turn, CAST(c.position AS INTEGER) AS position, c.id, c.name, CAST(c.level AS INTEGER) AS level,
       r.result_turn, coalesce(r.n_results, 0) AS n_results,
       concat_ws(',', CASE WHEN s.n_same > 1 THEN 'duplicate_id' END, CASE WHEN c.looped THEN 'cycle' END,
         CASE WHEN c.earlier IS NOT NULL AND e.id IS NULL THEN 'unknown_dependency:' || c.earlier END, c.wrong) AS errors,
       '{"arguments":' || c.arguments || ',"id":"' || c.id || '","name":"' || c.name || '"'
         || CASE WHEN r.result IS NULL THEN '' ELSE ',"result":' || CAST(to_json(r.result) AS VARCHAR) END || '}' AS canonical
FROM calls c JOIN same s USING (conv_id, id) LEFT JOIN results r USING (conv_id, id) LEFT JOIN same e ON e.conv_id = c.conv_id AND e.id = c.earlier
"""
