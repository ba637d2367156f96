"""Tool calls of conversations linked, ordered, validated and serialised, in DataFrame functions.

Calls and results are hash-joined by conversation and call id.  Calls are
ordered by level: a call that waits for no other has level 0, others one more
than the highest of those that they wait for.  Arguments are checked against
the tools' schemas.  Every call becomes one line of canonical JSON: sorted
keys, no white space, no null members.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ident, stored

#: Tools of the registered query: parameter -> type, required, minimum, maximum, values.
TOOLS: dict[str, dict[str, dict]] = {
    "search": {"query": {"type": "string", "required": True},
               "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 50}},
    "translate": {"text": {"type": "string", "required": True},
                  "to": {"type": "string", "required": True, "values": ["de", "en", "es", "fr"]}},
    "count": {"text": {"type": "string", "required": True},
              "words": {"type": "boolean", "required": False}},
}
KINDS = {"string": "^STRING$", "integer": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\\(\\d+,0\\))$",
         "number": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*|DOUBLE|FLOAT)$", "boolean": "^BOOLEAN$",
         "array": "^ARRAY<.*", "object": "^OBJECT<.*"}


def with_tools(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls, derived from plain conversations turn by turn.

    Every assistant turn asks for one call, whose arguments hold the whole text
    of the turn; every user turn after the first is the result of the call of
    the turn before it.  Calls of even length wait for the call two turns
    earlier; some arguments break their schema, as the texts happen to say.
    """
    n, turn = F.length("text"), F.col("turn")
    which = F.pmod(n, F.lit(3))
    own = F.concat(F.lit("call_"), turn.cast("string"))
    arguments = (F.when(which == 0, F.to_json(F.struct(F.pmod(n, F.lit(60)).alias("limit"), F.col("text").alias("query"))))
                 .when(which == 1, F.to_json(F.struct(F.col("text"), F.element_at(
                     F.array(*[F.lit(x) for x in ("de", "en", "es", "fr", "xx")]), F.pmod(n, F.lit(5)) + 1).alias("to"))))
                 .otherwise(F.to_json(F.struct(F.col("text"), (F.pmod(n, F.lit(2)) == 0).alias("words")))))
    call = F.concat(
        F.lit('{"tool_calls":[{"id":'), F.to_json(F.array(own)).substr(F.lit(2), F.length(own) + 2),
        F.lit(',"name":"'), F.when(which == 0, "search").when(which == 1, "translate").otherwise("count"),
        F.lit('","arguments":'), arguments,
        F.when((F.pmod(n, F.lit(2)) == 0) & (turn > 2), F.concat(
            F.lit(',"after":["call_'), (turn - 2).cast("string"), F.lit('"]'))).otherwise(F.lit("")), F.lit("}]}"))
    result = F.to_json(F.struct(F.col("text").alias("content"), F.concat(
        F.lit("call_"), (turn - 1).cast("string")).alias("tool_call_id")))
    answers = (F.col("role") == "user") & (turn > 0)
    return conversations.select(
        "conv_id", "turn", F.when(answers, F.lit("tool")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "assistant", call).when(answers, result).otherwise(F.col("text")).alias("text"))


def problems(name: Column, arguments: Column, tools: Mapping[str, Mapping[str, Mapping]]) -> Column:
    """Sorted array of what is wrong with a call: of an unknown tool, of a missing,
    unknown or ill-typed parameter, of a value out of its range."""
    keys = F.coalesce(F.json_object_keys(F.to_json(arguments)), F.array().cast("array<string>"))
    out = F.array(F.lit("unknown tool"))
    for tool, parameters in tools.items():
        found = []
        for p, rule in parameters.items():
            value = F.try_variant_get(arguments, f"$['{p}']", "variant")
            there = F.array_contains(keys, p)
            kind = F.schema_of_variant(value)
            if rule.get("required"):
                found.append(F.when(~there, F.lit(f"{p}: missing")))
            typed = F.coalesce(kind.rlike(KINDS[rule["type"]]), F.lit(False))
            found.append(F.when(there & ~typed, F.lit(f"{p}: not of type {rule['type']}")))
            number, string = (F.try_variant_get(arguments, f"$['{p}']", t) for t in ("double", "string"))
            if "minimum" in rule:
                found.append(F.when(there & typed & (number < rule["minimum"]), F.lit(f"{p}: too small")))
            if "maximum" in rule:
                found.append(F.when(there & typed & (number > rule["maximum"]), F.lit(f"{p}: too large")))
            if "values" in rule:
                found.append(F.when(there & typed & ~string.isin(rule["values"]), F.lit(f"{p}: not allowed")))
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(p) for p in parameters])),
                            lambda k: F.concat(k, F.lit(": unknown")))
        listed = F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), extra)
        out = F.when(name == tool, listed).otherwise(out)
    not_object = F.coalesce(~F.schema_of_variant(arguments).startswith("OBJECT<"), F.lit(True))
    return F.array_sort(F.when(not_object, F.array(F.lit("arguments: not an object"))).otherwise(out))


def link_calls(messages: DataFrame, tools: Mapping[str, Mapping[str, Mapping]] = TOOLS, conv_col: str = "conv_id",
               turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per call, and one per result that is linked to none: ``conv_id``, ``turn``, ``call_index``,
    ``call_id``, ``name``, ``level``, ``result_turn``, ``status``, ``valid``, ``problems``, ``canonical``.

    An assistant message may hold ``{"tool_calls": [{"id", "name", "arguments", "after"}]}``, a
    tool message ``{"tool_call_id", "content"}``.  Calls of a conversation in order: by level,
    turn and call_index.  ``status``: answered, unanswered, orphan (a result
    without call), duplicate result (of several results of a call the first, by
    turn and content, is linked, the others are rows of their own), or duplicate
    (a call whose id an earlier call has; it is not linked).  A call in a cycle, or
    one that waits for such a call, has a null level; an id that no call has is
    no reason to wait.  Null and empty texts, texts that are no such JSON and
    null call ids have no link; a null conversation is one of its own; every
    repeated result is a row; an empty table gives an
    empty table; other columns are ignored.  Joins are by conversation and id, so
    a conversation of any length is dealt over all tasks.
    """
    rows = messages.select(ident(conv_col).alias("conv_id"), ident(turn_col).alias("turn"),
                           ident(role_col).alias("role"), F.try_parse_json(ident(text_col)).alias("body"))
    asked = (rows.where(F.col("role") == "assistant")
             .select("conv_id", "turn", F.posexplode(F.try_variant_get("body", "$.tool_calls", "array<variant>"))
                     .alias("call_index", "call"))
             .select("conv_id", "turn", "call_index", F.try_variant_get("call", "$.id", "string").alias("call_id"),
                     F.try_variant_get("call", "$.name", "string").alias("name"),
                     F.try_variant_get("call", "$.arguments", "variant").alias("arguments"),
                     F.try_variant_get("call", "$.after", "array<string>").alias("after")))
    first = asked.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "call_index")).alias("first"))
    results = (rows.where(F.col("role") == "tool")
               .select("conv_id", "turn", F.try_variant_get("body", "$.tool_call_id", "string").alias("call_id"),
                       F.to_json(F.try_variant_get("body", "$.content", "variant")).alias("content"))
               .groupBy("conv_id", "call_id", "turn", "content").agg(F.count(F.lit(1)).alias("n")))
    answers = (results.where("call_id IS NOT NULL").groupBy("conv_id", "call_id")
               .agg(F.min(F.struct("turn", "content")).alias("result"), F.sum("n").alias("of_call")))

    waits = (asked.select(_key("conv_id").alias("conv_id"), "call_id", F.explode("after").alias("for"))
             .where("call_id IS NOT NULL")
             .join(first.select(_key("conv_id").alias("conv_id"), F.col("call_id").alias("for")),
                   ["conv_id", "for"], "left_semi").distinct())
    levels = _levels(stored(waits.select("conv_id", "call_id", "for"), "waits"))

    earliest = first.select(F.col("conv_id").alias("f_conv"), F.col("call_id").alias("f_call"), "first")
    own = asked.join(earliest, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("call_id") == F.col("f_call")),
                     "left").select("conv_id", "turn", "call_index", "call_id", "name", "arguments",
                                    (F.col("first.turn").eqNullSafe(F.col("turn"))
                                     & (F.col("first.call_index") == F.col("call_index"))).alias("is_first"))
    own = own.withColumn("is_first", F.coalesce("is_first", F.lit(True)))
    left = own.withColumn("key", F.when(F.col("is_first"), F.col("call_id")))
    right = answers.select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), "result")
    linked = left.join(right, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("key") == F.col("r_call")), "full")
    deep = levels.select(F.col("conv_id").alias("l_conv"), F.col("call_id").alias("l_call"), "level", F.lit(True).alias("waits"))
    linked = linked.join(deep, (_key("conv_id") == F.col("l_conv")) & (F.col("call_id") == F.col("l_call")), "left")
    called = F.col("turn").isNotNull() | F.col("call_index").isNotNull()
    wrong = F.when(called, problems(F.col("name"), F.col("arguments"), tools))
    done = linked.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"), F.coalesce("turn", "result.turn").alias("turn"), "call_index",
        F.coalesce("call_id", "r_call").alias("call_id"), "name",
        F.when(called, F.when(F.col("waits"), F.col("level")).otherwise(F.lit(0))).alias("level"),
        F.col("result.turn").alias("result_turn"),
        F.when(~called, F.lit("orphan")).when(~F.col("is_first"), F.lit("duplicate"))
        .when(F.col("result").isNotNull(), F.lit("answered")).otherwise(F.lit("unanswered")).alias("status"),
        wrong.alias("problems"), F.to_json("arguments").alias("arguments"), F.col("result.content").alias("content"))
    done = done.unionByName(_unlinked(results, answers, first), allowMissingColumns=True)
    return done.withColumn("valid", F.size("problems") == 0).select(
        "conv_id", "turn", "call_index", "call_id", "name", "level", "result_turn", "status", "valid", "problems",
        canonical({"arguments": F.col("arguments"), "id": _text("call_id"), "level": F.col("level").cast("string"),
                   "name": _text("name"), "result": F.col("content"), "status": _text("status")}).alias("canonical"))


def _key(column: str) -> Column:
    """A conversation as a string that is never null: joins on it meet null ids as well."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _unlinked(results: DataFrame, answers: DataFrame, first: DataFrame) -> DataFrame:
    """One row for every result but the first of each id: those without an id, and repeated ones."""
    several = answers.where("of_call > 1").select(
        F.col("conv_id").alias("s_conv"), F.col("call_id").alias("s_call"), "result")
    calls = first.where("call_id IS NOT NULL").select(
        F.col("conv_id").alias("f_conv"), F.col("call_id").alias("f_call"), F.lit(True).alias("called"))
    several = several.join(calls, F.col("s_conv").eqNullSafe(F.col("f_conv")) & (F.col("s_call") == F.col("f_call")),
                           "left").select("s_conv", "s_call", "result", "called")
    repeated = results.join(several, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("call_id") == F.col("s_call")))
    repeated = repeated.select(
        "conv_id", "turn", "call_id", "content",
        F.when(F.col("called"), F.lit("duplicate result")).otherwise(F.lit("orphan")).alias("status"),
        (F.col("n") - F.struct("turn", "content").eqNullSafe(F.col("result")).cast("long")).alias("n"))
    nameless = results.where("call_id IS NULL").select(
        "conv_id", "turn", "call_id", "content", F.lit("orphan").alias("status"), "n")
    return (repeated.unionByName(nameless).where("n > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("conv_id", "turn", "call_id", F.col("turn").alias("result_turn"), "status", "content"))


def _text(column: str) -> Column:
    """JSON text of a string column."""
    quoted = F.to_json(F.array(column))
    return F.when(F.col(column).isNotNull(), quoted.substr(F.lit(2), F.length(quoted) - 2))


def canonical(members: Mapping[str, Column]) -> Column:
    """An object of members given as JSON text, by name, without those that are null."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), v)) for k, v in sorted(members.items())]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _levels(waits: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls that wait for others; null in or behind a cycle.

    Each round settles the calls whose reasons to wait are settled, all
    conversations together; what is settled leaves the table.
    """
    waiting = waits.select("conv_id", "call_id").distinct()
    reasons = waits.join(waiting.withColumnRenamed("call_id", "for"), ["conv_id", "for"], "left_semi")
    settled = waiting.join(reasons, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(1))
    settled = stored(settled, "levels")
    level, fresh, out = 1, settled, settled
    open_waits = stored(reasons, "waits")
    while not fresh.isEmpty() and not open_waits.isEmpty():
        level += 1
        gone = fresh.select("conv_id", F.col("call_id").alias("for"))
        left = stored(open_waits.join(gone, ["conv_id", "for"], "left_anti"), "waits")
        fresh = stored(open_waits.select("conv_id", "call_id").distinct().join(
            left.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")
            .withColumn("level", F.lit(level)), "levels")
        out, open_waits = out.unionByName(fresh), left
    stuck = open_waits.select("conv_id", "call_id").distinct().withColumn("level", F.lit(None).cast("int"))
    return out.unionByName(stuck)
