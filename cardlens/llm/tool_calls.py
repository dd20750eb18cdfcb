"""Tool-call linking in chats, in Spark SQL alone.

Calls and results are hash-joined by (conversation, identifier). A call that uses results of other
calls comes after them: its level is one more than the highest level that it depends on, found by
releasing level after level; calls on a cycle, or behind a call that is missing, get no level.
Arguments are validated against the tool's schema, and each linked call is written as canonical
JSON: keys sorted, no white space, numbers in one form.

No step collects a conversation: identifiers are dealt one by one, so a conversation that holds a
third of all turns is spread over all tasks. (conv_id, level, turn, call_id) is a topological order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import column_or, materialise, table

#: tool -> field -> (type, required). Types: string, integer, number, boolean.
TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "lookup": {"key": ("string", True)},
    "calculate": {"expression": ("string", True), "precision": ("integer", True)},
}
_KINDS = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$"}


def argument_errors(tool: Column, arguments: Column, tools: dict = TOOLS) -> Column:
    """Sorted array of what is wrong with a call's arguments (JSON text); empty if nothing is."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    per_tool = F.lit(None).cast("array<string>")
    for name, fields in sorted(tools.items()):
        checks = [F.transform(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields])),
                              lambda k: F.concat(F.lit("unknown field "), k))]
        for field, (kind, required) in sorted(fields.items()):
            found = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            wrong = F.when(found.isNull() | (found == "VOID"), F.lit(f"missing {field}") if required else F.lit(None)) \
                .when(~found.rlike(_KINDS[kind]), F.lit(f"{field} is no {kind}"))
            checks.append(F.array(wrong.cast("string")))
        per_tool = F.when(tool == name, F.concat(*checks)).otherwise(per_tool)
    return F.when(tool.isNull() | ~tool.isin(*tools), F.array(F.lit("unknown tool"))) \
        .when(~is_object, F.array(F.lit("arguments are no JSON object"))) \
        .otherwise(F.sort_array(F.array_compact(per_tool)))


def json_text(value: Column) -> Column:
    """A string as a JSON string; NULL as null."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def link(messages: DataFrame, tools: dict = TOOLS) -> DataFrame:
    """One row per call: conv_id, turn, call_id, tool, level, status, errors, call_json.

    ``messages``: conv_id, turn, call_id, tool, arguments (JSON text) and depends_on
    (array of call_ids) on calls; result_for and content on results; NULL elsewhere.

    * status: ok, invalid (see errors), no_result, or unordered (on a cycle or behind a missing call).
    * Rows that repeat a (conv_id, call_id): the call of the smallest (turn, arguments) counts, and
      of several results the one of the smallest (turn, content). Results of no call are left out.
    * NULL conv_id or call_id: no identifier, so no call. NULL turns come first.
    * arguments that are NULL or no JSON are written as null. An empty table gives an empty result.
    """
    calls = materialise(
        messages.where("call_id IS NOT NULL AND conv_id IS NOT NULL").groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "arguments", "tool", "depends_on")).alias("c"))
        .select("conv_id", "call_id", "c.*"), "calls")
    results = (messages.where("result_for IS NOT NULL").groupBy("conv_id", F.col("result_for").alias("call_id"))
               .agg(F.min(F.struct("turn", "content")).alias("r")).select("conv_id", "call_id", "r"))
    linked = calls.join(results, ["conv_id", "call_id"], "left").join(levels(calls), ["conv_id", "call_id"], "left")

    errors = argument_errors(F.col("tool"), F.col("arguments"), tools)
    status = F.when(F.col("level").isNull(), "unordered").when(F.size("errors") > 0, "invalid") \
        .when(F.col("r").isNull(), "no_result").otherwise("ok")
    canonical = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.lit("null"))
    call_json = F.concat(
        F.lit('{"arguments":'), canonical, F.lit(',"call_id":'), json_text(F.col("call_id")),
        F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"result":'), json_text(F.col("r.content")), F.lit(',"tool":'), json_text(F.col("tool")), F.lit("}"))
    return (linked.withColumn("errors", errors).withColumn("status", status)
            .select("conv_id", "turn", "call_id", "tool", "level", "status",
                    F.array_join("errors", "; ").alias("errors"), call_json.alias("call_json")))


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level of the calls that can be ordered; calls without dependencies have level 0."""
    keys = ["conv_id", "call_id"]
    needs = materialise(calls.select(*keys, F.explode(F.array_distinct("depends_on")).alias("on"))
                        .where("on IS NOT NULL"), "call-needs")
    count = needs.groupBy(*keys).agg(F.count("*").alias("c"))
    waiting = materialise(calls.select(*keys).join(count, keys, "left").select(*keys, F.coalesce("c", F.lit(0)).alias("c")),
                          "call-waiting")
    level = 0
    done = front = waiting.where("c = 0").select(*keys, F.lit(0).alias("level"))
    waiting = waiting.where("c > 0")
    while True:
        # what the last level releases; counts are combined before they meet the waiting calls
        met = (needs.join(front.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"])
               .groupBy(*keys).agg(F.count("*").alias("m")))
        left = materialise(waiting.join(met, keys, "left")
                           .select(*keys, (F.col("c") - F.coalesce("m", F.lit(0))).alias("c"),
                                   F.col("m").isNotNull().alias("moved")), "call-waiting")
        if left.where("moved").isEmpty():
            return done
        level += 1
        front = left.where("c = 0").select(*keys, F.lit(level).alias("level"))
        done, waiting = done.union(front), left.where("c > 0").select(*keys, "c")


def calls_of_chats(chats: DataFrame) -> DataFrame:
    """Messages for ``link`` from plain chats (conv_id, turn, role, text).

    Each user turn asks a tool that its number of words selects, with arguments made of its text;
    the assistant turn after it is the result. The k-th exchange uses the result of exchange k div 2.
    Some arguments are of a wrong type or left out, so that validation has work.
    """
    text = F.coalesce(column_or(chats, "text", "string"), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = F.col("turn").cast("long")
    user, k, odd = F.col("role") == "user", F.floor(turn / 2), F.pmod(turn, F.lit(2))
    name = lambda t: F.concat(F.lit("c"), t.cast("string"))
    tool = F.when(words % 3 == 0, "search").when(words % 3 == 1, "lookup").otherwise("calculate")
    quoted = json_text(text)
    size = F.when(words % 5 == 0, F.concat(F.lit('"'), words.cast("string"), F.lit('"'))).otherwise(words.cast("string"))
    arguments = F.when(tool == "search", F.concat(F.lit('{ "query": '), quoted, F.lit(', "limit": '), size, F.lit(" }"))) \
        .when(tool == "lookup", F.concat(F.lit('{"key":'), quoted, F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"precision" : '), size, F.when(words % 7 != 0, F.concat(F.lit(', "expression" : '), quoted))
                            .otherwise(""), F.lit("}")))
    before = (F.floor(k / 2) * 2 + odd).cast("long")
    return chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"),
        F.when(user, name(turn)).alias("call_id"), F.when(user, tool).alias("tool"),
        F.when(user, arguments).alias("arguments"),
        F.when(user & (before < turn), F.array(name(before))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
        F.when(F.col("role") == "assistant", name(turn - 1)).alias("result_for"),
        F.when(F.col("role") == "assistant", text).alias("content"))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``conversations``."""
    return link(calls_of_chats(table(spark, sf_dir, "conversations")))


OP8_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         2 * ((turn // 2) // 2) + turn % 2 AS before
  FROM conversations),
u AS (
  SELECT conv_id, turn, before, words, text,
         CASE words % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'calculate' END AS tool,
         CASE WHEN words % 5 = 0 THEN '"' || words || '"' ELSE CAST(words AS VARCHAR) END AS size
  FROM m WHERE role = 'user'),
r AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content FROM m WHERE role = 'assistant' GROUP BY ALL),
lv AS (
  SELECT conv_id, turn, 0 AS level FROM u WHERE before >= turn
  UNION ALL
  SELECT u.conv_id, u.turn, lv.level + 1 FROM u JOIN lv ON u.conv_id = lv.conv_id AND u.before = lv.turn
  WHERE u.before < u.turn),
j AS (
  SELECT u.conv_id, u.turn, 'c' || u.turn AS call_id, tool, lv.level, content,
    CASE tool
      WHEN 'search' THEN CASE WHEN words % 5 = 0 THEN 'limit is no integer' ELSE '' END
      WHEN 'lookup' THEN ''
      ELSE concat_ws('; ', CASE WHEN words % 7 = 0 THEN 'missing expression' END,
                     CASE WHEN words % 5 = 0 THEN 'precision is no integer' END) END AS errors,
    CASE tool
      WHEN 'search' THEN '{"limit":' || size || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}'
      WHEN 'lookup' THEN '{"key":' || CAST(to_json(text) AS VARCHAR) || '}'
      ELSE '{' || CASE WHEN words % 7 <> 0 THEN '"expression":' || CAST(to_json(text) AS VARCHAR) || ',' ELSE '' END
           || '"precision":' || size || '}' END AS args
  FROM u LEFT JOIN r ON r.conv_id = u.conv_id AND r.turn = u.turn
  LEFT JOIN lv ON lv.conv_id = u.conv_id AND lv.turn = u.turn)
SELECT conv_id, turn, call_id, tool, CAST(level AS INTEGER) AS level,
       CASE WHEN level IS NULL THEN 'unordered' WHEN errors <> '' THEN 'invalid'
            WHEN content IS NULL THEN 'no_result' ELSE 'ok' END AS status, errors,
       '{"arguments":' || args || ',"call_id":"' || call_id || '","level":'
       || coalesce(CAST(level AS VARCHAR), 'null') || ',"result":'
       || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"tool":"' || tool || '"}' AS call_json
FROM j
"""
