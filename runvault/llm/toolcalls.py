"""Tool-call linking for chat data.

Calls and results meet in a hash join on (conversation, call id).  A call may
name the call that it follows; depths along these references order the calls
topologically: a call's depth is one more than its parent's, found by pointer
doubling (each round doubles the reach, so a chain of n calls takes log2 n
rounds).  Arguments are parsed once into a variant, checked against the tool's
schema, and written as canonical JSON: sorted keys at every level, no spaces,
numbers without trailing zeros.

Everything is keyed by (conversation, call id), never by conversation alone,
so a conversation with a third of all rows is spread like any other.

Rules for odd input: every result comes back once.  The first by turn and text
(nulls first) of a call's results is linked in its message; each further one is a row of
kind ``result``, each result without a call a row of kind ``orphan``, both with their
text.  Several calls with one id stay rows, each with the depth and errors of its own
parent; where others follow that id, the one with the smallest known parent
stands for it.  A parent that does not exist makes a root with the error
``unknown parent``; calls on or below a cycle have a null depth and the error
``cycle``.  Null ids link to nothing.  Null, malformed or non-object arguments give
one error and null canonical JSON (repeated keys count as malformed).  Texts of any
length stay whole, empty tables give no rows, extra columns are not read.  In a
transcript, turns without a role count as results; a turn that opens a
conversation answers nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runvault.llm.common import cut, hinted, pick
from runvault.llm.registry import query, table

ID = ["conv_id", "call_id"]
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
         "boolean": "^BOOLEAN$", "object": "^OBJECT<", "array": "^ARRAY<"}


def schema_table(spark, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """(tool, params) from {tool: {param: {type, required, enum, minimum, maximum}}}."""
    rows = [(tool, [(p, TYPES[s["type"]], s["type"], bool(s.get("required")), [str(x) for x in s["enum"]] if "enum" in s else None,
                     float(s["minimum"]) if "minimum" in s else None, float(s["maximum"]) if "maximum" in s else None)
                    for p, s in sorted(params.items())]) for tool, params in sorted(schemas.items())]
    return spark.createDataFrame(rows, "tool string, params array<struct<name:string,kind:string,type:string,"
                                       "required:boolean,allowed:array<string>,low:double,high:double>>")


def _errors(fields: Column, params: Column) -> Column:
    """What is wrong with an argument map, in the order of the parameter names."""
    def check(p: Column) -> Column:
        value = F.element_at(fields, p["name"])
        number = F.try_variant_get(value, "$", "double")
        wrong_type = ~F.rlike(F.schema_of_variant(value), p["kind"])
        off = (F.coalesce(number < p["low"], F.lit(False)) | F.coalesce(number > p["high"], F.lit(False))
               | F.coalesce(~F.array_contains(p["allowed"], F.try_variant_get(value, "$", "string")), F.lit(False)))
        return F.when(~F.map_contains_key(fields, p["name"]),
                      F.when(p["required"], F.concat(p["name"], F.lit(": missing")))
                      ).when(wrong_type, F.concat(p["name"], F.lit(": not "), p["type"])
                             ).when(off, F.concat(p["name"], F.lit(": out of range")))
    extra = F.array_sort(F.array_except(F.map_keys(fields), F.transform(params, lambda p: p["name"])))
    return F.concat(F.array_compact(F.transform(params, check)), F.transform(extra, lambda k: F.concat(k, F.lit(": unknown"))))


def validated(calls: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """``calls`` (conv_id, call_id, turn, name, arguments, parent_id) with ``errors`` and ``canonical``."""
    tools = schema_table(calls.sparkSession, schemas)
    rows = calls.join(hinted(tools, len(schemas)), F.col("name") == F.col("tool"), "left")
    rows = rows.withColumn("_v", F.try_parse_json("arguments")).withColumn(
        "_fields", F.try_variant_get("_v", "$", "map<string,variant>"))
    errors = (F.when(F.col("_fields").isNull(), F.array(F.when(F.col("_v").isNull(), F.lit("arguments: not JSON"))
                                                        .otherwise(F.lit("arguments: not an object"))))
              .when(F.col("tool").isNull(), F.array(F.lit("name: unknown tool")))
              .otherwise(_errors(F.col("_fields"), F.col("params"))))
    return rows.withColumn("errors", errors).withColumn(
        "canonical", F.when(F.col("_fields").isNotNull(), F.to_json("_v"))).drop("tool", "params", "_v", "_fields")


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) for the distinct non-null ids of ``calls``; null below a cycle.

    Every node points at an ancestor with its distance to it; each round a node takes over its
    target's pointer.  Roots end the walk.  After log2(calls) + 1 rounds only nodes that lead
    into a cycle still point at anything.
    """
    named = calls.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    ids = cut(named.groupBy(*ID).agg(F.lit(1).alias("_one")).drop("_one"))
    parents = ids.select("conv_id", F.col("call_id").alias("parent_id"))
    links = named.join(parents, ["conv_id", "parent_id"], "left_semi").groupBy(*ID).agg(F.min("parent_id").alias("to"))
    state = cut(ids.join(links, ID, "left").select(*ID, "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("far")))
    n = state.count()
    for _ in range(max(n, 1).bit_length() + 1):
        if state.filter("to is not null").isEmpty():
            break
        step = state.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("to2"), F.col("far").alias("far2"))
        state = cut(state.join(step, ["conv_id", "to"], "left").select(
            *ID, F.col("to2").alias("to"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far")))
    return state.select(*ID, F.when(F.col("to").isNull(), F.col("far")).alias("depth"))


def _quoted(name: str) -> Column:
    """A column as a JSON string, or null."""
    return F.coalesce(F.expr(f"substring(to_json(to_variant_object(array({name}))), 2, "
                             f"length(to_json(to_variant_object(array({name})))) - 2)"), F.lit("null"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """One row for each call, and one for each result that no call's message holds.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), parent_id; ``results``:
    conv_id, call_id, turn, content.  Columns: conv_id, call_id, kind (call, result or orphan), depth,
    turn, name, valid, errors, n_results (of the id; 1 for null ids), message (canonical JSON of the
    linked call, or of the result).  Sorting a conversation by (depth, turn, call_id) is a topological order.
    """
    calls = cut(pick(calls, *ID, "turn", "name", "arguments", "parent_id"))
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    texts = cut(pick(results, *ID, "turn", "content").groupBy(*ID, "turn", "content").agg(F.count("*").alias("copies")))
    found = cut(texts.filter(named).groupBy(*ID).agg(
        F.sum("copies").alias("n_results"), F.min(F.struct("turn", "content")).alias("first")))
    known = depths(calls)
    parents = known.select("conv_id", F.col("call_id").alias("parent_id"), F.col("depth").alias("above"), F.lit(True).alias("has_parent"))
    rows = (validated(calls, schemas).join(parents, ["conv_id", "parent_id"], "left").join(found, ID, "left")
            .withColumn("depth", F.when(named, F.when(F.col("has_parent"), F.col("above") + 1).otherwise(0)).cast("long")))
    more = F.when(named, F.array_compact(F.array(
        F.when(F.col("parent_id").isNotNull() & F.col("has_parent").isNull(), F.lit("parent_id: unknown parent")),
        F.when(F.col("depth").isNull(), F.lit("parent_id: cycle"))))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("errors", F.concat("errors", more)).withColumn("content", F.col("first.content"))
    message = F.concat(F.lit('{"arguments":'), F.coalesce("canonical", F.lit("null")), F.lit(',"depth":'),
                       F.coalesce(F.col("depth").cast("string"), F.lit("null")), F.lit(',"id":'), _quoted("call_id"),
                       F.lit(',"name":'), _quoted("name"), F.lit(',"parent":'), _quoted("parent_id"),
                       F.lit(',"result":'), _quoted("content"), F.lit("}"))
    linked = rows.select(
        *ID, F.lit("call").alias("kind"), "depth", "turn", "name", (F.size("errors") == 0).alias("valid"), "errors",
        F.coalesce("n_results", F.lit(0)).alias("n_results"), message.alias("message"))
    ids = known.select(*ID, F.lit(True).alias("called"))
    same = F.col("turn").eqNullSafe(F.col("first.turn")) & F.col("content").eqNullSafe(F.col("first.content"))
    of_ids = texts.filter(named).join(found, ID).join(ids, ID, "left").withColumn(
        "copies", F.col("copies") - F.when(F.col("called") & same, 1).otherwise(0)).drop("first")
    of_none = texts.filter(~named).withColumn("n_results", F.lit(1).cast("long")).withColumn("called", F.lit(None).cast("boolean"))
    rest = of_ids.unionByName(of_none).filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    further = rest.select(
        *ID, F.when(F.col("called"), "result").otherwise("orphan").alias("kind"), F.lit(None).cast("long").alias("depth"), "turn",
        F.lit(None).cast("string").alias("name"), F.lit(False).alias("valid"),
        F.array(F.when(F.col("called"), "call_id: repeated result").otherwise("call_id: no call")).alias("errors"), "n_results",
        F.concat(F.lit('{"id":'), _quoted("call_id"), F.lit(',"result":'), _quoted("content"), F.lit("}")).alias("message"))
    return linked.union(further)


# -- calls and results in the conversations table -----------------------------------
SCHEMAS = {
    "search": {"query": {"type": "string", "required": True},
               "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 50},
               "filters": {"type": "object"}},
    "note": {"text": {"type": "string", "required": True}, "weight": {"type": "number", "maximum": 100},
             "kind": {"type": "string", "enum": ["todo", "fact"]}},
    "fetch": {"path": {"type": "string", "required": True}, "again": {"type": "boolean"}},
}


def transcript(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assistant turns as calls on a tool set by the turn, with the whole text as an argument;
    each follows the turn two before it.  Every other turn answers the turn before it."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    text = F.expr("substring(to_json(to_variant_object(array(coalesce(text, '')))), 2, "
                  "length(to_json(to_variant_object(array(coalesce(text, ''))))) - 2)")
    name = F.when(F.col("turn") % 4 == 1, "search").when(F.col("turn") % 4 == 3, "note").otherwise("fetch")
    at = lambda k: F.concat(F.lit("c"), (F.col("turn") - k).cast("string"))
    limit = (F.length(F.coalesce("text", F.lit(""))) % 60).cast("string")
    arguments = (F.when(F.col("turn") % 4 == 1, F.concat(F.lit('{"query": '), text, F.lit(', "limit": '), limit, F.lit(
                     ', "filters": {"to": 2.50, "from": [1, true, null]}}')))
                 .when(F.col("turn") % 4 == 3, F.concat(F.lit('{ "weight":1.0, "text":'), text, F.lit(', "kind":"todo"}')))
                 .otherwise(F.concat(F.lit('{"path" : '), text, F.lit(', "again": "no", "to": 1}'))))
    calls = rows.filter("role = 'assistant'").select("conv_id", at(0).alias("call_id"), "turn", name.alias("name"),
                                                     arguments.alias("arguments"),
                                                     F.when(F.col("turn") >= 2, at(2)).alias("parent_id"))
    results = rows.filter("not (role <=> 'assistant') and turn > 0").select(
        "conv_id", at(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


SQL = """
WITH RECURSIVE m AS (SELECT conv_id, turn, role, text, coalesce(text, '') AS t FROM conversations),
c AS (SELECT conv_id, 'c' || turn AS call_id, turn, CASE turn % 4 WHEN 1 THEN 'search' WHEN 3 THEN 'note' ELSE 'fetch' END AS name,
  CASE WHEN turn >= 2 THEN 'c' || (turn - 2) END AS parent_id, length(t) % 60 AS lim,
  CASE turn % 4 WHEN 1 THEN '{"filters":{"from":[1,true,null],"to":2.5},"limit":' || (length(t) % 60) || ',"query":' || to_json(t) || '}'
    WHEN 3 THEN '{"kind":"todo","text":' || to_json(t) || ',"weight":1}'
    ELSE '{"again":"no","path":' || to_json(t) || ',"to":1}' END AS canonical
  FROM m WHERE role = 'assistant'),
res AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, turn, text AS content FROM m
  WHERE role IS DISTINCT FROM 'assistant' AND turn > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn NULLS FIRST, content NULLS FIRST) AS n,
  count(*) OVER (PARTITION BY conv_id, call_id) AS n_results FROM res),
ids AS (SELECT conv_id, call_id, min(parent_id) AS parent_id FROM c GROUP BY ALL),
link AS (SELECT i.*, p.call_id IS NOT NULL AS known FROM ids i LEFT JOIN ids p ON p.conv_id = i.conv_id AND p.call_id = i.parent_id),
d AS (SELECT conv_id, call_id, 0::BIGINT AS depth FROM link WHERE NOT known UNION ALL
  SELECT l.conv_id, l.call_id, d.depth + 1 FROM link l JOIN d ON d.conv_id = l.conv_id AND d.call_id = l.parent_id WHERE l.known),
e AS (SELECT c.*, d.depth, list_concat(
    CASE name WHEN 'search' THEN CASE WHEN lim < 1 OR lim > 50 THEN ['limit: out of range'] ELSE [] END
      WHEN 'note' THEN [] ELSE ['again: not boolean', 'to: unknown'] END,
    CASE WHEN c.parent_id IS NOT NULL AND NOT known THEN ['parent_id: unknown parent'] ELSE [] END) AS errors
  FROM c JOIN d USING (conv_id, call_id) JOIN link USING (conv_id, call_id))
SELECT e.conv_id, e.call_id, 'call' AS kind, depth, e.turn, name, len(errors) = 0 AS valid, errors, coalesce(n_results, 0) AS n_results,
  '{"arguments":' || canonical || ',"depth":' || depth || ',"id":"' || e.call_id || '","name":"' || name || '","parent":' ||
  coalesce('"' || e.parent_id || '"', 'null') || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS message
FROM e LEFT JOIN r ON r.conv_id = e.conv_id AND r.call_id = e.call_id AND r.n = 1
UNION ALL SELECT r.conv_id, r.call_id, CASE WHEN i.call_id IS NULL THEN 'orphan' ELSE 'result' END, NULL, turn, NULL, false,
  [CASE WHEN i.call_id IS NULL THEN 'call_id: no call' ELSE 'call_id: repeated result' END], n_results,
  '{"id":"' || r.call_id || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}'
FROM r LEFT JOIN ids i ON i.conv_id = r.conv_id AND i.call_id = r.call_id WHERE i.call_id IS NULL OR n > 1
"""


@query("op1_tool_calls", SQL)
def op1_tool_calls(spark, sf_dir):
    calls, results = transcript(table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, SCHEMAS)
