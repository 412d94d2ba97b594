"""Chat formatting: tool calls linked to their results, in DataFrame operations only.

Calls (conv_id, turn, call_id, after, name, arguments) and results (conv_id, turn, call_id, content) are
joined by conversation and identifier. ``after`` names the call of the same conversation that a call waits for. Calls are put in topological order by
the length of the chain before them, found by doubling the step of each call's pointer, so that a chain
of n calls takes log2(n) joins and no group is ever held by one task. Arguments (a JSON object) are
checked against the schemas (name, properties: array of (key, type, required)). Every call and every
result without a call gives one row with canonical JSON: keys in order, no spaces.

Defined results: a call with several results links the one of the smallest (turn, content), each other one gives a row of
status ``surplus``; of repeated call identifiers the smallest (turn, arguments) stays a call and the others have status and
error ``duplicate`` and no result; a call that
waits for a missing call is in position 0; calls that wait in a circle have position -1 and an error;
null identifiers or conversations link nothing, a call without them is an error ``no identifier``; equal call rows are one
call, equal orphan or surplus results a row each; the same identifier in two conversations names two calls; a null or
broken arguments text is an error, and so is one that repeats a key; a number without a fraction (``1.0``) is an integer and is written so; an unknown name is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.llm import common

#: JSON schema types as the beginnings of the types that values have once parsed.
_TYPES = {"integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": "^(BIGINT|DECIMAL|DOUBLE)", "boolean": "^BOOLEAN$", "string": "^STRING$", "array": "^ARRAY", "object": "^OBJECT"}


def positions(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, position): how many calls stand before each in its chain; -1 in a circle."""
    names = calls.select("conv_id", F.col("call_id").alias("known")).distinct()
    rows = calls.select("conv_id", "call_id", F.col("after").alias("known")).join(names.withColumn("there", F.lit(True)), ["conv_id", "known"], "left")
    rows = common.stored(rows.select("conv_id", "call_id", F.when(F.col("there"), F.col("known")).alias("jump"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("steps")))
    total = rows.count()
    done = 0
    while (1 << done) <= max(total, 1) and rows.filter("jump is not null").limit(1).count():
        ahead = rows.select("conv_id", F.col("call_id").alias("jump"), F.col("jump").alias("further"), F.col("steps").alias("more"))
        rows = rows.join(ahead, ["conv_id", "jump"], "left")
        rows = common.stored(rows.select("conv_id", "call_id", F.col("further").alias("jump"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")))
        done += 1
    return rows.select("conv_id", "call_id", F.when(F.col("jump").isNull(), F.col("steps")).otherwise(-1).alias("position"))


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``values`` (the arguments, parsed) and ``errors`` (texts, sorted)."""
    # a text that is no JSON object has no map of values
    parsed = calls.withColumn("values", F.try_parse_json("arguments")).withColumn("by_key", F.from_json("arguments", "map<string,variant>"))
    joined = parsed.join(schemas.select("name", "properties"), "name", "left")

    def wrong(q):
        kind = F.schema_of_variant(F.element_at("by_key", q["key"]))
        fits = F.lit(False)
        for name, pattern in _TYPES.items():
            fits = fits | ((q["type"] == name) & kind.rlike(pattern))
        return F.when(kind.isNull(), F.when(q["required"], F.concat(F.lit("missing "), q["key"]))).when(~fits, F.concat(F.lit("type "), q["key"]))

    unknown = F.array_except(F.map_keys("by_key"), F.transform("properties", lambda q: q["key"]))
    found = F.concat(F.filter(F.transform("properties", wrong), lambda e: e.isNotNull()), F.transform(unknown, lambda k: F.concat(F.lit("unknown "), k)))
    errors = F.when(F.col("properties").isNull(), F.array(F.lit("unknown tool"))).when(F.col("by_key").isNull() | F.col("values").isNull(), F.array(F.lit("broken arguments"))).otherwise(F.array_sort(found))
    return joined.withColumn("errors", errors).drop("properties", "by_key")


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, turn, call_id, status, position, errors, json), one row a call or orphan result."""
    key = ["conv_id", "call_id"]
    parts = F.struct("turn", "arguments", "name", "after")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = calls.select(*key, "turn", "after", "name", "arguments").distinct()
    results = results.select(*key, "turn", "content")
    first = calls.filter(named).groupBy(*key).agg(F.min(parts).alias("first"))
    marked = calls.join(first, key, "left").withColumn("again", named & ~parts.eqNullSafe(F.col("first"))).drop("first")
    answers = results.filter(named).groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("answer"))
    rows = checked(marked, schemas).join(answers, key, "left").join(positions(first.select(*key, "first.after")), key, "left")
    flag = lambda test, text: F.when(test, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("errors", F.concat("errors", flag(F.col("again"), "duplicate"), flag(~named, "no identifier"), flag(F.col("position") == -1, "circle")))
    rows = rows.withColumn("position", F.coalesce("position", F.lit(0)))
    rows = rows.withColumn("answer", F.when(~F.col("again"), F.col("answer")))
    linked = rows.select(
        "conv_id", "turn", "call_id", F.when(F.col("again"), "duplicate").when(F.col("answer").isNull(), "open").otherwise("answered").alias("status"), "position", "errors",
        F.to_json(F.struct(F.col("values").alias("arguments"), "call_id", F.col("answer.content").alias("content"), "errors", "name", "position")).alias("json"),
    )
    orphans = results.join(first.select(*key), key, "left_anti").select(
        "conv_id", "turn", "call_id", F.lit("orphan").alias("status"), F.lit(0).cast("long").alias("position"), F.array(F.lit("no call")).alias("errors"),
        F.to_json(F.struct("call_id", "content", F.array(F.lit("no call")).alias("errors"))).alias("json"),
    )
    # equal results are counted before they are dealt, so a call with very many costs a row a task
    answered = first.select(*key).join(answers, key)
    counted = results.filter(named).groupBy(*key, "turn", "content").agg(F.count("*").alias("n")).join(answered, key)
    left = F.col("n") - F.when(F.struct("turn", "content").eqNullSafe(F.col("answer")), 1).otherwise(0)
    second = counted.withColumn("_k", F.explode(F.array_repeat(F.lit(0), left.cast("int"))))
    surplus = second.select(
        "conv_id", "turn", "call_id", F.lit("surplus").alias("status"), F.lit(0).cast("long").alias("position"), F.array(F.lit("second result")).alias("errors"),
        F.to_json(F.struct("call_id", "content", F.array(F.lit("second result")).alias("errors"))).alias("json"),
    )
    return linked.unionByName(orphans).unionByName(surplus)


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls and results: what is asked in a turn is answered in the next."""
    name = lambda back: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    asked = turns.filter("role <> 'assistant'").select(
        "conv_id", "turn", name(0).alias("call_id"), name(2).alias("after"), F.col("role").alias("name"), F.to_json(F.struct(F.length("text").alias("chars"), "text")).alias("arguments")
    )
    return asked, turns.filter("role = 'assistant'").select("conv_id", "turn", name(1).alias("call_id"), F.col("text").alias("content"))


def turn_schemas(spark: SparkSession) -> DataFrame:
    """What a question holds; a system turn has no length to state."""
    return spark.sql(
        "select name, properties from values"
        " ('user', array(named_struct('key', 'chars', 'type', 'integer', 'required', true), named_struct('key', 'text', 'type', 'string', 'required', true))),"
        " ('system', array(named_struct('key', 'text', 'type', 'string', 'required', true))) as t(name, properties)"
    )


#: The same for plain conversations in the oracle's dialect.
CALLS_SQL = """
WITH RECURSIVE asked AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE role <> 'assistant'),
chain AS (
  SELECT conv_id, turn, 0 AS position FROM asked a
  WHERE NOT EXISTS (SELECT 1 FROM asked b WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 2)
  UNION ALL SELECT a.conv_id, a.turn, c.position + 1 FROM chain c JOIN asked a ON a.conv_id = c.conv_id AND a.turn = c.turn + 2),
calls AS (
  SELECT a.conv_id, a.turn, 'c' || a.conv_id || '-' || a.turn AS call_id,
         CASE WHEN r.text IS NULL THEN 'open' ELSE 'answered' END AS status, c.position,
         CASE WHEN a.role = 'system' THEN ['unknown chars'] ELSE []::VARCHAR[] END AS errors,
         '{"arguments":{"chars":' || length(a.text) || ',"text":' || to_json(a.text)::VARCHAR || '},"call_id":"c' || a.conv_id || '-' || a.turn || '"'
         || CASE WHEN r.text IS NULL THEN '' ELSE ',"content":' || to_json(r.text)::VARCHAR END
         || ',"errors":' || CASE WHEN a.role = 'system' THEN '["unknown chars"]' ELSE '[]' END
         || ',"name":"' || a.role || '","position":' || c.position || '}' AS json
  FROM asked a JOIN chain c USING (conv_id, turn)
  LEFT JOIN conversations r ON r.role = 'assistant' AND r.conv_id = a.conv_id AND r.turn = a.turn + 1),
orphans AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, 'orphan' AS status, 0 AS position, ['no call'] AS errors,
         '{"call_id":"c' || conv_id || '-' || (turn - 1) || '","content":' || to_json(text)::VARCHAR || ',"errors":["no call"]}' AS json
  FROM conversations r WHERE role = 'assistant'
    AND NOT EXISTS (SELECT 1 FROM asked a WHERE a.conv_id = r.conv_id AND a.turn = r.turn - 1))
SELECT conv_id, turn, call_id, status, CAST(position AS BIGINT) AS position, array_to_string(errors, ';') AS errors, json FROM calls
UNION ALL SELECT conv_id, turn, call_id, status, CAST(position AS BIGINT), array_to_string(errors, ';'), json FROM orphans
"""
